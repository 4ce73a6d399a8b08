import importlib.util

import corpus_pipeline
import __spark_entry__ as registered
from rankloom.llm.registry import QUERIES
from rankloom.llm.toxicity import THRESHOLD, fit, score
from tests.conftest import SF
from tests.llm.test_near_dedup import brute
from tests.llm.test_packing import padded


def test_stages_filter_mix_and_pack(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        got[name] = (docs, out.cache())
        docs = got[name][1]

    def ids(df):
        return [r.doc_id for r in df.select("doc_id").collect()]

    # A few dozen labels teach little here; how well it tells is tested on a larger table. The stage follows the scores.
    before, after = got["toxicity"]
    net = fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(ids(after)) == sorted(r.doc_id for r in score(before, net, "doc_id").where(f"score < {THRESHOLD}").collect())
    assert 0 < after.count() < before.count()
    before, after = got["exact_dedup"]
    space = str.maketrans("", "", " \t\n\x0b\x0c\r")
    best = {}
    for r in before.collect():
        key = r.text.translate(space)
        best[key] = min(best.get(key, (1,)), (-len(r.text), r.doc_id))
    assert sorted(ids(after)) == sorted(i for _, i in best.values())
    before, after = got["near_dedup"]
    want = [doc for doc, _, _, kept in brute([(r.doc_id, r.text) for r in before.collect()], 5) if kept]
    assert sorted(ids(after)) == sorted(want)
    before, after = got["mixing"]
    assert set(ids(after)) <= set(ids(before)) and max(map(ids(after).count, set(ids(after)))) == 2
    before, after = got["packing"]
    rows = after.collect()
    assert sum(r.length for r in rows if r.start == 0 or r.start > 0) == sum(r.doc_tokens for r in rows if r.start == 0)
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert sum(padded(n, 4096) for n in fill.values()) < 0.05 * sum(fill.values())


def test_registered():
    assert importlib.util.find_spec("rankloom.llm")
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert len({n.split("_")[0] for n in QUERIES}) == len(QUERIES)
