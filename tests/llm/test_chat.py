from pyspark.sql import functions as F

from catalog.check import compare
from rankloom.llm.chat import PART, SQL, escape, format_chat, op2_chat_formatting, read_back, unescape
from tests.conftest import SF, plan_of


def test_escaping_is_reversible(column):
    texts = ["</s>", "\\</s>", "<\\/s>", "<\\\\/s><s>", "[INST", "[/INST]]", "[\\[IMG]", "a[+]b", "<s", "s>", "", "[\\\\+]", "<</s>"]
    escaped = column(escape, texts)
    assert not any(m in e for e in escaped for m in ("<s>", "</s>", "[INST]", "[/INST]", "[IMG]", "[+]"))
    assert column(unescape, escaped) == texts
    assert len(set(escaped)) == len(texts)


def test_parts_become_placeholders_with_references(spark):
    parts = [
        ("text", "look <s> ", None, None, None, None, None), ("text", "here", None, None, None, None, None),
        ("image", None, "i.png", 57, 28, None, None), ("audio", None, "a.wav", None, None, 1.5, None),
        ("document", None, "d.pdf", None, None, None, 3), ("video", None, "v", None, None, None, None), None,
    ]
    rows = [
        (1, 1, "user", parts), (1, 2, "assistant", [("text", "ok [IMG]", None, None, None, None, None)]),
        (1, None, None, None), (1, 2, "assistant", []),
    ]
    df = format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{PART}>"))
    out = {r.segment: r for r in df.collect()}
    first = out[0]
    assert first.formatted == (
        "<s>user[INST]look <\\s> [+]here[IMG][AUDIO][DOC][PART][/INST]</s>"
        "<s>assistant[OUT][/OUT]</s><s>assistant[OUT]ok [\\IMG][/OUT]</s>"
    )
    assert [(a.kind, a.ref, a.tokens) for a in first.attachments] == [
        ("image", "i.png", 3), ("audio", "a.wav", 38), ("document", "d.pdf", 768), ("video", "v", 0)
    ]
    assert first.formatted[first.loss_spans[1].start : first.loss_spans[1].end] == "ok [\\IMG]"
    assert out[None].formatted == "<s>[INST][/INST]</s>"
    read = {r.segment: r for r in read_back(df).collect()}
    assert [tuple(t) for t in read[0].turns] == [("user", "look <s> here"), ("assistant", ""), ("assistant", "ok [IMG]")]
    assert read[0].loss_text == "ok [IMG]"
    assert format_chat(spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{PART}>")).count() == 0


def test_query_equals_its_sql_and_stays_native(spark):
    assert compare(spark, SF, op2_chat_formatting, SQL)[0] == "ok"
    plan = plan_of(op2_chat_formatting(spark, SF))
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_long_conversations_come_in_segments(spark):
    turns = spark.range(300).select(
        F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"),
        F.expr(f"array(cast(('text', cast(id as string), null, null, null, null, null) as {PART}))").alias("parts"),
    )
    rows = read_back(format_chat(turns)).orderBy("segment").collect()
    assert [r.n_turns for r in rows] == [128, 128, 44]
    assert "".join(r.loss_text for r in rows) == "".join(map(str, range(300)))
