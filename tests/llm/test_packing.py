import random
import zlib

import numpy as np
import pytest

from rankloom.llm.packing import OTHER_EVERY, PER_SEQUENCE, Packer, WordIds, choose_cuts, op1_packing, pack, word_vocabulary
from tests.conftest import SF


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_vocabulary())


def test_word_by_word_ids_are_the_tokenizers(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["", "  ", "a<|endoftext|>b c<|startoftext|>", "x\x1cy\x85z\xa0w İSTANBUL ΣΑΣ don't ﬁ e\u0301 é", "<|startoftext|", "a\n\n b\r\nc"]
    ids, ends, sentences = WordIds(word_vocabulary())(texts)
    want = [e.ids + [2] for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and ends.tolist() == np.cumsum([len(w) for w in want]).tolist()
    assert set(sentences) <= set(range(1, len(ids) + 1))


def test_markers_are_matched_as_they_are_written():
    texts = ["<|ENDOFTEXT|>", "<|endoftext|>", "A <|EndOfText|>. B<|STARTOFTEXT|>C <|endoftext|>D", "É <|ENDOFTEXT|> <|endoftext|>", "<|NO Marker|>"]
    ids, _, _ = WordIds(word_vocabulary())(texts)
    want = [e.ids + [2] for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert want[0] != want[1] and ids.tolist() == sum(want, [])


def padded(n: int, length: int) -> int:
    return 0 if n & (n - 1) == 0 else length - n


def test_cuts_cost_least():
    rng = random.Random(3)
    for _ in range(60):
        total, length = rng.randint(1, 90), rng.choice([8, 16, 32])
        ends = sorted(set(rng.sample(range(1, total + 1), min(total, 5))) | {total})
        sentences = sorted(rng.sample(range(1, total + 1), min(total, 12)))
        places = sorted({0, *sentences, *ends, *range(0, total + 1)}) if total <= OTHER_EVERY else None
        if places is None or max(np.diff(sorted({0, *sentences, *ends}))) > length:
            continue
        allowed = sorted({0, *sentences, *ends})
        best = {0: 0}
        for j in allowed[1:]:
            best[j] = min(best[i] + padded(j - i, length) for i in allowed if i < j <= i + length) + PER_SEQUENCE
            best[j] += 0 if j in ends else 8
        cuts, cost = choose_cuts(np.array(ends), np.array(sentences), total, length)
        assert cost == best[total]
        assert cuts[-1] == total and np.diff(np.append(0, cuts)).max() <= length


def test_a_stream_is_packed_whole_and_in_order():
    rng = np.random.default_rng(1)
    packer, rows, docs = Packer(64, True), [], []
    for block in range(6):
        size = rng.integers(1, 90, 20)
        ids = rng.integers(0, 999, size.sum()).astype(np.uint16)
        docs += np.split(ids, np.cumsum(size)[:-1])
        packer.add(list(range(block * 20, block * 20 + 20)), ids, np.cumsum(size), np.zeros(0, np.int64))
        rows += packer.flush(last=block == 5)
    got = {}
    for doc, start, length, crc, total, sequence, offset, raw in rows:
        assert start == len(got.get(doc, [])) and total == len(docs[doc]) and crc == zlib.crc32(raw)
        got[doc] = got.get(doc, []) + np.frombuffer(raw, "<u4").tolist()
    assert got == {i: d.tolist() for i, d in enumerate(docs)}
    assert [r[5] for r in rows] == sorted(r[5] for r in rows)


def check(rows, texts, length):
    ids = {i: e.ids + [2] for i, e in zip(texts, tokenizer().encode_batch(list(texts.values()), add_special_tokens=False))}
    fill, pieces = {}, {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
        assert r.doc_tokens == len(ids[r.doc_id])
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, r.start + r.length))
    for i, p in pieces.items():
        assert [a for a, _ in p] == [0] + [b for _, b in p][:-1] and p[-1][1] == len(ids[i])
    assert set(pieces) == set(ids) and sorted(fill) == list(range(len(fill))) and max(fill.values()) <= length
    return sum(padded(n, length) for n in fill.values()) / sum(fill.values())


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert check(op1_packing(spark, SF).collect(), texts, 4096) < 0.03


def test_awkward_rows(documents, nothing):
    known = documents.where("doc_id is not null and doc_id <> 12")
    texts = {r.doc_id: r.text or "" for r in known.collect()}
    check(pack(known, word_vocabulary(), 256).collect(), texts, 256)
    everything = pack(documents, word_vocabulary(), 256).collect()
    assert sum(r.length for r in everything if r.doc_id == 12) == 2 * next(r.doc_tokens for r in everything if r.doc_id == 12)
    assert any(r.doc_id is None for r in everything)
    assert pack(nothing, word_vocabulary()).count() == 0


@pytest.mark.parametrize("text", ["", "word", "x " * 5000])
def test_one_document(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert sum(r.length for r in pack(df, word_vocabulary(), 64).collect()) == len(tokenizer().encode(text, add_special_tokens=False).ids) + 1


def test_forgotten_words_are_learnt_again(monkeypatch):
    from rankloom.llm import packing

    texts = [" ".join(f"Word{i * k % 977}, other-{i} thing." for i in range(300)) for k in range(1, 9)]
    want = [x.tolist() for x in WordIds(word_vocabulary())(texts)]
    monkeypatch.setattr(packing, "MOST_WORDS", 500)
    monkeypatch.setattr(packing, "KEPT_WORDS", 60)
    words = WordIds(word_vocabulary())
    ids, ends, sentences = [], [], []
    for text in texts:
        got = words([text])
        ends += (got[1] + len(ids)).tolist()
        sentences += (got[2] + len(ids)).tolist()
        ids += got[0].tolist()
        words.trim()
        assert len(words.code) <= 61
    assert [ids, ends, sentences] == want
