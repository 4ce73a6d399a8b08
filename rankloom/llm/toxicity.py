"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters the network twice: by its own vector, if it is among the words of the training sample, and by the mean of
the vectors of its character 3- and 4-grams (over bytes, with a mark at both ends, hashed into a fixed number of
vectors). Two gated recurrent layers read a window of ``WINDOW`` words from both ends, attention pools their states,
and a logistic unit scores the window. Windows begin every ``STRIDE`` words and overlap, down to the last word of the
text, however long it is; a document's score is that of its worst window.

Training uses a bounded sample of labelled documents (``PER_CLASS`` of either label, ``WINDOWS_PER_DOC`` windows evenly
spread over each, drawn by a hash of the id), and only labels of rows whose CRC-32 of the id as text, modulo 4, is not 2.
A label holds for a document, not for a window: at first those windows of toxic documents count as toxic whose words or
grams are most over-represented in toxic documents, later those that the network itself finds toxic, and clean windows
that it finds toxic come up more often. A fifth of the sample calibrates the logits to the threshold. The number of steps
is fixed, so is the cost. Scoring covers every word of every document.

Defined results. Null and empty texts, and texts of white space, score 0. A null ``doc_id`` is not held out. Null labels
are ignored; several labels of a document count as their largest. Without labels of both kinds every score is 0.
Repeated rows are scored each on their own. An empty table gives an empty result. Further columns are not inputs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import grown, table, text_or_empty

WINDOW, STRIDE = 32, 24
PER_CLASS, WINDOWS_PER_DOC = 3000, 16
WORD_DIMS, CHAR_DIMS, STATES, ATTENTION = 8, 8, 8, 8
GRAM_BINS = 1 << 14
MOST_WORDS_KNOWN, LEAST_DOCS = 20_000, 5
STEPS, BATCH, RATE, DECAY = 400, 256, 0.01, 0.002
THRESHOLD = 0.3
# Documents whose grams are counted at a time, which bounds the driver's memory.
SLICE_DOCS = 250
# Words whose gates a task keeps, 192 bytes each; beyond that all but those met first, the common ones, are forgotten.
CACHED_WORDS, KEPT_WORDS = 150_000, 50_000
EDGES = ".,;:!?\"'()[]"


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(EDGES) for x in text.lower().split()) if w]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the 3- and 4-grams of all words in a row, and where each word's begin. Every word has some."""
    raw = [b"\x02" + w.encode() + b"\x03" for w in words]
    size = np.array([len(r) for r in raw])
    flat = np.frombuffer(b"".join(raw) + b"\0\0\0", np.uint8).astype(np.uint32)
    end = np.cumsum(size)
    left = np.repeat(end, size) - np.arange(len(flat) - 3)
    three = (flat[:-3] << 16) | (flat[1:-2] << 8) | flat[2:-1]
    four = (three << 8) | flat[3:]
    both = np.stack([three * np.uint32(0x9E3779B1), (four ^ np.uint32(0x7FEB352D)) * np.uint32(0x85EBCA6B)], axis=1)
    bins = ((both ^ (both >> 15)) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - 14)).astype(np.int32)
    held = np.stack([left >= 3, left >= 4], axis=1)
    counts = np.add.reduceat(held.sum(1), end - size)
    return bins[held], np.cumsum(counts) - counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters, forward pass and gradients. ``codes`` name rows of a table of word inputs; 0 is padding."""

    def __init__(self, words: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.known = {w: i for i, w in enumerate(words)}
        d, h = WORD_DIMS + CHAR_DIMS, STATES

        def init(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        # Word vectors begin at 0: what has not been learnt says nothing. The last row is that of unknown words.
        self.p = {
            "word": np.zeros((len(words) + 1, WORD_DIMS), np.float32),
            "gram": init(GRAM_BINS, CHAR_DIMS, scale=0.02),
            "in": init(2, d, 3 * h, scale=d**-0.5),
            "bias": np.zeros((2, 3 * h), np.float32),
            "state": init(2, h, 3 * h, scale=h**-0.5),
            "look": init(2 * h, ATTENTION, scale=0.3),
            "pick": init(ATTENTION, scale=0.3),
            "out": init(2 * h, scale=0.3),
            "shift": np.zeros(1, np.float32),
        }

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the word table, bins of character grams and where each word's begin."""
        unknown = len(self.known)
        return np.array([self.known.get(w, unknown) for w in words], np.int64), *grams(words)

    def vectors(self, rows: np.ndarray, bins: np.ndarray, begin: np.ndarray) -> np.ndarray:
        n = np.diff(np.append(begin, len(bins)))[:, None]
        return np.concatenate([self.p["word"][rows], np.add.reduceat(self.p["gram"][bins], begin) / n], axis=1, dtype=np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        return np.stack([x @ self.p["in"][k] + self.p["bias"][k] for k in (0, 1)], axis=1).astype(np.float32)

    def forward(self, gates: np.ndarray, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows. ``gates`` are the projected words, row 0 being padding; ``codes`` is windows x words."""
        h, n, steps = STATES, len(codes), codes.shape[1]
        states = np.empty((steps, n, 2 * h), np.float32)
        full = bool(codes.all())
        for k in (0, 1):
            u, s = self.p["state"][k], np.zeros((n, h), np.float32)
            for t in range(steps) if k == 0 else range(steps - 1, -1, -1):
                g = gates[codes[:, t], k]
                a = s @ u
                zr = sigmoid(g[:, : 2 * h] + a[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(g[:, 2 * h :] + r * a[:, 2 * h :])
                m = None if full else (codes[:, t] > 0)[:, None].astype(np.float32)
                after = new + z * (s - new)
                if m is not None:
                    after = s + m * (after - s)
                if keep is not None:
                    keep.append((k, t, s, z, r, new, a[:, 2 * h :], m))
                s = after
                states[t, :, k * h : k * h + h] = s
        seen = np.tanh(states @ self.p["look"])
        score = seen @ self.p["pick"]
        if not full:
            score = np.where(codes.T > 0, score, -1e9).astype(np.float32)
        weight = np.exp(score - score.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        if keep is not None:
            keep.append((states, seen, weight, pooled))
        return pooled @ self.p["out"] + self.p["shift"][0]

    def gradients(self, gates: np.ndarray, codes: np.ndarray, wanted: np.ndarray) -> tuple[dict, np.ndarray, float]:
        """Gradients of the mean cross-entropy, that of the projected words, and the loss."""
        keep: list = []
        logit = self.forward(gates, codes, keep)
        states, seen, weight, pooled = keep.pop()
        p, h = self.p, STATES
        score = sigmoid(logit)
        loss = -np.mean(np.where(wanted > 0, np.log(score + 1e-7), np.log(1 - score + 1e-7)))
        d = ((score - wanted) / len(codes)).astype(np.float32)
        g = {"out": pooled.T @ d, "shift": np.array([d.sum()], np.float32)}
        d_pooled = d[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        d_seen = d_score[:, :, None] * p["pick"] * (1 - seen**2)
        g["pick"] = np.einsum("tn,tna->a", d_score, seen)
        g["look"] = np.einsum("tnh,tna->ha", states, d_seen)
        d_states += d_seen @ p["look"].T
        g["state"] = np.zeros_like(p["state"])
        d_gates = np.zeros((len(codes), codes.shape[1], 2, 3 * h), np.float32)
        carry = [np.zeros((len(codes), h), np.float32) for _ in (0, 1)]
        for k, t, before, z, r, new, a, m in reversed(keep):
            full = d_states[t, :, k * h : k * h + h] + carry[k]
            dh = full if m is None else full * m
            d_new = dh * (1 - z) * (1 - new**2)
            dz = dh * (before - new) * z * (1 - z)
            dr = d_new * a * r * (1 - r)
            to_state = np.concatenate([dz, dr, d_new * r], axis=1)
            g["state"][k] += before.T @ to_state
            carry[k] = dh * z + to_state @ p["state"][k].T
            if m is not None:
                carry[k] += full * (1 - m)
            d_gates[:, t, k] = np.concatenate([dz, dr, d_new], axis=1)
        return g, d_gates, float(loss)


class Adam:
    def __init__(self, p: dict):
        self.p, self.t = p, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict, rate: float) -> None:
        self.t += 1
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.001 * (x * x - self.v[k])
            self.p[k] -= (rate * self.m[k] / (1 - 0.9**self.t) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


def _sums(values: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the rows of ``values`` by their place."""
    return np.stack([np.bincount(at, values[:, k], rows) for k in range(values.shape[1])], axis=1).astype(np.float32)


def _in_docs(item: np.ndarray, doc: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of item and document."""
    pairs = np.unique(doc.astype(np.int64) * items + item)
    return pairs % items, pairs // items


def _telling(codes: np.ndarray, toxic: np.ndarray, owner: np.ndarray, bins: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each window how far its most telling word or gram is over-represented among toxic documents, in standard errors."""
    size = np.diff(np.append(begin, len(bins)))
    _, doc = np.unique(owner, return_inverse=True)
    label = np.zeros(doc.max() + 1, np.int64)
    label[doc] = toxic
    n1, n0 = max(1, label.sum()), max(1, (label == 0).sum())

    def standard_errors(held: np.ndarray) -> np.ndarray:
        p = held.sum(0) / (n0 + n1)
        return (held[1] / n1 - held[0] / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n0 + 1 / n1))

    at, _ = np.nonzero(codes)
    word, of_doc = _in_docs(codes[codes > 0] - 1, doc[at], len(begin))
    held = np.stack([np.bincount(word[label[of_doc] == y], minlength=len(begin)) for y in (0, 1)])
    held_grams = np.zeros((2, GRAM_BINS), np.int64)
    # Pairs come document by document, so grams can be counted for some documents at a time.
    edges = np.searchsorted(of_doc, np.arange(0, len(label) + SLICE_DOCS, SLICE_DOCS))
    for first, last in zip(edges[:-1], edges[1:]):
        w = word[first:last]
        n = size[w]
        gram = bins[np.repeat(begin[w] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        gram, gram_doc = _in_docs(gram, np.repeat(of_doc[first:last], n), GRAM_BINS)
        for y in (0, 1):
            held_grams[y] += np.bincount(gram[label[gram_doc] == y], minlength=GRAM_BINS)
    best = np.maximum(standard_errors(held), np.maximum.reduceat(standard_errors(held_grams)[bins], begin))
    return np.where(codes > 0, best[np.maximum(codes - 1, 0)], -np.inf).max(1)


def _best_per(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return pd.Series(values).groupby(owner).transform("max").to_numpy()


def train(windows: Iterable[str], toxic: np.ndarray, owner: np.ndarray, steps: int = STEPS, seed: int = 7) -> Network | None:
    """Fit the network to windows (words separated by blanks) with the labels of their documents; None without both labels."""
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    code: dict[str, int] = {}
    codes = np.zeros((len(toxic), WINDOW), np.int32)
    for i, words in enumerate(windows):
        row = [code.setdefault(w, len(code) + 1) for w in words.split(" ")]
        codes[i, : len(row)] = row
    everything = list(code)
    at, _ = np.nonzero(codes)
    in_docs = np.bincount(_in_docs(codes[codes > 0] - 1, np.unique(owner, return_inverse=True)[1][at], len(code))[0], minlength=len(code))
    common = sorted(np.flatnonzero(in_docs >= LEAST_DOCS).tolist(), key=lambda i: (-in_docs[i], everything[i]))
    listed = [everything[i] for i in common[:MOST_WORDS_KNOWN]]
    net = Network(listed, seed)
    rng = np.random.default_rng(seed)
    rows, bins, begin = net.inputs(everything)
    size = np.diff(np.append(begin, len(bins)))
    adam = Adam(net.p)
    # A fifth of the documents is kept for the calibration, if that leaves both labels on either side.
    spare = rng.permutation(np.unique(owner))[::5]
    apart = np.isin(owner, spare)
    if min(len(set(toxic[apart])), len(set(toxic[~apart]))) < 2:
        apart[:] = False
    told = np.where(toxic == 1, _telling(codes, toxic, owner, bins, begin), 0)
    seeds = (toxic == 1) & ((told >= _best_per(told, owner)) | (told >= 8))
    yes, no = np.flatnonzero(seeds & ~apart), np.flatnonzero((toxic == 0) & ~apart)
    hard = no

    def scored(which: np.ndarray) -> np.ndarray:
        gates = np.zeros((len(rows) + 1, 2, 3 * STATES), np.float32)
        for i in range(0, len(rows), 20_000):
            part = slice(i, min(i + 20_000, len(rows)))
            first, last = begin[i], begin[part.stop] if part.stop < len(begin) else len(bins)
            gates[i + 1 : part.stop + 1] = net.project(net.vectors(rows[part], bins[first:last], begin[part] - first))
        return np.concatenate([net.forward(gates, codes[which[i : i + 2048]]) for i in range(0, len(which), 2048)])

    for step in range(steps):
        if step in (steps // 2, 3 * steps // 4):
            maybe = np.flatnonzero((toxic == 1) & ~apart)
            got = scored(maybe)
            yes = maybe[(got >= _best_per(got, owner[maybe])) | (got > 2)]
            hard = no[np.argsort(-scored(no), kind="stable")[: max(BATCH, len(no) // 20)]]
        half = BATCH // 2
        pick = np.concatenate([rng.choice(yes, half), rng.choice(no, half // 2), rng.choice(hard, half // 2)])
        drawn = codes[pick]
        # Pages of one word or a few, over and over, are rare in a sample and look like nothing else in it: some clean
        # windows are turned into such.
        junk = np.arange(half, half + half // 8)
        width = rng.integers(1, 5, len(junk))
        drawn[junk] = np.take_along_axis(drawn[junk], np.arange(WINDOW) * width[:, None] // WINDOW, 1)
        here, local = np.unique(drawn, return_inverse=True)
        local = local.reshape(len(pick), WINDOW)
        if here[0] != 0:
            here, local = np.append(0, here), local + 1
        own = here[1:] - 1
        spans = size[own]
        flat = bins[np.repeat(begin[own] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())]
        # Some words are met as unknown ones, so that their characters are learnt too.
        as_row = np.where(rng.random(len(own)) < 0.3, len(listed), rows[own])
        x = net.vectors(as_row, flat, np.cumsum(spans) - spans)
        gates = np.concatenate([np.zeros((1, 2, 3 * STATES), np.float32), net.project(x)])
        g, d_gates, _ = net.gradients(gates, local, toxic[pick].astype(np.float32))
        # Sum over the places of each word first, then back through its inputs.
        sums = _sums(d_gates.reshape(-1, 6 * STATES), local.ravel(), len(here))[1:].reshape(-1, 2, 3 * STATES)
        g["in"] = np.stack([x.T @ sums[:, k] for k in (0, 1)])
        g["bias"] = sums.sum(0)
        dx = sums[:, 0] @ net.p["in"][0].T + sums[:, 1] @ net.p["in"][1].T
        g["word"] = _sums(dx[:, :WORD_DIMS], as_row, len(listed) + 1)
        g["word"][-1] = 0
        g["gram"] = _sums(np.repeat(dx[:, WORD_DIMS:] / spans[:, None], spans, axis=0), flat, GRAM_BINS)
        adam.step(g, RATE * (1 - step / steps) + 1e-4)
        for name in ("word", "gram"):
            net.p[name] *= 1 - DECAY
    _calibrate(net, scored(np.flatnonzero(apart)) if apart.any() else scored(np.arange(len(codes))), toxic, owner, apart)
    return net


def _calibrate(net: Network, got: np.ndarray, toxic: np.ndarray, owner: np.ndarray, apart: np.ndarray) -> None:
    """Shift the logits so that the threshold tells documents of the spare part apart best: in the middle of the cuts
    with the fewest errors."""
    which = np.flatnonzero(apart) if apart.any() else np.arange(len(toxic))
    docs = pd.DataFrame({"owner": owner[which], "got": got, "toxic": toxic[which]}).groupby("owner").max()
    docs = docs.sort_values("got", kind="stable")
    x, y = docs.got.to_numpy(np.float64), docs.toxic.to_numpy()
    # Cutting before place i misses the toxic documents below and takes in the clean ones above.
    wrong = np.append(0, np.cumsum(y)) + np.append(np.cumsum((1 - y)[::-1])[::-1], 0)
    at = np.flatnonzero(wrong == wrong.min())
    edges = np.concatenate([[x[0] - 4], x, [x[-1] + 4]])
    cut = (edges[at[0]] + edges[at[-1] + 1]) / 2
    net.p["shift"] += np.float32(np.log(THRESHOLD / (1 - THRESHOLD)) - cut)


class Scorer:
    """Scores texts window by window. What a word adds to the gates is computed once and kept."""

    def __init__(self, net: Network):
        self.net = net
        self.code: dict[str, int] = {}
        self.gates, self.used = np.zeros((1 << 14, 2, 3 * STATES), np.float32), 1

    def _trim(self) -> None:
        self.code = {w: i for w, i in self.code.items() if i <= KEPT_WORDS}
        self.gates, self.used = self.gates[: KEPT_WORDS + 1].copy(), KEPT_WORDS + 1

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            new = self.net.project(self.net.vectors(*self.net.inputs(some)))
            self.gates = grown(self.gates, self.used, self.used + len(new))
            self.gates[self.used : self.used + len(new)] = new
            self.code.update(zip(some, range(self.used, self.used + len(new))))
            self.used += len(new)

    def __call__(self, texts: list[str]) -> np.ndarray:
        """The score of each text."""
        if len(self.code) > CACHED_WORDS:
            self._trim()
        split = [words_of(t) for t in texts]
        size = np.array([len(s) for s in split], np.int64)
        flat = [w for s in split for w in s]
        new = set(flat).difference(self.code)
        if new:
            self._learn(sorted(new))
        codes = np.zeros(len(flat) + WINDOW, np.int32)
        codes[: len(flat)] = np.fromiter(map(self.code.__getitem__, flat), np.int32, len(flat))
        per_text = np.where(size > 0, np.maximum(0, -(-(size - WINDOW) // STRIDE)) + 1, 0)
        owner = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        begin, end = (np.cumsum(size) - size)[owner], np.cumsum(size)[owner]
        at = begin + nth * STRIDE
        # Full windows and windows that the text's end cuts short are scored apart: only the latter need masks.
        cut = at + WINDOW > end
        worst = np.zeros(len(texts))
        for which, padded in ((np.flatnonzero(~cut), False), (np.flatnonzero(cut), True)):
            for i in range(0, len(which), 2048):
                w = which[i : i + 2048]
                place = at[w, None] + np.arange(WINDOW)
                window = codes[place]
                if padded:
                    window = np.where(place < end[w, None], window, 0)
                np.maximum.at(worst, owner[w], sigmoid(self.net.forward(self.gates, window).astype(np.float64)))
        return worst


def _windows(words: list[str]) -> list[list[str]]:
    """At most WINDOWS_PER_DOC windows, evenly spread."""
    starts = list(range(0, max(1, len(words) - WINDOW + STRIDE), STRIDE))
    if len(starts) > WINDOWS_PER_DOC:
        starts = [starts[i * len(starts) // WINDOWS_PER_DOC] for i in range(WINDOWS_PER_DOC)]
    return [words[s : s + WINDOW] for s in starts if words[s : s + WINDOW]]


def held_out(doc_id: str = "doc_id"):
    key = F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary"))
    return F.coalesce(key % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, steps: int = STEPS) -> Network | None:
    """Train on a sample of at most ``per_class`` documents of either label."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    )
    first = F.xxhash64("doc_id")
    drawn = known.where("toxic = 1").orderBy(first, "doc_id").limit(per_class).unionByName(
        known.where("toxic = 0").orderBy(first, "doc_id").limit(per_class)
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, y, " ".join(w)) for i, y, t in zip(batch.doc_id, batch.toxic, batch.text) for w in _windows(words_of(t))]
            yield pd.DataFrame(rows, columns=["doc_id", "toxic", "words"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # At most 2 * per_class ids are broadcast, and at most that many times WINDOWS_PER_DOC windows collected.
    sample = texts.join(F.broadcast(drawn), "doc_id").mapInPandas(cut, "doc_id long, toxic int, words string").toPandas()
    sample = sample.drop_duplicates().sort_values(["doc_id", "words"], kind="stable")
    return train(sample.words, sample.toxic.to_numpy(), sample.doc_id.to_numpy(), steps)


def score(docs: DataFrame, net: Network | None, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` (those named) and ``score`` for every row."""
    rows = docs.select(*columns, text_or_empty().alias("text"))
    if net is None:
        return rows.select(*columns, F.lit(0.0).alias("score"))
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            found = [scorer(texts[i : i + 512]) for i in range(0, len(texts), 512)]
            scores = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], scores], names=[*columns, "score"])

    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in columns)
    return rows.mapInArrow(run, f"{kinds}, score double")


def keep_clean(docs: DataFrame, fit_on: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns."""
    net = fit(fit_on, labels)
    if net is None:
        return docs
    model = docs.sparkSession.sparkContext.broadcast(net)
    state: dict = {}

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = state.setdefault("scorer", Scorer(model.value))
        for texts in batches:
            texts = list(texts)
            yield pd.Series(np.concatenate([scorer(texts[i : i + 512]) for i in range(0, len(texts), 512)] or [np.zeros(0)]))

    return docs.where(scored(text_or_empty()) < THRESHOLD)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")), "doc_id")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op10_toxicity": (op10_toxicity, None)}
