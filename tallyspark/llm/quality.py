"""Quality classifier (operator 3): hashed word n-grams, logistic regression, FTRL-proximal.

A text is cut into tokens, runs of letters and digits or of other signs inside a word, as
written (capitals matter). Tokens and pairs of neighbours are hashed into 2**``BITS``
features; a feature's value is its count over the square root of all counts. Weights come from
follow-the-regularised-leader updates, one labelled text at a time, and a score is the
logistic function of a sparse dot product.

Training reads at most ``SAMPLE`` labelled documents (those with the smallest hash of doc_id, one row an id; an
equal share of each label's rows is not forced) outside the held-out fold, and only their text and
label. Features are made and counted by many tasks; one task applies the updates, and the weights (2**BITS
floats, a fixed size) are broadcast. Every whole text is scored.

Defined results: null text is an empty text; a text without tokens scores the bias alone; a null
doc_id is held out; labels that are null, or that contradict each other, are not learnt from; without
labels every score is 0.5; an empty table gives no rows; a text of any length is scored whole, a
long one in parts; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import vectext as V

BITS = 18
SAMPLE = 8_000
FOLDS, THRESHOLD = 5, 0.3
#: Stands for the token before the first.
START = np.uint64(7)
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[np.r_[48:58, 65:91, 97:123, 128:256]] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the tokens and where each document's tokens begin."""
    a1, a2 = V.bounds(_ALNUM[data], off)
    p1, p2 = V.bounds(~_ALNUM[data] & ~V._SPACE[data], off)
    start, end = np.concatenate([a1, p1]), np.concatenate([a2, p2])
    order = np.argsort(start, kind="stable")
    return start[order], end[order], np.searchsorted(start[order], off)


def pairs(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hashes of pairs of neighbours. All pairs of a word with itself share one feature: a word
    said again says the same about a text whichever word it is."""
    return np.where(before == h, np.uint64(0xA5A5A5A5A5A5A5A5), V.mix(before * np.uint64(0x9E3779B97F4A7C15) + h))


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of tokens and neighbours, document by document, and where each begins.

    Every token gives its own feature and that of the pair with the token before it (the first
    pairs with the document's start).
    """
    start, end, at = tokens(data, off)
    h = V.Spans(data).hash(start, end)
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[at[:-1][at[:-1] < at[1:]]] = START
    return _numbers(before, h, bits), 2 * at


def _numbers(before: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    out = np.empty(2 * len(h), dtype=np.int32)
    out[0::2] = (h >> np.uint64(64 - bits)).astype(np.int32)
    out[1::2] = (pairs(before, h) >> np.uint64(64 - bits)).astype(np.int32)
    return out


def long_features(data: np.ndarray, bits: int = BITS, size: int = V.BLOCK) -> Iterator[np.ndarray]:
    """The same of one long text, part by part: memory follows the part, not the text."""
    last = START
    for part in V.parts(data, size):
        start, end, _ = tokens(part, np.array([0, len(part)]))
        if len(start):
            h = V.Spans(part).hash(start, end)
            yield _numbers(np.append(last, h[:-1]), h, bits)
            last = h[-1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """FTRL-proximal logistic regression (McMahan and others, 2013) over sparse examples."""

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 1e-4) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last is the bias

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (sigmoid(w @ x) - y) * x
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different features of one document and their values."""
    at, c = np.unique(found, return_counts=True)
    return at, c / np.sqrt(max(1, len(found)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """doc_id, text and y of the rows to learn from: at most ``sample`` of them, one for each id (of
    repeated ids the text with the smallest hash)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias("y"), F.max(label).alias("_y")
    )
    chosen = (
        known.where((F.col("y") == F.col("_y")) & ~held_out(F.col("doc_id")))
        .select(F.col("doc_id").alias("_id"), "y")
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return rows.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "y")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, bits: int = BITS, epochs: int = 3) -> np.ndarray:
    """The weights, the bias last."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in V.blocks(b["text"]):
                if len(data) > V.BLOCK:  # one long text
                    examples = [counted(np.concatenate([np.zeros(0, np.int32), *long_features(data, bits)]))]
                else:
                    found, at = features(data, off, bits)
                    examples = [counted(found[p:q]) for p, q in zip(at, at[1:], strict=False)]
                lists = [pa.array([e[k] for e in examples], pa.list_(kind)) for k, kind in enumerate((pa.int32(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([b["doc_id"][i:j], b["y"][i:j].cast(pa.int32()), *lists], names=["doc_id", "y", "f", "x"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for b in batches:
            for k, (doc, y) in enumerate(zip(b["doc_id"].to_pylist(), b["y"].to_pylist(), strict=True)):
                f, x = (b[c][k].values.to_numpy() for c in ("f", "x"))
                rows.append((doc, y, np.append(f, 1 << bits), np.append(x, 1.0)))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        model = Ftrl(1 << bits)
        for epoch in range(epochs):
            for k in np.random.Generator(np.random.PCG64(epoch)).permutation(len(rows)):
                _, y, f, x = rows[k]
                model.learn(f, x, y)
        w = model.weights().astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], names=["w"])

    found = labelled_sample(docs, labels, label, sample).mapInArrow(
        extract, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y int, f array<int>, x array<double>"
    )
    row = found.repartition(1).mapInArrow(fit, "w binary").first()
    return np.frombuffer(row["w"], dtype=np.float32) if row else np.zeros((1 << bits) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # 2**bits + 1 floats
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for b in batches:
            for i, j, data, off in V.blocks(b["text"]):
                if len(data) > V.BLOCK:  # one long text
                    sums = [(w[f].astype(np.float64).sum(), len(f)) for f in long_features(data, bits)]
                    dot = np.array([sum(s for s, _ in sums) / np.sqrt(max(1, sum(n for _, n in sums)))])
                else:
                    found, at = features(data, off, bits)
                    dot = V.sums(w[found].astype(np.float64), at) / np.sqrt(np.maximum(1, np.diff(at)))
                p = sigmoid(dot + float(w[-1]))
                yield pa.RecordBatch.from_arrays([b["doc_id"][i:j], pa.array(p)], names=["doc_id", "score"])

    scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
