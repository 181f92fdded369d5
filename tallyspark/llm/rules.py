"""Quality rules (operator 4): measured rules, then a calibrated logistic regression.

Base rules come from counts of the whole text: too few words, or too many words inside three-word
windows that the text repeats. What passes them is judged by a logistic regression over hashed
word n-grams (words and neighbours) and hashed character n-grams (from every character on the ``GRAM``
next, and the coarse shapes of the ``SHAPES`` next; what is left of them at a text's end), trained on labelled rows by Adagrad and calibrated by Platt's sigmoid
on a fold it has not seen; a document stays when the probability of label 1 reaches
``THRESHOLD``. Scoring runs in Arrow batches.

Training reads at most ``SAMPLE`` labelled documents, one row an id, outside the held-out fold (crc32 of doc_id modulo 5
is 0); their features are made by many tasks and learnt from by one. Defined results: null text has no words and fails the base
rules; repeated rows are judged alike; without labels of both kinds the probability is 0.5 for every text; an empty table gives
no rows; texts of any length are read whole; other columns are kept in ``_doc``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import vectext as V
from tallyspark.llm.common import packed
from tallyspark.llm.quality import labelled_sample, pairs, sigmoid

BITS = 18
GRAM, SHAPES = 4, 6
SAMPLE = 5_000
THRESHOLD = 0.3
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
#: Coarse classes: space, capital, small letter, digit, byte over 127, other sign.
_SHAPE = np.full(256, 5, dtype=np.uint32)
_SHAPE[V._SPACE] = 0
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 1, 2, 3, 4


def _dup_lines(data: np.ndarray, off: np.ndarray, spans: V.Spans, word_byte: np.ndarray) -> np.ndarray:
    """Per document: lines with a word that equal an earlier line of it."""
    nl = np.flatnonzero(data == 10)
    start = np.concatenate([off[:-1], nl + 1])
    end = np.concatenate([nl, off[1:]])
    start, end = np.sort(start), np.sort(end)
    doc = np.searchsorted(off, start, side="right") - 1
    # A line that begins where its document ends (after a last \n) is empty, as are empty documents.
    has = np.concatenate([[0], np.cumsum(word_byte)])
    full = (end > start) & (has[end] > has[start])
    start, end, doc = start[full], end[full], doc[full]
    key = V.mix(spans.hash(start, end) + doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return np.bincount(doc[again], minlength=len(off) - 1)


def measures(data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """The base rules' counts per document, and the word hashes with their document bounds."""
    start, end, at = V.words(data, off)
    spans = V.Spans(data)
    h = spans.hash(start, end)
    in_word = ~V._SPACE[data]
    n = np.diff(at)
    # Three-word windows that lie in one document.
    doc = V.owners(at)
    inside = np.zeros(len(h), dtype=bool)
    if len(h) >= 3:
        inside[:-2] = doc[:-2] == doc[2:]
    w = np.flatnonzero(inside)
    key = V.mix(V.mix(V.mix(h[w] + doc[w].astype(np.uint64)) + h[w + 1]) + h[w + 2])
    twice = w[V.repeated(key)] if len(w) else w
    covered = np.zeros(len(h) + 2, dtype=bool)
    for k in range(3):
        covered[twice + k] = True
    counts = {
        "n_words": n,
        "word_chars": V.sums((in_word & ((data & 0xC0) != 0x80)).view(np.int8), off),
        "n_symbols": V.sums(_SYMBOL[data].view(np.int8), off),
        "n_dup_lines": _dup_lines(data, off, spans, in_word),
        "n_repeat_words": V.sums(covered[: len(h)].view(np.int8), at),
    }
    return counts, (h, at)


def word_features(h: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and pairs of neighbours in the lower half of the feature space."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[at[:-1][at[:-1] < at[1:]]] = np.uint64(7)
    pair = pairs(before, h)
    out = np.empty(2 * len(h), dtype=np.int32)
    shift = np.uint64(65 - bits)
    out[0::2] = (h >> shift).astype(np.int32)
    out[1::2] = (pair >> shift).astype(np.int32)
    return out, 2 * at


def char_features(data: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two features per character (code point) in the upper half: the ``GRAM`` characters from it, and the
    shapes of the ``SHAPES`` characters from it, fewer at the text's end; and where each document's begin."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    at = np.searchsorted(start, off)
    n, sizes = len(start), np.diff(at)
    last, text_end = np.repeat(at[1:], sizes), np.repeat(off[1:], sizes)
    following = np.concatenate([start, np.full(GRAM, len(data), dtype=start.dtype)])[GRAM:]
    gram = V.Spans(data).hash(start, np.minimum(following, text_end))
    kinds = np.concatenate([_SHAPE[data[start]].astype(np.uint64) + np.uint64(1), np.zeros(SHAPES, np.uint64)])
    shape = np.zeros(n, dtype=np.uint64)
    for k in range(SHAPES):
        shape = shape * np.uint64(8) + np.where(np.arange(k, n + k) < last, kinds[k : n + k], np.uint64(0))
    out = np.empty(2 * n, dtype=np.int32)
    shift, half = np.uint64(65 - bits), 1 << (bits - 1)
    out[0::2] = (gram >> shift).astype(np.int32) + half
    out[1::2] = (V.mix(shape + np.uint64(0x5BD1E995)) >> shift).astype(np.int32) + half
    return out, 2 * at


def _scaled_sums(w: np.ndarray, data: np.ndarray, off: np.ndarray, h: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
    f, fa = word_features(h, at, bits)
    words = V.sums(w[f].astype(np.float64), fa) / np.sqrt(np.maximum(1, np.diff(fa)))
    c, ca = char_features(data, off, bits)
    chars = V.sums(w[c].astype(np.float64), ca) / np.sqrt(np.maximum(1, np.diff(ca)))
    return words + chars


def _example(data: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and values of a one-document block."""
    start, end, at = V.words(data, off)
    f, _ = word_features(V.Spans(data).hash(start, end), at, bits)
    c, _ = char_features(data, off, bits)
    fw, cw = np.unique(f, return_counts=True)
    fc, cc = np.unique(c, return_counts=True)
    x = np.concatenate([cw / np.sqrt(max(1, len(f))), cc / np.sqrt(max(1, len(c)))])
    return np.concatenate([fw, fc]).astype(np.int32), x.astype(np.float32)


def _fit(rows: list[tuple[int, int, np.ndarray, np.ndarray]], bits: int, epochs: int) -> tuple[np.ndarray, float, float, float]:
    """Weights, bias, and the slope and shift of the calibration; zeros unless both labels occur."""
    if len({r[1] for r in rows}) < 2:
        return np.zeros(1 << bits, np.float32), 0.0, 1.0, 0.0
    rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
    fold = np.arange(len(rows)) % 4 == 0  # held back for the calibration
    w, seen, bias, bias_seen, rate = np.zeros(1 << bits, np.float32), np.full(1 << bits, 1e-3, np.float32), 0.0, 1e-3, 0.3
    learn = np.flatnonzero(~fold)
    for epoch in range(epochs):
        for k in np.random.Generator(np.random.PCG64(epoch)).permutation(learn):
            _, y, f, x = rows[k]
            g = sigmoid(float(w[f] @ x) + bias) - y
            step = g * x + 1e-6 * w[f]
            seen[f] += step * step
            w[f] -= rate * step / np.sqrt(seen[f])
            bias_seen += g * g
            bias -= rate * g / np.sqrt(bias_seen)
    margin = np.array([float(w[r[2]] @ r[3]) + bias for r, held in zip(rows, fold, strict=True) if held])
    label = np.array([r[1] for r, held in zip(rows, fold, strict=True) if held], dtype=float)
    good, bad = label.sum(), len(label) - label.sum()
    if not good or not bad:
        return w, bias, 1.0, 0.0
    goal = np.where(label == 1, (good + 1) / (good + 2), 1 / (bad + 2))  # Platt's smoothed targets
    a, b = 1.0, 0.0
    for _ in range(200):  # Newton steps on two numbers
        p = sigmoid(a * margin + b)
        d, v = p - goal, np.maximum(p * (1 - p), 1e-6)
        g = np.array([d @ margin, d.sum()])
        hess = np.array([[v @ (margin * margin), v @ margin], [v @ margin, v.sum()]]) + 1e-3 * np.eye(2)
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(hess, g), -1, 1)
    return w, bias, float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, bits: int = BITS, epochs: int = 2) -> np.ndarray:
    """2**bits weights, then bias, slope and shift."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in V.blocks(b["text"], 1):  # a block per document
                f, x = _example(data, off, bits)
                columns = [b["doc_id"][i:j], b["y"][i:j].cast(pa.int32()), pa.array([f], pa.list_(pa.int32())), pa.array([x], pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "f", "x"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            for k, (doc, y) in enumerate(zip(b["doc_id"].to_pylist(), b["y"].to_pylist(), strict=True)):
                rows.append((doc, y, b["f"][k].values.to_numpy(), b["x"][k].values.to_numpy()))
        w, *rest = _fit(rows, bits, epochs)
        model = np.concatenate([w, rest]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], names=["w"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = labelled_sample(docs, labels, label, sample).mapInArrow(extract, f"doc_id {kind}, y int, f array<int>, x array<float>")
    row = found.repartition(1).mapInArrow(fit, "w binary").first()
    return np.frombuffer(row["w"], dtype=np.float32) if row else np.append(np.zeros((1 << bits) + 1), [1.0, 0.0]).astype(np.float32)


def judge(docs: DataFrame, model: np.ndarray, bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` (as struct ``_doc``, without its text) with the text as ``_text``, the
    five measures, base_failed, probability and kept."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits + 3 floats
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = docs.select(packed(docs.drop("text")), F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        weights, (bias, slope, shift) = w[: 1 << bits], (float(v) for v in w[1 << bits :])
        for b in batches:
            for i, j, data, off in V.blocks(b["_text"]):
                counts, (h, at) = measures(data, off)
                p = sigmoid(slope * (_scaled_sums(weights, data, off, h, at, bits) + bias) + shift)
                yield pa.RecordBatch.from_arrays(
                    [b["_doc"][i:j], b["_text"][i:j], *(pa.array(counts[c], pa.int64()) for c in names), pa.array(p)],
                    names=["_doc", "_text", *names, "probability"],
                )

    fields = [*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in names), T.StructField("probability", T.DoubleType())]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.mapInArrow(run, T.StructType(fields)).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= threshold)
    )


def keep_documents(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    kept = judge(docs, model).where("kept")
    return kept.select(*[F.col("_text").alias(c) if c == "text" else F.col(f"_doc.`{c}`") for c in docs.columns])
