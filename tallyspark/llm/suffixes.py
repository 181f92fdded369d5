"""Suffix-array dedup (operator 6): every byte that a repeated string of ``length`` bytes covers.

A logarithmic family of sparse suffix arrays. Of every window of ``length`` bytes one suffix is
indexed: the one that starts at the window's minimum-hash ``GRAM``-gram, ``MARGIN`` bytes or more
from the window's ends. Equal windows choose equal suffixes, so windows are compared by the
suffixes they chose; about 1.5 % of all suffixes are held (all of them would take eight times the
text). An entry is

* ``key``: the indexed suffix's order: its first three bytes, then a fingerprint of the context
  that all its windows share (the gram and its margins);
* ``w``: a fingerprint of the union of the windows that chose the suffix;
* ``n``: how many places have that key and w.

A batch of documents gives a sorted run (level 0). A run is merge-scanned against all levels for
keys that occur again, and levels of equal rank are merged, so a family of b batches has at
most log2(b) + 1 levels and an entry is rewritten log2(b) times; levels that were merged are deleted. Matches tell, of each entry
whose key repeats, whether its whole union repeats (``full``) or its key has several unions
(``mixed``), where only some of the windows may repeat.

Documents then look their own entries up. Full unions are removed as they are. Of mixed ones the
bytes of the unions (under 2 * length) are brought together by key, each different union once, and windows compared by
64-bit fingerprints inside the key: one task for a key's different unions, or, beyond ``HOT`` unions of
one key, one row for each window, so that no task holds a hot key. Positions are judged on
the input text.

Equality rests on the key's and the union's or window's fingerprints together (over 100 bits).

Defined results: null text is an empty text; texts shorter than ``length`` never change; a null
doc_id is a document like any other; ids may be of any type; an empty table gives no rows; texts of any length are
read whole, long ones in parts; other columns are ignored; rows with equal doc_id and text are two documents whose texts
repeat each other; periodic text repeats itself where windows overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import vectext as V
from tallyspark.llm.common import discard, staged

LENGTH, GRAM, MARGIN = 200, 16, 8
#: Unions of one key that one task compares; keys with more are compared window by window.
HOT = 20_000
BATCHES = 3
FULL, PARTNER, SINGLE = 0, 1, 2


def entries(data: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """key, w, position, bytes from the first window's start, bytes from the last window's start."""
    none = np.zeros(0, np.int64)
    n = len(data)
    end = np.repeat(off[1:], np.diff(off))
    start = np.flatnonzero(np.arange(n) + length <= end)
    if not len(start):
        return none, none, none, none, none
    spans = V.Spans(data)
    gram = V.mix((spans.prefix[GRAM:] - spans.prefix[:-GRAM]) * spans.inverse[: n - GRAM + 1])
    # The minimum over a window's inner positions, the leftmost of equals, by doubling.
    low = (gram >> np.uint64(32) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)
    width, reach = length - 2 * MARGIN - GRAM + 1, 1
    while 2 * reach <= width:
        low, reach = np.minimum(low[:-reach], low[reach:]), 2 * reach
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    chosen = (low[start + MARGIN] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(first[1:], len(chosen)) - 1
    at, begin, stop = chosen[first], start[first], start[last]
    context = spans.hash(at - MARGIN, at + GRAM + MARGIN)
    s = at - MARGIN
    lead = (data[s].astype(np.uint64) << np.uint64(16)) | (data[s + 1].astype(np.uint64) << np.uint64(8)) | data[s + 2]
    key = ((lead << np.uint64(40)) | (context >> np.uint64(24))).view(np.int64)
    union = V.Spans(data, 1).hash(begin, stop + length)
    w = V.mix(union + (at - begin).astype(np.uint64)).view(np.int64)
    return key, w, at, at - begin, at - stop


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, (did, th) which name the document without nulls, text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        "doc_id", (F.xxhash64("doc_id") if isinstance(docs.schema["doc_id"].dataType, T.StringType)
                   else F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))).alias("did"),
        F.xxhash64(F.col("doc_id").isNull(), text).alias("th"), text.alias("text"),
    )


def _blocks(texts: pa.Array, length: int, block: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, position of the first byte in it, bytes and offsets of blocks of texts. A long text comes in
    parts that overlap by ``length`` - 1 bytes, so every window lies in one of them; its windows choose
    the same suffixes, and a union that a border cuts is two unions of one key."""
    for i, _, data, off in V.blocks(texts, block):
        if len(data) <= block + length:
            yield i, 0, data, off
            continue
        for a in range(0, len(data) - length + 1, block):
            part = data[a : a + block + length - 1]
            yield i, a, part, np.array([0, len(part)])


def _indexed(docs: DataFrame, length: int, block: int) -> DataFrame:
    """(key, w) of every entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, off in _blocks(b["text"], length, block):
                key, w, *_ = entries(data, off, length)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(w)], names=["key", "w"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "key long, w long")


class SuffixFamily:
    """Levels (rank, sorted run) and the matches found so far."""

    def __init__(self, spark: SparkSession, length: int = LENGTH, block: int = V.BLOCK) -> None:
        self.spark, self.length, self.block = spark, length, block
        self.levels: list[tuple[int, DataFrame]] = []
        self.found: list[DataFrame] = []

    def add(self, docs: DataFrame) -> DataFrame:
        """Index a batch; its matches: (key, w, full) of every entry whose key the batch repeats."""
        run = _indexed(docs, self.length, self.block).groupBy("key", "w").agg(F.count(F.lit(1)).alias("n"))
        run = staged(run.sortWithinPartitions("key", "w"), "suffix-run")
        matches = staged(self._scan(run), "suffix-matches")
        self.found.append(matches)
        self.levels.append((0, run))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a), (_, b) = self.levels.pop(), self.levels.pop()
            merged = a.union(b).groupBy("key", "w").agg(F.sum("n").alias("n")).sortWithinPartitions("key", "w")
            self.levels.append((rank + 1, staged(merged, "suffix-level")))
            discard(a, b)
        return matches

    def discard(self) -> None:
        """Delete the family's tables; what ``repeated`` returned stays."""
        discard(*[level for _, level in self.levels], *self.found)
        self.levels, self.found = [], []

    def _scan(self, run: DataFrame) -> DataFrame:
        every = run.withColumn("new", F.lit(1))
        for _, level in self.levels:
            every = every.union(level.withColumn("new", F.lit(0)))
        again = (
            every.groupBy(F.col("key").alias("_k")).agg(F.sum("n").alias("_n"), F.max("new").alias("_new")).where("_n > 1 and _new = 1")
        )
        again = staged(again, "suffix-keys")  # so that the join can split a hot key
        rows = every.join(again, F.col("key") == F.col("_k"), "left_semi")
        return rows.groupBy("key", "w").agg((F.sum("n") > 1).alias("full"))

    def repeated(self, hot: int = HOT) -> DataFrame:
        """key, w, kind (FULL, PARTNER: full with other unions of the key, SINGLE) and hot."""
        every = self.found[0]
        for more in self.found[1:]:
            every = every.union(more)
        known = staged(every.groupBy("key", "w").agg(F.max("full").alias("full")), "suffix-known")
        unions = staged(known.groupBy(F.col("key").alias("_k")).agg(F.count(F.lit(1)).alias("_u")), "suffix-unions")
        kind = F.when(~F.col("full"), SINGLE).when(F.col("_u") > 1, PARTNER).otherwise(FULL)
        return staged(
            known.join(unions, F.col("key") == F.col("_k")).select("key", "w", kind.cast("tinyint").alias("kind"), (F.col("_u") > hot).alias("hot")),
            "suffix-repeated",
        )


def _located(rows: DataFrame, length: int, block: int) -> DataFrame:
    """did, th, key, w and ``at``: position, and bytes to the last and to the first window's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            did, th = b["did"].to_numpy(), b["th"].to_numpy()
            for i, behind, data, off in _blocks(b["text"], length, block):
                key, w, at, first, last = entries(data, off, length)
                doc = np.searchsorted(off, at, side="right") - 1
                packed = ((at - off[doc] + behind) << 24) | (last << 12) | first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(did[i + doc]), pa.array(th[i + doc]), pa.array(key), pa.array(w), pa.array(packed)], names=["did", "th", "key", "w", "at"]
                )

    return rows.select("did", "th", "text").mapInArrow(run, "did long, th long, key long, w long, at long")


def _unpacked(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, and start and end of the union of windows."""
    p = at >> 24
    return p, p - (at & 0xFFF), p - ((at >> 12) & 0xFFF) + length


def merged_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that the spans cover (touching spans are one run)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]


def _kept(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    parts, at = [], 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    return b"".join(parts)


_RESULT = [
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())),
    T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType()),
]


def _result(text: bytes, start: np.ndarray, end: np.ndarray, with_kept: bool) -> tuple:
    start, end = merged_spans(start, end)
    left = _kept(text, start, end)
    spans = np.stack([start, end], axis=1).ravel().tolist()
    return len(text), len(text) - len(left), spans, hashlib.sha256(left).hexdigest(), left if with_kept else None


def _assembled(rows: DataFrame, length: int, with_kept: bool) -> DataFrame:
    """Documents with their matches (``m``): finished ones, open ones, and edges (unions to compare).

    An open document has a union of which only some windows may repeat.
    """
    fields = [
        T.StructField("part", T.StringType()), rows.schema["doc_id"], T.StructField("did", T.LongType()), T.StructField("th", T.LongType()), *_RESULT,
        T.StructField("z", T.BinaryType()), T.StructField("key", T.LongType()), T.StructField("w", T.LongType()), T.StructField("hot", T.BooleanType()),
        T.StructField("single", T.BooleanType()), T.StructField("at", T.LongType()), T.StructField("bytes", T.BinaryType()),
    ]
    schema = T.StructType(fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        unpack = zstandard.ZstdDecompressor()
        sent: set[tuple[int, int]] = set()  # unions that this task has already given as partners
        for b in batches:
            out: list[tuple] = []
            size = 0
            m = b["m"]
            bounds = m.offsets.to_numpy()
            field = {f: m.values.field(f).to_numpy(zero_copy_only=False) for f in ("at", "kind", "hot", "key", "w")}
            ids, dids, ths = b["doc_id"].to_pylist(), b["did"].to_numpy(), b["th"].to_numpy()
            for k, z in enumerate(b["z"].to_pylist()):
                lo, hi = bounds[k], bounds[k + 1]
                text = unpack.decompress(z)
                kind = field["kind"][lo:hi]
                p, start, end = _unpacked(field["at"][lo:hi], length)
                for e in np.flatnonzero(kind != FULL).tolist():
                    i = lo + e
                    single = bool(kind[e] == SINGLE)
                    if not single:
                        name = (int(field["key"][i]), int(field["w"][i]))
                        if name in sent:
                            continue
                        if len(sent) > 1_000_000:
                            sent.clear()
                        sent.add(name)
                    piece = text[start[e] : end[e]]
                    size += len(piece)
                    out.append(("edge", None, int(dids[k]), int(ths[k]), None, None, None, None, None, None, int(field["key"][i]), int(field["w"][i]),
                                bool(field["hot"][i]), single, int(field["at"][i]), piece))
                whole = kind != SINGLE
                if whole.all():
                    r = _result(text, start, end, with_kept)
                    size += len(text) if with_kept else 0
                    out.append(("done", ids[k], None, None, *r, None, None, None, None, None, None, None))
                else:
                    a, z_ = merged_spans(start[whole], end[whole])
                    size += len(z)
                    spans = np.stack([a, z_], axis=1).ravel().tolist()
                    out.append(("open", ids[k], int(dids[k]), int(ths[k]), None, None, spans, None, None, z, None, None, None, None, None, None))
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), arrow, strict=True)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), arrow, strict=True)], names=names)

    return rows.mapInArrow(run, schema)


def _windows(b: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of edges: row of each window, its start in the document, its fingerprint."""
    data, off = V.buffer(b["bytes"])
    data, off = data[off[0] : off[-1]], off - off[0]
    count = np.diff(off) - length + 1
    row = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = off[:-1][row] + nth
    _, start, _ = _unpacked(b["at"].to_numpy(), length)
    h = V.Spans(data, 1).hash(at, at + length)
    return row, start[row] + nth, h


def _repeated_in_key(key: np.ndarray, name: np.ndarray) -> np.ndarray:
    """For each window, whether its key has another of the same fingerprint."""
    order = np.lexsort((name, key))
    same = (key[order[1:]] == key[order[:-1]]) & (name[order[1:]] == name[order[:-1]])
    out = np.zeros(len(key), dtype=bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def _different(edges: DataFrame) -> DataFrame:
    """The edges with each partner union once, whatever number of tasks gave it."""
    one = F.any_value(F.struct("did", "th", "at", "bytes"))
    partners = edges.where("not single").groupBy("key", "w", "hot", "single").agg(one.alias("e")).select("key", "hot", "single", "e.*")
    columns = ["key", "hot", "single", "did", "th", "at", "bytes"]
    return edges.where("single").select(*columns).unionByName(partners.select(*columns))


def _compared(edges: DataFrame, length: int) -> DataFrame:
    """did, th, spans: what repeats of the single unions, a key's unions being in one task."""
    ordered = edges.select("key", "did", "th", "single", "at", "bytes").repartition("key").sortWithinPartitions("key")

    def compare(b: pa.RecordBatch) -> pa.RecordBatch:
        row, start, name = _windows(b, length)
        hit = _repeated_in_key(b["key"].to_numpy()[row], name) & b["single"].to_numpy(zero_copy_only=False)[row]
        row, start = row[hit], start[hit]
        # Runs of neighbouring windows of one row are one span.
        new = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))[: len(row)]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1 if len(row) else first
        return pa.RecordBatch.from_arrays(
            [b["did"].take(pa.array(row[first])), b["th"].take(pa.array(row[first])), pa.array(start[first]), pa.array(start[last] + length)],
            names=["did", "th", "a", "z"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for big in batches:
            for i in range(0, len(big), 4000):
                b = big.slice(i, 4000)
                waiting.append(b)
                size += len(b)
                if size >= 4000:
                    table = pa.Table.from_batches(waiting).combine_chunks()
                    key = table["key"].to_numpy()
                    whole = int(np.searchsorted(key, key[-1], side="left"))  # the last key may go on
                    if whole:
                        yield compare(table.slice(0, whole).combine_chunks().to_batches()[0])
                    rest = table.slice(whole)
                    waiting, size = rest.to_batches(), 0
        if waiting:
            table = pa.Table.from_batches(waiting).combine_chunks()
            if len(table):
                yield compare(table.to_batches()[0])

    return ordered.mapInArrow(run, "did long, th long, a long, z long")


def _compared_by_window(edges: DataFrame, length: int) -> DataFrame:
    """The same for hot keys: a row for each window, compared by a grouped count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for i in range(0, len(big), 2000):
                b = big.slice(i, 2000)
                row, start, name = _windows(b, length)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [b["key"].take(take), b["did"].take(take), b["th"].take(take), b["single"].take(take), pa.array(name.view(np.int64)), pa.array(start)],
                    names=["key", "did", "th", "single", "h", "a"],
                )

    rows = edges.select("key", "did", "th", "single", "at", "bytes").mapInArrow(run, "key long, did long, th long, single boolean, h long, a long")
    again = rows.groupBy(F.col("key").alias("_k"), F.col("h").alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = staged(again, "suffix-windows")
    hit = rows.where("single").join(again, (F.col("key") == F.col("_k")) & (F.col("h") == F.col("_h")), "left_semi")
    return hit.select("did", "th", "a", (F.col("a") + length).alias("z"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, hot: int = HOT, with_kept: bool = True, block: int = V.BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (starts and ends of removed runs), kept_sha256 and ``kept``
    (the remaining bytes, unless switched off) of every row."""
    if not 2 * MARGIN + GRAM < length < 4096:
        raise ValueError(f"length must lie between {2 * MARGIN + GRAM} and 4096")
    spark = docs.sparkSession
    rows = _identified(docs)
    family = SuffixFamily(spark, length, block)
    for k in range(batches):
        family.add(rows.where(F.expr(f"pmod(th, {int(batches)}) = {k}")) if batches > 1 else rows)
    known = family.repeated(hot)
    family.discard()

    match = _located(rows, length, block).join(
        known.select(F.col("key").alias("_k"), F.col("w").alias("_w"), "kind", "hot"), (F.col("key") == F.col("_k")) & (F.col("w") == F.col("_w"))
    )
    # One list per document, bounded by the document.
    lists = match.groupBy(F.col("did").alias("_d"), F.col("th").alias("_t")).agg(
        F.collect_list(F.struct("at", "kind", "hot", "key", "w")).alias("m")
    ).select("_d", "_t", F.array_distinct("m").alias("m"))

    def shrink(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for b in batches_:
            z = pa.array([pack.compress(t.encode()) for t in b["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["did"], b["th"], z], names=["doc_id", "did", "th", "z"])

    small = rows.mapInArrow(shrink, T.StructType([rows.schema["doc_id"], rows.schema["did"], rows.schema["th"], T.StructField("z", T.BinaryType())]))
    empty = F.array().cast("array<struct<at:bigint,kind:tinyint,hot:boolean,key:bigint,w:bigint>>")
    joined = small.join(lists, (F.col("did") == F.col("_d")) & (F.col("th") == F.col("_t")), "left").withColumn("m", F.coalesce("m", empty))
    parts = staged(_assembled(joined.select("doc_id", "did", "th", "z", "m"), length, with_kept), "suffix-documents", "part")

    edges = _different(parts.where("part = 'edge'"))
    spans = _compared(edges.where("not hot"), length).union(_compared_by_window(edges.where("hot"), length))
    per_doc = spans.groupBy(F.col("did").alias("_d"), F.col("th").alias("_t")).agg(F.array_distinct(F.collect_list(F.struct("a", "z"))).alias("cut"))
    open_ = parts.where("part = 'open'").join(per_doc, (F.col("did") == F.col("_d")) & (F.col("th") == F.col("_t")), "left")

    def finish(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches_:
            out = []
            for z, spans_, cut in zip(b["z"].to_pylist(), b["spans"].to_pylist(), b["cut"].to_pylist(), strict=True):
                more = np.array([(c["a"], c["z"]) for c in cut or []], dtype=np.int64).reshape(-1, 2)
                both = np.concatenate([np.array(spans_, dtype=np.int64).reshape(-1, 2), more])
                out.append(_result(unpack.decompress(z), both[:, 0], both[:, 1], with_kept))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", *(f.name for f in _RESULT)]
            )

    schema = T.StructType([rows.schema["doc_id"], *_RESULT])
    finished = open_.select("doc_id", "z", "spans", "cut").mapInArrow(finish, schema)
    return parts.where("part = 'done'").select("doc_id", *(f.name for f in _RESULT)).union(finished)
