"""SimHash near-dedup (operator 10): fingerprints, a binary-trie self-join, components.

Fingerprint: A-Z lower-cased words, shingles of ``shingle`` words joined by one space (a shorter text is
one shingle; no word: zero), XXH64 with seed 42 of each; a bit is 1 if more than half of the
shingles set it. Equal fingerprints are one node from then on, whatever the number of copies.

Links: two fingerprints within ``distance`` bits agree on at least two of distance + 2 blocks of
bits, so each goes to one bucket for every pair of blocks. A bucket is a binary trie: sorted
fingerprints, a node being a run with a common prefix. Node pairs are traversed together from the
root's pair with itself; a step adds the differing bits, and a pair is pruned when they pass
``distance``. The traversal is exact, and no link is lost whatever a bucket's size; a bucket
beyond ``HOT_BUCKET`` is cut again by its other bits before. A task gives a spanning forest of a
bucket's links (fewer rows than fingerprints); alternating stars join those to components.

Defined results: null and empty texts have fingerprint zero and link to each other; null doc_ids
rank last in a component (all null: component_id is null); repeated rows link; an empty table gives no rows; texts of any
length are read whole; other columns are ignored, or kept by ``near_dedup`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import vectext as V
from tallyspark.llm.common import packed, staged
from tallyspark.llm.components import connected

SHINGLE, DISTANCE, SEED = 3, 3, 42
HOT_BUCKET = 50_000
#: Shingles that are hashed at once.
AT_ONCE = 100_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def block_fingerprints(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprints (uint64) of a block's documents."""
    start, end, at = V.words(data, off)
    out = np.zeros(len(off) - 1, dtype=np.uint64)
    if not len(start):
        return out
    # The words, one space between: bytes of words, and of the white space after a word the first.
    space = V._SPACE[data]
    keep = ~space
    behind = end[end < len(data)]
    keep[behind] = True
    place = np.zeros(len(keep) + 1, dtype=np.int32 if len(keep) < 2**31 else np.int64)
    np.cumsum(keep, out=place[1:])
    line = _LOWER[data]
    line[space] = 32
    line = line[keep].tobytes()
    first, last = place[start], place[end - 1] + 1
    n = np.diff(at)
    doc = V.owners(at)
    k = np.arange(len(start))
    begins = np.flatnonzero((k + shingle <= at[1:][doc]) | ((n[doc] < shingle) & (k == at[:-1][doc])))
    ends = np.minimum(begins + shingle, at[1:][doc[begins]]) - 1
    digest = xxhash.xxh64_intdigest
    total = np.bincount(doc[begins], minlength=len(out))
    counts = np.zeros((len(out), 64), dtype=np.int64)
    for i in range(0, len(begins), AT_ONCE):  # a long text's shingles are never all in memory
        some, until = begins[i : i + AT_ONCE], ends[i : i + AT_ONCE]
        h = np.array([digest(line[a:b], SEED) for a, b in zip(first[some].tolist(), last[until].tolist(), strict=True)], dtype=np.uint64)
        of = doc[some]
        here = np.flatnonzero(np.diff(of, prepend=-1))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts[of[here]] += np.add.reduceat(bits, here, axis=0, dtype=np.int64)
    out[:] = np.packbits(2 * counts > total[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, th (a hash of the text) and fp of every row."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in V.blocks(b["text"]):
                fp = block_fingerprints(data, off, shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([b["doc_id"][i:j], b["th"][i:j], pa.array(fp)], names=["doc_id", "th", "fp"])

    fields = [rows.schema["doc_id"], rows.schema["th"], T.StructField("fp", T.LongType())]
    return rows.mapInArrow(run, T.StructType(fields))


def trie_links(bucket: np.ndarray, fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of one bucket within ``distance`` bits; rows are sorted by (bucket, fp).

    A frontier holds node pairs [a, b) x [c, d) with the bits that differ so far; a step splits all
    nodes of a frontier at one bit. Large frontiers are cut in two, so memory stays bounded.
    """
    edge = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1 if len(bucket) else 0)) if len(bucket) else np.zeros(0, np.int64)
    a, b = edge, np.append(edge[1:], len(bucket))
    many = b - a > 1
    stack = [(63, a[many], b[many], a[many], b[many], np.zeros(int(many.sum()), np.int8))]
    ones = {}

    def split(bit: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if bit not in ones:
            ones.clear()  # bits are visited downwards within a frontier
            ones[bit] = np.concatenate([[0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        return hi - (ones[bit][hi] - ones[bit][lo])

    while stack:
        bit, a, b, c, d, bad = stack.pop()
        while len(a):
            own = a == c
            alone = (b - a == 1) & (d - c == 1)
            if alone.any():  # two fingerprints: their distance decides
                x, y = a[alone & ~own], c[alone & ~own]
                near = np.bitwise_count(fp[x] ^ fp[y]) <= distance
                yield x[near], y[near]
                rest = ~alone
                a, b, c, d, bad, own = a[rest], b[rest], c[rest], d[rest], bad[rest], own[rest]
            if bit < 0 or not len(a):
                # What is left has equal fingerprints inside a node: one link of each pair tells all.
                yield a[~own], c[~own]
                break
            if len(a) > 1 << 18:
                half = len(a) // 2
                stack.append((bit, a[half:], b[half:], c[half:], d[half:], bad[half:]))
                a, b, c, d, bad, own = a[:half], b[:half], c[:half], d[:half], bad[:half], own[:half]
            m, n = split(bit, a, b), split(bit, c, d)
            parts = [(a, m, c, n, bad), (m, b, n, d, bad), (a, m, n, d, bad + 1)]
            other = ~own
            parts.append((m[other], b[other], c[other], n[other], bad[other] + 1))
            a, b, c, d, bad = (np.concatenate(x) for x in zip(*parts, strict=True))
            live = (a < b) & (c < d) & (bad <= distance)
            a, b, c, d, bad = a[live], b[live], c[live], d[live], bad[live].astype(np.int8)
            bit -= 1


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n items the smallest item that the pairs connect it to."""
    root = np.arange(n)
    for x, y in pairs:
        while True:
            low = np.minimum(root[x], root[y])
            if (root[x] == low).all() and (root[y] == low).all():
                break
            np.minimum.at(root, root[x], low)
            np.minimum.at(root, root[y], low)
            while (root != root[root]).any():
                root = root[root]
    return root


def _block_bits(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of distance + 2 blocks that cover 64 bits."""
    edges = [round(64 * i / (distance + 2)) for i in range(distance + 3)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def _field(lo: int, width: int) -> str:
    return f"(shiftrightunsigned(fp, {lo}) & {(1 << width) - 1}L)"


def bucketed(nodes: DataFrame, distance: int = DISTANCE, hot: int = HOT_BUCKET) -> DataFrame:
    """(key, fp): every fingerprint once for every pair of blocks, hot buckets cut again.

    A hot bucket's fingerprints already agree on two blocks; its other bits are cut into distance + 1
    parts, of which two fingerprints within ``distance`` share at least one.
    """
    blocks = _block_bits(distance)
    keys = [
        f"xxhash64({i}, {_field(*blocks[p])}, {_field(*blocks[q])})" for i, (p, q) in enumerate(combinations(range(len(blocks)), 2))
    ]
    rows = nodes.select("fp", F.posexplode(F.expr(f"array({', '.join(keys)})")).alias("pair", "key"))
    sizes = rows.groupBy(F.col("key").alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot)
    hot_keys = staged(sizes, "simhash-hot")
    if hot_keys.isEmpty():
        return rows.select("key", "fp")
    again = []
    for i, (p, q) in enumerate(combinations(range(len(blocks)), 2)):
        bits = [b for k, (lo, width) in enumerate(blocks) if k not in (p, q) for b in range(lo, lo + width)]
        cut = [bits[len(bits) * k // (distance + 1) : len(bits) * (k + 1) // (distance + 1)] for k in range(distance + 1)]
        masks = [sum(1 << b for b in part) for part in cut]
        signed = [m - (1 << 64) if m >> 63 else m for m in masks]
        parts = ", ".join(f"xxhash64(key, {k}, fp & {m}L)" for k, m in enumerate(signed))
        again.append(f"when pair = {i} then array({parts})")
    split = F.expr(f"case {' '.join(again)} end")
    joined = rows.join(hot_keys, F.col("key") == F.col("_k"), "left")
    return joined.select(F.explode(F.when(F.col("_k").isNull(), F.array("key")).otherwise(split)).alias("key"), "fp")


def links(nodes: DataFrame, distance: int = DISTANCE, hot: int = HOT_BUCKET, batch: int = 200_000) -> DataFrame:
    """(u, v): a spanning forest of every bucket's links between distinct fingerprints ``fp``."""
    rows = bucketed(nodes, distance, hot)
    ordered = rows.repartition("key").sortWithinPartitions("key", "fp")

    def join(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        flipped = fp.view(np.uint64) ^ np.uint64(1 << 63)  # signed order becomes the order of the bits
        root = forest(len(fp), trie_links(key, flipped, distance))
        own = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[own]), pa.array(fp[root[own]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, size = [], [], 0
        for b in batches:
            keys.append(b["key"].to_numpy())
            fps.append(b["fp"].to_numpy())
            size += len(b)
            if size >= batch:
                key, fp = np.concatenate(keys), np.concatenate(fps)
                whole = int(np.searchsorted(key, key[-1], side="left"))  # the last bucket may go on
                if whole:
                    yield join(key[:whole], fp[:whole])
                keys, fps, size = [key[whole:]], [fp[whole:]], len(key) - whole
        if size:
            yield join(np.concatenate(keys), np.concatenate(fps))

    return ordered.mapInArrow(run, "u long, v long")


def classes(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, hot: int = HOT_BUCKET) -> DataFrame:
    """doc_id, th, fp and ``best``: the first row (nulls last) of the row's component, as a struct."""
    prints = staged(fingerprints(docs, shingle), "simhash-fp")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("th").isNull().alias("blank"), F.col("th").alias("th"))
    nodes = staged(prints.groupBy("fp").agg(F.min(rank).alias("first")), "simhash-nodes")
    roots = connected(links(nodes, distance, hot), "simhash-stars")
    rooted = nodes.join(roots, F.col("fp") == F.col("u"), "left").select("fp", F.coalesce("v", "fp").alias("root"), "first")
    best = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("best"))
    per_print = rooted.join(best, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "best")
    return prints.join(per_print, F.col("fp") == F.col("_fp")).drop("_fp")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, hot: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fingerprint, component_id of every row."""
    return classes(docs, shingle, distance, hot).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best.id").alias("component_id")
    )


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` of which each is the first of its component."""
    key = [
        F.col("doc_id").isNull().alias("_none"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0)).alias("_th"),
    ]
    best = classes(docs, shingle, distance).select("best.*").distinct()
    stay = best.select(
        F.col("none").alias("_n"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("_i"), F.coalesce("th", F.lit(0)).alias("_t")
    ).distinct()
    rows = docs.select(packed(docs), *key)
    kept = rows.join(stay, (F.col("_none") == F.col("_n")) & (F.col("_id") == F.col("_i")) & (F.col("_th") == F.col("_t")), "left_semi")
    return kept.dropDuplicates(["_none", "_id", "_th"]).select("_doc.*")
