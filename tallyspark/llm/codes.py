"""Vector code compression (operator 13): product quantisation with memoised grid cells.

A vector's components become integers floor(256 * x), the vector is cut into ``PARTS`` equal parts, and
each part position has a codebook of ``ENTRIES`` entries. Entries start as the parts of the rows with the
smallest ids; each round assigns every part to its nearest entry (squared distance, ties to the lower
index) and replaces an entry by the floor of its parts' mean.

Nearest entries are found through a grid. A part's cell is its components divided by ``CELL``; over the
cell's box every entry has a smallest and a largest possible distance. An entry is dominated if its smallest
distance exceeds another's largest: it cannot be nearest (or tie) anywhere in the box. The other
entries are remembered for the cell, in each task, and only these are evaluated exactly for the parts
that fall into it. The memory holds at most ``CELLS`` cells a part position and starts anew beyond that, which changes no result.

Tasks add up counts and component sums per (position, entry) before they are shuffled; the driver holds the
codebooks, PARTS * ENTRIES short vectors, whatever the number of rows. Assignments are written once and read by
both sides of the join that adds a label's error.

Defined results: rows whose vector is null or holds null or non-finite components go, and so do rows whose length is not that of
most smallest ids' vectors (the kept row with the smallest id decides) or not a multiple of ``PARTS``; null ids come first, and rows of one id
are ordered by their vector; fewer than ``ENTRIES`` rows make smaller codebooks; null labels are one label; repeated
rows keep a row each; an empty table gives no rows; components are exact up to 2**28 / 256 in size, larger ones raise
an error; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import staged

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
CELL = 32
CELLS = 50_000
#: Largest whole component: a part of 64 components then keeps squared distances below 2**63.
LARGEST = 1 << 28
#: Vectors handled at once.
ROWS = 1024


class GridCells:
    """Nearest entries of one codebook (entries x components, whole numbers)."""

    def __init__(self, entries: np.ndarray, cell: int = CELL, cells: int = CELLS) -> None:
        self.entries, self.cell, self.cells = entries, cell, cells
        self.known: dict[bytes, int] = {}  # cell -> its row of ``candidates``
        self.candidates: list[np.ndarray] = []
        self.evaluated = 0

    def _remember(self, corners: np.ndarray) -> None:
        """Keep each new cell's entries that are not dominated across its box."""
        low = (corners * self.cell)[:, None, :]
        high = low + (self.cell - 1)
        e = self.entries[None, :, :]
        outside = np.maximum(np.maximum(low - e, e - high), 0)
        farthest = np.maximum(np.abs(e - low), np.abs(high - e))
        least, most = (outside * outside).sum(axis=2), (farthest * farthest).sum(axis=2)
        keep = least <= most.min(axis=1, keepdims=True)
        for corner, row in zip(corners, keep, strict=True):
            self.known[corner.tobytes()] = len(self.candidates)
            self.candidates.append(np.flatnonzero(row))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row, and its squared distance."""
        corners, member = np.unique(np.floor_divide(x, self.cell), axis=0, return_inverse=True)
        member = member.reshape(-1)
        keys = [c.tobytes() for c in corners]
        if len(self.known) + len(keys) > self.cells:
            self.known.clear()
            self.candidates.clear()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            self._remember(corners[new])
        lists = [self.candidates[self.known[k]] for k in keys]
        sizes = np.array([len(c) for c in lists])
        first = np.cumsum(sizes) - sizes
        n = sizes[member]  # candidates of each row
        at = np.cumsum(n) - n
        row = np.repeat(np.arange(len(x)), n)
        entry = np.concatenate(lists)[np.arange(n.sum()) - np.repeat(at - first[member], n)]
        d = x[row] - self.entries[entry]
        d = np.einsum("ij,ij->i", d, d)
        self.evaluated += len(d)
        best = np.minimum.reduceat(d, at)
        hit = np.flatnonzero(d == np.repeat(best, n))  # candidates are in index order: the first hit has the lowest
        rows, where = np.unique(row[hit], return_index=True)
        return entry[hit[where]], best


def _vectors(b: pa.RecordBatch) -> np.ndarray:
    """The whole numbers of a batch's vectors (rows x components)."""
    flat = b["v"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = np.floor(flat * SCALE)
    if len(v) and np.abs(v).max() > LARGEST:
        raise ValueError(f"a component is larger than {LARGEST // SCALE}")
    return v.astype(np.int64).reshape(len(b), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for i in range(0, len(b), ROWS):
            part = b.slice(i, ROWS)
            yield part, _vectors(part)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, v (doubles), label of the rows whose vector is whole and finite and as long as that of
    the kept row with the smallest id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector).cast("array<double>")
    kept = rows.select("vec_id", v.alias("v"), "label").where(v.isNotNull() & F.forall(v, finite) & (F.size(v) > 0) & (F.size(v) % PARTS == 0))
    first = kept.orderBy("vec_id", "v").limit(1).select(F.size("v").alias("n")).collect()  # one number
    return kept.where(F.size("v") == (first[0]["n"] if first else 0))


def first_codebooks(kept: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """(position, entry, component) from the ``entries`` rows with the smallest ids."""
    rows = kept.orderBy("vec_id", "v").limit(entries).select("v").collect()
    if not rows:
        return np.zeros((PARTS, 0, 0), np.int64)
    whole = np.floor(np.array([r["v"] for r in rows], dtype=np.float64) * SCALE)
    if np.abs(whole).max() > LARGEST:
        raise ValueError(f"a component is larger than {LARGEST // SCALE}")
    return np.ascontiguousarray(whole.astype(np.int64).reshape(len(rows), PARTS, -1).transpose(1, 0, 2))


def retrain(kept: DataFrame, books: np.ndarray, cell: int = CELL) -> np.ndarray:
    """One round: every entry becomes the componentwise floor of its parts' mean; unused ones stay."""
    n_entries, width = books.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [GridCells(book, cell) for book in books]
        count = np.zeros((PARTS, n_entries), np.int64)
        total = np.zeros((PARTS, n_entries, width), np.int64)
        for _, v in _blocks(batches):
            for p, grid in enumerate(grids):
                x = v[:, p * width : (p + 1) * width]
                code, _ = grid.nearest(x)
                np.add.at(total[p], code, x)
                count[p] += np.bincount(code, minlength=n_entries)
        part, entry = np.nonzero(count)
        component = np.tile(np.arange(width), len(part))
        part, entry = np.repeat(part, width), np.repeat(entry, width)
        columns = [part, entry, component, count[part, entry], total[part, entry, component]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "component", "n", "total"])

    sums = kept.select("v").mapInArrow(run, "part long, entry long, component long, n long, total long")
    sums = sums.groupBy("part", "entry", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out = books.copy()
    for r in sums.collect():  # at most a row for each number of the codebooks
        out[r["part"], r["entry"], r["component"]] = r["total"] // r["n"]
    return out


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def assign(kept: DataFrame, books: np.ndarray, cell: int = CELL) -> DataFrame:
    """vec_id, label, code (binary, a byte a part), error of every row."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [GridCells(book, cell) for book in books]
        for b, v in _blocks(batches):
            codes = np.empty((len(v), PARTS), np.uint8)
            error = np.zeros(len(v), np.int64)
            for p, grid in enumerate(grids):
                codes[:, p], d = grid.nearest(v[:, p * width : (p + 1) * width])
                error += d
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["label"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    fields = [kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    return kept.select("vec_id", "v", "label").mapInArrow(run, T.StructType(fields))


def compress(rows: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, cell: int = CELL) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every kept row; the codebooks)."""
    kept = usable(rows)
    books = first_codebooks(kept, entries)
    for _ in range(rounds if books.size else 0):
        books = retrain(kept, books, cell)
    return assign(kept, books, cell), books


def codes(rows: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, cell: int = CELL) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256."""
    found, books = compress(rows, rounds, entries, cell)
    found = staged(found, "op13-codes")
    by_label = found.groupBy(F.col("label").alias("_l")).agg(F.sum("error").cast("long").alias("label_error"))
    both = found.join(by_label, F.col("label").eqNullSafe(F.col("_l")))
    return both.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql(parts: int, entries: int, rounds: int) -> str:
    nearest = """
a{k} AS (
  SELECT s.r, s.p, arg_min(b.e, d * {entries} + b.e) AS e, min(d) AS d
  FROM slices s JOIN b{k} b ON s.p = b.p,
  LATERAL (SELECT list_sum(list_transform(list_zip(s.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d)
  GROUP BY s.r, s.p
)"""
    moved = """
m{k} AS (
  SELECT p, e, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY c) AS x
  FROM (SELECT a.p, a.e, i.c, sum(s.x[i.c]) AS t, count(*) AS n
        FROM a{k} a JOIN slices s ON a.r = s.r AND a.p = s.p, LATERAL (SELECT unnest(range(1, len(s.x) + 1)) AS c) i GROUP BY ALL)
  GROUP BY p, e
), b{j} AS (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e
)"""
    steps = [nearest.format(k=0, entries=entries)]
    for k in range(rounds):
        steps += [moved.format(k=k, j=k + 1), nearest.format(k=k + 1, entries=entries)]
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), slices AS (
  SELECT r, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x FROM kept, range({parts}) AS t(p)
), b0 AS (
  SELECT p, r - 1 AS e, x FROM slices WHERE r <= {entries}
), {", ".join(steps)}
SELECT kept.vec_id, f.code, f.error, CAST(sum(f.error) OVER (PARTITION BY kept.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN (
  SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r
) f ON kept.r = f.r
"""


SQL = _sql(PARTS, ENTRIES, ROUNDS)
