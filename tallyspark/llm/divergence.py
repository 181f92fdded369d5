"""Source divergence audit (operator 11): iceberg prefix refinement, then exact smoothed shares.

A term is a maximal run of letters A-Z, a-z and characters beyond ASCII, A-Z lower-cased; in UTF-8 that is
a run of bytes, so texts are handled as bytes. A language keeps the terms of at least
``MIN_DOCS`` of its documents (a document is a row).

Kept terms come from prefix refinement. Level k looks at prefixes of ``FIRST`` * 2**k bytes. It counts,
for each (lang, prefix), the documents that hold a term going on beyond it, and for each term that ends
within the level the documents and occurrences. Prefixes of fewer than ``MIN_DOCS`` documents are
discarded with all terms that start with them; what is left of each text (its longer terms) is written and the next level
reads that. The last level is the one that leaves no prefix. Terms that ended are kept if their own
count reaches the threshold.

Tasks learn which prefixes survive from a bitmap of ``BITS`` bits, whose size does not follow the
data. A prefix that only shares a bit with a survivor goes one level further and fails there on the
exact count, so the result does not depend on ``BITS``. Counts are added up inside tasks, over blocks of whole documents of about
``WORDS_AN_ENTRY`` * ``ENTRIES`` words, before they are shuffled; no row leaves a task for each word.

Divergences use integers only. For the pairs of sources, kept terms are dealt to blocks of about
``BLOCK`` terms, each block adds up all pairs of its language's sources, and the sums meet by pair:
no task holds a language, and a term of every source is one row of a block's matrix.

Defined results: null text, lang and source are ''; repeated rows are documents of their own; a text without terms still makes its
(lang, source) occur; a language without kept terms has its pairs at value 0 and no terms; terms of any length are whole;
ties rank by item; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import LOWER, UPPER, staged

MIN_DOCS = 3
FIRST = 8
BITS = 1 << 26
ENTRIES, WORDS_AN_ENTRY = 400_000, 6
BLOCK = 512
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Bytes of a long text that are cut into words at once.
PIECE = 1 << 20

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_COUNTS = "lang string, source string, item binary, complete boolean, docs long, occurrences long"


def words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, lower-cased, in lists of at most about ``PIECE`` bytes."""
    text = text.translate(_LETTERS)
    at = 0
    while len(text) - at > PIECE:
        end = text.find(b" ", at + PIECE)
        if end < 0:
            break
        yield text[at:end].split()
        at = end
    yield (text[at:] if at else text).split()


def prefix_hash(lang: str, prefix: bytes) -> int:
    return zlib.crc32(prefix, zlib.crc32(lang.encode() + b"\0"))


def _as_rows(docs: DataFrame) -> DataFrame:
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(name("lang"), name("source"), name("text").cast("binary").alias("text"))


def _rows(b: pa.RecordBatch) -> Iterator[tuple[str, str, bytes]]:
    texts = b["text"]
    for i, (lang, source) in enumerate(zip(b["lang"].to_pylist(), b["source"].to_pylist(), strict=True)):
        yield lang, source, texts[i].as_py()


class Survivors(dict):
    """Whether the bit of a language's prefix is set; a prefix is hashed once."""

    def __init__(self, lang: str, alive: bytes, bits: int) -> None:
        self.lang, self.alive, self.bits = lang, alive, bits

    def __missing__(self, prefix: bytes) -> bool:
        bit = prefix_hash(self.lang, prefix) % self.bits
        found = self[prefix] = bool(self.alive[bit >> 3] >> (bit & 7) & 1)
        return found


def refine(state: DataFrame, alive: bytes, bits: int, length: int) -> DataFrame:
    """Rows of ``state`` cut to their terms of more than ``length`` bytes whose prefix of that length
    has its bit set; rows without such a term go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Survivors] = {}
        for b in batches:
            out: list[tuple[str, str, bytes]] = []
            size = 0
            for lang, source, text in _rows(b):
                left: list[bytes] = []
                for part in words(text):
                    if lang not in known:
                        known[lang] = Survivors(lang, alive, bits)
                    survives = known[lang]
                    left += [w for w in part if len(w) > length and survives[w[:length]]]
                    if sum(map(len, known.values())) > ENTRIES:
                        known.clear()
                if left:
                    out.append((lang, source, b" ".join(left)))
                    size += len(out[-1][2])
                    if size > PIECE:
                        yield _batch(out)
                        out, size = [], 0
            if out:
                yield _batch(out)

    return state.mapInArrow(run, state.schema)


def _batch(rows: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
    lang, source, text = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(source), pa.array(text, pa.binary())], names=["lang", "source", "text"])


def level_counts(state: DataFrame, length: int) -> DataFrame:
    """(lang, source, item, complete, docs, occurrences): terms of at most ``length`` bytes, and
    prefixes of that length (source null) of the longer terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, sizes, groups, held = [], [], [], 0
            for lang, source, text in _rows(b):
                n = 0
                for part in words(text):
                    parts.append(pa.array(part, pa.binary()))
                    n += len(part)
                sizes.append(n)
                groups.append((lang, source))
                held += n
                if held > WORDS_AN_ENTRY * ENTRIES:
                    yield from _block_counts(parts, sizes, groups, length)
                    parts, sizes, groups, held = [], [], [], 0
            if held:
                yield from _block_counts(parts, sizes, groups, length)

    sums = [F.sum(c).cast("long").alias(c) for c in ("docs", "occurrences")]
    return state.mapInArrow(run, _COUNTS).groupBy("lang", "source", "item", "complete").agg(*sums)


def _block_counts(parts: list[pa.Array], sizes: list[int], groups: list[tuple[str, str]], length: int) -> Iterator[pa.RecordBatch]:
    """The counts of a block of documents: its terms ``parts``, and the number of terms and (lang, source) of each."""
    terms = pa.chunked_array(parts, pa.binary()).combine_chunks().dictionary_encode()
    code, different = terms.indices.to_numpy().astype(np.int64), terms.dictionary
    doc = np.repeat(np.arange(len(sizes)), sizes)
    long = pc.binary_length(different).to_numpy() > length
    is_long = long[code]

    places: dict[tuple[str, str], int] = {}
    group = np.array([places.setdefault(g, len(places)) for g in groups])
    at, item, docs, occurrences = _distinct(group, code[~is_long], doc[~is_long], len(different))
    for k, (lang, source) in enumerate(places):
        a, b = np.searchsorted(at, [k, k + 1])
        if a < b:
            yield _counted(lang, source, different.take(pa.array(item[a:b])), True, docs[a:b], occurrences[a:b])

    cut = pc.binary_slice(different.filter(pa.array(long)), 0, length).dictionary_encode()
    prefix = np.zeros(len(different), dtype=np.int64)
    prefix[long] = cut.indices.to_numpy()
    langs: dict[str, int] = {}
    group = np.array([langs.setdefault(lang, len(langs)) for lang, _ in groups])
    at, item, docs, _ = _distinct(group, prefix[code[is_long]], doc[is_long], len(cut.dictionary))
    for k, lang in enumerate(langs):
        a, b = np.searchsorted(at, [k, k + 1])
        if a < b:
            yield _counted(lang, None, cut.dictionary.take(pa.array(item[a:b])), False, docs[a:b], np.zeros(b - a, np.int64))


def _distinct(group: np.ndarray, item: np.ndarray, doc: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, item, documents, occurrences) of the items that stand in documents, in the order of group and item."""
    n = len(group)  # documents of the block
    keys = np.sort((group[doc] * items + item) * n + doc)
    pair = keys // n
    start = np.flatnonzero(np.diff(pair, prepend=-1))
    occurrences = np.diff(start, append=len(keys))
    docs = np.add.reduceat((np.diff(keys, prepend=-1) != 0).astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    return pair[start] // max(1, items), pair[start] % max(1, items), docs, occurrences


def _counted(lang: str, source: str | None, items: pa.Array, complete: bool, docs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    k = len(items)
    columns = [
        pa.repeat(pa.scalar(lang, pa.string()), k), pa.repeat(pa.scalar(source, pa.string()), k), items,
        pa.repeat(pa.scalar(complete), k), pa.array(docs, pa.int64()), pa.array(n, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "complete", "docs", "occurrences"])


def alive_bits(survivors: DataFrame, bits: int) -> bytes | None:
    """The bitmap of the survivors' hashes: at most ``bits`` / 8 bytes reach the driver. None without
    survivors."""
    at = F.crc32(F.concat(F.col("lang").cast("binary"), F.lit(b"\0"), F.col("item"))) % bits + 1
    pages = (
        survivors.select(at.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        .collect()
    )
    if not pages:
        return None
    size = len(pages[0]["bits"])
    out = bytearray(max(bits // 8, size))
    for r in pages:
        out[(r["page"] - 1) * size : r["page"] * size] = r["bits"]
    return bytes(out)


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS, first: int = FIRST, bits: int = BITS) -> DataFrame:
    """(lang, source, term, n, lang_n) of the kept terms: occurrences in the source's texts and in all
    of the language's."""
    state, length, levels = _as_rows(docs), first, []
    while True:
        counts = staged(level_counts(state, length), "op11-level")
        levels.append(counts.where("complete").select("lang", "source", "item", "docs", "occurrences"))
        alive = alive_bits(counts.where(~F.col("complete") & (F.col("docs") >= min_docs)), bits)
        if alive is None:
            break
        state = staged(refine(state, alive, bits, length), "op11-state")
        length *= 2
    ended = levels[0]
    for more in levels[1:]:
        ended = ended.unionByName(more)
    totals = ended.groupBy("lang", "item").agg(F.sum("docs").alias("docs"), F.sum("occurrences").cast("long").alias("lang_n"))
    kept = totals.where(F.col("docs") >= min_docs).drop("docs")
    rows = ended.join(kept, ["lang", "item"])
    return rows.select("lang", "source", F.col("item").cast("string").alias("term"), F.col("occurrences").alias("n"), "lang_n")


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + v)), exact; null where there is no kept term."""
    wide = (n + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    quotient = F.call_function("div", wide, F.nullif(total + v, F.lit(0)).cast("decimal(19,0)"))
    return 1 + quotient


def _pair_sums(key: tuple, terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of f over a block's terms for all pairs of the language's sources."""
    names = sources["source"].to_pylist()
    place = {s: i for i, s in enumerate(names)}
    distinct: dict[str, int] = {}
    rows = [distinct.setdefault(t, len(distinct)) for t in terms["term"].to_pylist()]
    p = np.tile(sources["p0"].to_numpy().astype(np.int64), (len(distinct), 1))
    p[rows, [place[s] for s in terms["source"].to_pylist()]] = terms["p"].to_numpy().astype(np.int64)
    source, item, value = [], [], []
    for i, s in enumerate(names if distinct else []):
        d = p[:, i : i + 1] - p
        source += [s] * (len(names) - 1)
        item += names[:i] + names[i + 1 :]
        value.append(np.delete((d * d // p).sum(axis=0), i))
    values = np.concatenate(value) if value else np.zeros(0, np.int64)
    columns = [pa.array([key[0].as_py()] * len(source), pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(values)]
    return pa.Table.from_arrays(columns, names=["lang", "source", "item", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, first: int = FIRST, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair', every other source of the language by its
    divergence; part 'term', the ``top_terms`` kept terms that the source uses more than its language."""
    counts = staged(term_counts(docs, min_docs, first, bits), "op11-terms")
    per_lang = counts.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("lang_n").cast("long").alias("lang_total")
    )
    per_source = counts.groupBy("lang", "source").agg(F.sum("n").cast("long").alias("total"))
    zero = F.lit(0).cast("long")
    groups = _as_rows(docs).select("lang", "source").distinct().join(per_lang, "lang", "left").join(per_source, ["lang", "source"], "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("v", "lang_total", "total")])
    groups = staged(groups.withColumn("p0", share(zero, F.col("total"), F.col("v"))), "op11-groups")

    seen = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    above = seen.withColumn("q", q).where(F.col("p") > F.col("q"))
    term = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))

    n_blocks = F.ceil(F.col("v") / F.lit(block)).cast("long")
    terms = seen.select("lang", F.call_function("pmod", F.xxhash64("term"), n_blocks).alias("block"), "term", "source", "p")
    sources = groups.where("v > 0").select("lang", "source", "p0", F.explode(F.sequence(zero, n_blocks - 1)).alias("block"))
    sums = terms.groupBy("lang", "block").cogroup(sources.groupBy("lang", "block")).applyInArrow(
        _pair_sums, "lang string, source string, item string, value long"
    )
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(other, "lang").where(F.col("source") != F.col("item"))
    pairs = pairs.join(sums, ["lang", "source", "item"], "left")
    pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(order).alias("rank")
    best = term.select("*", rank).where(F.col("rank") <= top_terms)
    return best.unionByName(pair.select("*", rank))


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t
  FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}
), vocab AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), grp AS (
  SELECT DISTINCT lang, source FROM d
), seen AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w SEMI JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY ALL
), sizes AS (
  SELECT lang, source, sum(n) AS total FROM seen GROUP BY lang, source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n,
         1 + {SCALE}::HUGEINT * (coalesce(s.n, 0) + 1) // (coalesce(z.total, 0) + v.v) AS p,
         1 + {SCALE}::HUGEINT * (k.n + 1) // (v.total + v.v) AS q
  FROM grp g JOIN kept k ON g.lang = k.lang JOIN vocab v ON v.lang = g.lang
  LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
  LEFT JOIN sizes z ON z.lang = g.lang AND z.source = g.source
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM listed
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
