import random

import brute
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import suffixes


def result(rows):
    return sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]) // 2, r["kept_sha256"])) for r in rows)


@pytest.mark.parametrize(("batches", "hot"), [(3, 20_000), (1, 1), (5, 2)])
def test_awkward_documents(spark, batches, hot):
    rows = brute.awkward_documents()
    docs = spark.createDataFrame(rows, brute.COLUMNS).withColumns({"key": F.lit("clash"), "m": F.lit(1), "part": F.lit(2), "a.b": F.lit(3)})
    got = suffixes.remove_repeats(docs, batches=batches, hot=hot).collect()
    want = brute.removed([r[1] for r in rows], 200)
    assert result(got) == sorted(str((r[0], *w)) for r, w in zip(rows, want, strict=True))
    for r in got:
        spans = list(zip(r["spans"][::2], r["spans"][1::2], strict=True))
        assert sum(b - a for a, b in spans) == r["n_removed"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]


@pytest.mark.parametrize(("length", "seed"), [(60, 1), (200, 2), (333, 3)])
def test_spliced_texts(spark, length, seed):
    """Shared passages just under, at and over the length, at random places, some overlapping."""
    r = random.Random(seed)
    pool = [" ".join(brute.passage(900 + k, 120)) for k in range(6)]
    texts = []
    for k in range(60):
        t = " ".join(brute.passage(3000 + k, r.randint(0, 120)))
        for _ in range(r.randint(0, 3)):
            p = r.choice(pool)
            a = r.randint(0, len(p) - 2)
            piece = p[a : a + length + r.choice([-1, 0, 1, 40, -30, 200])]
            at = r.randint(0, len(t))
            t = t[:at] + piece + t[at:]
        texts.append(t)
    texts += ["ab" * 300, "abcabcabc" * 100, "z" * 999]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts)], brute.COLUMNS)
    for hot in (20_000, 3):
        got = suffixes.remove_repeats(docs, length=length, hot=hot, with_kept=False).collect()
        assert result(got) == sorted(str((k, *w)) for k, w in enumerate(brute.removed(texts, length)))


def test_family_levels_and_incremental_matches(spark):
    family = suffixes.SuffixFamily(spark)
    text = " ".join(brute.passage(5, 200))
    schema = "doc_id long, text string"
    ranks = []
    for k in range(7):
        words = brute.passage(60 + k, 200)
        found = family.add(spark.createDataFrame([(k, " ".join(words)), (100 + k, text if k in (2, 6) else "")], schema))
        ranks.append([rank for rank, _ in family.levels])
        assert (found.count() > 0) == (k == 6)
    assert ranks == [[0], [1], [1, 0], [2], [2, 0], [2, 1], [2, 1, 0]]
    for _, level in family.levels:
        assert level.count() == level.dropDuplicates(["key", "w"]).count()


def test_partner_unions_are_compared_once(spark):
    """A template copied over many tasks brings each of its unions once to the comparison."""
    r = random.Random(9)
    base = " ".join(brute.passage(70, 90))
    texts = [base] * 40 + [base[: 150 + 5 * k] + " ".join(brute.passage(400 + k, 30)) for k in range(20)]
    r.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12)
    edges = []
    kept, suffixes._different = suffixes._different, lambda e: edges.append((e, kept(e))) or edges[-1][1]
    try:
        got = suffixes.remove_repeats(docs, hot=5, with_kept=False).collect()
    finally:
        suffixes._different = kept
    assert result(got) == sorted(str((k, *w)) for k, w in enumerate(brute.removed(texts, 200)))
    before, after = edges[0]
    assert after.where("not single").count() == before.where("not single").select("key", "w").distinct().count() > 0


@pytest.mark.parametrize("block", [150, 2_000])
def test_long_texts_in_parts(spark, block):
    rows = brute.awkward_documents()
    rows += [(500 + k, " ".join(brute.passage(80 + k // 2, 900))[k * 7 :], "en", "s", 0) for k in range(4)]
    docs = spark.createDataFrame(rows, brute.COLUMNS)
    want = brute.removed([r[1] for r in rows], 200)
    for hot in (1_000, 2):
        got = suffixes.remove_repeats(docs, hot=hot, block=block, with_kept=False).collect()
        assert result(got) == sorted(str((r[0], *w)) for r, w in zip(rows, want, strict=True))


def test_fifty_megabytes_within_five_hundred():
    import tracemalloc

    import pyarrow as pa

    text = pa.array([" ".join(brute.passage(9, 20_000)) * 450])
    tracemalloc.start()
    n = sum(len(suffixes.entries(data, off)[0]) for _, _, data, off in suffixes._blocks(text, 200, 1 << 18))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 100_000 and peak < 500 << 20


def test_string_ids(spark):
    rows = brute.awkward_documents()
    docs = spark.createDataFrame(rows, brute.COLUMNS).withColumn("doc_id", F.concat(F.lit("id-"), F.col("doc_id")))
    want = brute.removed([r[1] for r in rows], 200)
    got = suffixes.remove_repeats(docs, with_kept=False).collect()
    assert result(got) == sorted(str((None if r[0] is None else f"id-{r[0]}", *w)) for r, w in zip(rows, want, strict=True))


def test_merged_levels_are_deleted(spark):
    family = suffixes.SuffixFamily(spark)
    docs = spark.createDataFrame([(1, " ".join(brute.passage(5, 200)))], "doc_id long, text string")
    family.add(docs)
    first = family.levels[0][1]
    assert first.inputFiles()
    family.add(docs)
    assert len(family.levels) == 1 and family.levels[0][1].count() > 0
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|DOES_NOT_EXIST|not exist"):
        first.collect()


def test_empty_and_bad_length(spark):
    docs = spark.createDataFrame([], brute.COLUMNS)
    assert suffixes.remove_repeats(docs).collect() == []
    with pytest.raises(ValueError):
        suffixes.remove_repeats(docs, length=20)
