import random

import brute
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import queries, tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, rows, limit=1024):
    out = []
    for doc, text, *_ in rows:
        n = len(library.encode(text or "", add_special_tokens=False))
        out.append((doc, len((text or "").encode()), n, n > limit))
    return sorted(map(str, out))


def awkward():
    rnd = random.Random(5)
    rows = brute.awkward_documents()
    marks = ["<|endoftext|>", "<|endof", "text|>", "'re", "'ll", "'", "   ", "\n\n", "　", "  ", "12345", "日本語", "😀", "é", "don't", " we're", "|>", "A" * 90, " " * 70, "\t", "x"]
    for k in range(12):
        rows.append((800 + k, "".join(rnd.choice(marks) + rnd.choice(["", " ", "b"]) for _ in range(rnd.randint(30, 900))), "en", "s", 0))
    rows += [(900, "<|endoftext|>" * 150, "en", "s", 0), (901, "日本語" * 900, "ja", "s", 0), (902, " " * 2500, "", "", 0), (903, "a" * 2000 + " b " * 300, "", "", 0)]
    rows += [rows[-1]] * 3
    return rows


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 512), (100, 40), (64, 33), (257, 128)])
def test_equals_the_library(spark, library, chunk, overlap):
    rows = awkward()
    docs = spark.createDataFrame(rows, brute.COLUMNS).selectExpr("*", "1 AS key", "2 AS place", "3 AS n_bytes", "4 AS `a.b`", "5 AS whole")
    got = tokencount.count_tokens(docs, PATH, chunk, overlap, limit=90).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(str(tuple(r)) for r in got) == want(library, rows, 90)


def test_chunks_cover_the_text_and_overlap():
    for n in (1, 99, 100, 101, 139, 140, 141, 1000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        parts = list(tokencount.chunks(text, 100, 40))
        assert [p for p, _ in parts] == list(range(len(parts)))
        assert "".join(t[:100] for _, t in parts[:-1]) + parts[-1][1] == text
        assert all(len(t) == 140 for _, t in parts[:-1]) and (len(parts) == 1 or len(parts[-1][1]) > 40)


def test_alignment_fails_and_overlaps_widen(spark):
    """A piece longer than the overlap leaves no common place; wider chunks find one."""
    text = "word " * 40 + "k" * 500 + " word" * 200
    cut = tokencount._cut(spark.createDataFrame([(text,)], "text string"), 100, 40)
    first = tokencount._spliced(tokencount._seams(cut, PATH, 100, 40)).first()
    assert first["whole"] is False
    wide = tokencount._cut(spark.createDataFrame([(text,)], "text string"), 1600, 640)
    assert tokencount._spliced(tokencount._seams(wide, PATH, 1600, 640)).first()["whole"] is True


def test_a_chunk_that_begins_inside_a_special_string(spark, library):
    for shift in range(30):
        text = "a" * shift + " <|endoftext|>, <|endoftext|>" * 30
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string") if shift % 10 == 0 else None
        if docs is not None:
            assert tokencount.count_tokens(docs, PATH, 80, 40).first()["n_tokens"] == len(library.encode(text, add_special_tokens=False))


def test_empty_table(spark):
    assert tokencount.count_tokens(spark.createDataFrame([], brute.COLUMNS), PATH).collect() == []


def test_query_equals_the_library(spark, library, con, sf_dir):
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    got = queries.op12_token_counts(spark, sf_dir).collect()
    assert sorted(str(tuple(r)) for r in got) == want(library, rows)
