"""The pipeline's stages against plain Python, each on what the stage before it kept."""

import hashlib
from collections import Counter

import brute
import corpus_pipeline
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyspark.llm import bpe, queries, rules
from tallyspark.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    out = [table(spark, sf_dir, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], sf_dir), name.replace(" ", "-")))
    return out


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "mixing sources", "byte-level BPE"]
    assert all(s.columns == COLUMNS for s in stages[:-1])


def test_rules_keep_what_passes(stages, spark, sf_dir):
    docs = stages[0]
    kept = {r[0] for r in rows(stages[1])}
    for doc, text, *_ in rows(docs):
        n, _, _, _, repeated = brute.base_rules(text)
        if n < 50 or 100 * repeated > 50 * n:
            assert doc not in kept
    judged = rules.judge(docs, rules.train(docs, table(spark, sf_dir, "labels")))
    assert kept == {r[0] for r in judged.where("kept").select("_doc.doc_id").collect()}
    good = table(spark, sf_dir, "labels").join(docs, "doc_id").where("quality = 1").select("doc_id", "text").collect()
    passed = [r["doc_id"] in kept for r in good if brute.base_rules(r["text"])[0] >= 50]
    assert sum(passed) > 0.95 * len(passed)


def test_lines(stages):
    want = brute.cut_lines([r[:2] for r in rows(stages[1])])
    left = sorted((r[0], t) for r in rows(stages[1]) if (t := want[(r[0], r[1])]) == r[1] or brute.words(t))
    assert sorted(r[:2] for r in rows(stages[2])) == left


def test_near_copies(stages):
    docs = rows(stages[2])
    roots = brute.components([brute.fingerprint(r[1]) for r in docs])
    least = {}
    for r, c in zip(docs, roots, strict=True):
        least[c] = min(least.get(c, r[0]), r[0])
    assert sorted(r[0] for r in rows(stages[3])) == sorted(least.values())


def test_mix(stages):
    docs, mixed = rows(stages[3]), rows(stages[4])
    assert set(mixed) <= set(docs) and max(Counter(mixed).values()) <= 2
    sizes, taken = Counter(), Counter()
    for r in docs:
        sizes[r[3]] += len(brute.words(r[1]))
    for r in mixed:
        taken[r[3]] += len(brute.words(r[1]))
    goal = brute.targets(sizes)
    longest = max(len(brute.words(r[1])) for r in docs)
    assert all(abs(taken[s] - goal[s]) <= longest + 512 for s in sizes)


def test_tokens(stages):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for doc, text, lang, source, _ in rows(stages[4]):
        ids = enc.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append(str((doc, lang, source, len(ids), ids, digest, hashlib.sha256(text.encode()).hexdigest())))
    assert sorted(want) == sorted(str(tuple(r)) for r in stages[5].collect())


def test_registered_query(spark, sf_dir, stages):
    out = queries.queries()["pipeline"](spark, sf_dir)
    assert sorted(map(str, out.collect())) == sorted(map(str, stages[5].collect()))


def test_awkward_documents(spark, sf_dir):
    docs = spark.createDataFrame(brute.awkward_documents(), brute.COLUMNS).withColumns({"_doc": F.lit("clash"), "shard": F.lit(1), "a.b": F.lit(2)})
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.collect() == []
        docs = staged(stage(spark, docs, sf_dir), "awkward")
        assert docs.count() > 0, name
