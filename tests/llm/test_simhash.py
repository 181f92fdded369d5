import random

import brute
import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import simhash
from tallyspark.llm.components import connected


def test_fingerprints_and_components(spark):
    rows = brute.awkward_documents()
    docs = spark.createDataFrame(rows, brute.COLUMNS).withColumns({"fp": F.lit("clash"), "th": F.lit(0), "best": F.lit(1)})
    prints = [brute.fingerprint(r[1]) for r in rows]
    roots = brute.components(prints)
    least = {}
    for r, c in zip(rows, roots, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted(str((r[0], f"{p:016x}", least.get(c))) for r, p, c in zip(rows, prints, roots, strict=True))
    for hot in (50_000, 1):
        assert sorted(str(tuple(r)) for r in simhash.simhash_components(docs, hot=hot).collect()) == want
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    assert {r["doc_id"] for r in kept.collect()} == {least.get(c) for c in roots}


def test_shingles_are_hashed_in_parts(monkeypatch):
    import pyarrow as pa

    from tallyspark.llm import vectext as V

    texts = [r[1] for r in brute.awkward_documents()]
    data, off = V.buffer(pa.array(texts))
    want = [brute.fingerprint(t) for t in texts]
    for size in (1, 7, 100_000):
        monkeypatch.setattr(simhash, "AT_ONCE", size)
        assert simhash.block_fingerprints(data, off).tolist() == want


def close_prints(n, seed):
    """Random fingerprints and neighbours of them at 1 to 5 bits."""
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(n)]
    out = set(base)
    for b in base:
        for bits in (1, 2, 3, 4, 5):
            x = b
            for k in r.sample(range(64), bits):
                x ^= 1 << k
            out.add(x)
    return sorted(out)


def test_links_lose_nothing(spark):
    prints = close_prints(150, 3) + list(range(64))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    want = brute.components(prints)
    groups = {}
    for s, c in zip(signed, want, strict=True):
        groups.setdefault(c, set()).add(s)
    for hot, batch in ((50_000, 200_000), (4, 50)):
        found = {r["u"]: r["v"] for r in connected(simhash.links(nodes, hot=hot, batch=batch)).collect()}
        got = {}
        for s in signed:
            got.setdefault(found.get(s, s), set()).add(s)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_trie_gives_each_pair_once():
    fp = np.array(sorted(close_prints(40, 9)), dtype=np.uint64)
    bucket = np.zeros(len(fp), np.int64)
    got = [(int(a), int(b)) for x, y in simhash.trie_links(bucket, fp, 3) for a, b in zip(x, y, strict=True)]
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if int(fp[i] ^ fp[j]).bit_count() <= 3}
    assert {(min(p), max(p)) for p in got} == want and len(got) == len(want)


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(300)] + [(1000, 1001)], "u long, v long")
    found = {r["u"]: r["v"] for r in connected(edges).collect()}
    assert found == {**{k: 0 for k in range(1, 301)}, 1001: 1000}


def test_a_star_and_its_rounds_are_deleted(spark):
    """A hub with many leaves is one component; only the last round's table stays."""
    import os

    from tallyspark.llm.common import shared_path

    edges = spark.createDataFrame([(5000, k) for k in range(2000)], "u long, v long")
    found = {r["u"]: r["v"] for r in connected(edges, "star-test").collect()}
    assert found == {**{k: 0 for k in range(1, 2000)}, 5000: 0}
    folder = os.path.dirname(shared_path(spark, "x"))
    assert sum(f.startswith("star-test") for f in os.listdir(folder)) == 1


def test_empty(spark):
    docs = spark.createDataFrame([], brute.COLUMNS)
    assert simhash.simhash_components(docs).collect() == [] and simhash.near_dedup(docs).collect() == []
