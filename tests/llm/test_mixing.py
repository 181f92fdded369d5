from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import mixing
from tallyspark.llm.common import staged


def check(rows, got):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    goal = brute.targets(dict(sizes))
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and bool(r["shards"]) == (r["taken"] > 0)
    taken = defaultdict(int)
    source_of = defaultdict(set)
    for r in rows:
        source_of[r[0]].add(r[3])
    for r in got:
        if len(source_of[r["doc_id"]]) == 1:
            (s,) = source_of[r["doc_id"]]
            assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(goal[s])
            taken[s] += r["taken"]
    return goal, taken


def test_targets_sizes_and_taken(spark):
    rows = [r for r in brute.awkward_documents() if r[0] is not None]
    docs = spark.createDataFrame(rows, brute.COLUMNS).withColumn("size", F.lit("x")).withColumn("_h", F.lit(1))
    got = mixing.Mix(docs).taken().collect()
    goal, taken = check(rows, got)
    for s, t in goal.items():
        assert abs(taken[s] - t) <= 0.5001, s
    again = mixing.Mix(docs).taken().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_small_blocks_and_many_sources(spark):
    rows = [(k, " ".join(brute.passage(k, 1 + k * 7 % 40)), "en", f"s{k * k % 23:02d}", 0) for k in range(400)]
    docs = staged(spark.createDataFrame(rows, brute.COLUMNS), "t")
    mix = mixing.Mix(docs)
    mix.block = 512
    goal, taken = check(rows, mix.taken().collect())
    assert all(abs(taken[s] - t) <= 0.5001 for s, t in goal.items())


def test_words_in_blocks_match_a_walk_over_the_line(spark):
    """Blocks of 512 words over one large source, some drawn twice: the same words as a plain walk."""
    rows = [(k, " ".join(brute.passage(k, 90)), "en", "a", 0) for k in range(120)] + [
        (1000 + k, " ".join(brute.passage(k, 50)), "en", "b", 0) for k in range(40)
    ]
    mix = mixing.Mix(spark.createDataFrame(rows, brute.COLUMNS))
    plan = {r["sid"]: r for r in mix.sources.collect()}
    lines = mix.documents.collect()
    taken = {r["doc_id"]: r["taken"] for r in mix.taken().collect()}
    for d in lines:
        p = plan[d["sid"]]
        n = 0
        for word in range(d["at"], d["at"] + d["size"]):
            k = word // mix.block
            rank = (k * mixing.PRIME + p["turn"]) % p["blocks"]
            last = min((k + 1) * mix.block, p["source_size"]) - (p["trim"] if rank == p["part"] - 1 else 0)
            n += p["passes"] + (rank < p["part"] and word < last)
        assert n == taken[d["doc_id"]]
    runs = {r["_sid"]: r["ends"] for r in mix.runs().collect()}
    assert all(ends[-1] == plan[sid]["quota"] for sid, ends in runs.items())
    for sid in plan:
        at = sorted((d["at"], d["size"]) for d in lines if d["sid"] == sid)
        assert [a for a, _ in at] == list(np.cumsum([0] + [s for _, s in at])[:-1])


def test_tree_deals_quotas_exactly_and_evenly(spark):
    quota = [1000, 0, 37, 1, 5000]
    one = spark.createDataFrame([(quota,)], "q array<long>")
    rows = {r["shard"]: r["q"] for r in mixing.splitting_tree(one, 13, 5).collect()}
    table = np.array([rows[k] for k in range(13)])
    assert sorted(rows) == list(range(13)) and (table >= 0).all()
    assert table.sum(axis=0).tolist() == quota
    assert table.sum(axis=1).max() - table.sum(axis=1).min() <= 1


def test_draws_are_hypergeometric(spark):
    """Mean and variance of one split over many seeds."""
    one = spark.createDataFrame([([60, 40],)], "q array<long>")
    left = [{r["shard"]: r["q"] for r in mixing.splitting_tree(one, 2, s).collect()}[0][0] for s in range(30)]
    # 50 of 100 drawn, 60 of a kind: mean 30, variance 50 * .6 * .4 * 50 / 99 = 6.06
    assert abs(np.mean(left) - 30) < 2 and 2 < np.var(left) < 15


def test_documents_of_the_mix(spark):
    rows = [(k, " ".join(brute.passage(k, 200)), "en", "abc"[k % 3] if k % 2 else "a", 7) for k in range(300)]
    docs = spark.createDataFrame(rows, brute.COLUMNS).withColumn("shard", F.lit("clash"))
    out = mixing.Mix(docs, keep_documents=True, shards=5).rows().collect()
    goal = brute.targets({s: 200 * sum(r[3] == s for r in rows) for s in "abc"})
    for s, t in goal.items():
        assert abs(sum(200 for r in out if r["_doc"]["source"] == s) - t) <= 0.05 * t + 1024
    assert {r["shard"] for r in out} == set(range(5))
    assert all(r["_doc"]["shard"] == "clash" for r in out)
    count = defaultdict(int)
    for r in out:
        count[r["_doc"]["doc_id"]] += 1
    assert max(count.values()) <= 2


def test_empty(spark):
    docs = spark.createDataFrame([], brute.COLUMNS)
    assert mixing.Mix(docs).taken().collect() == []
    assert mixing.Mix(docs, keep_documents=True).rows().collect() == []
    blank = spark.createDataFrame([(1, None, None, None, None), (2, " ", None, "a", 1)], brute.COLUMNS)
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.Mix(blank).taken().collect()] == [(0, 0.0, 0)] * 2


def test_groups_of_sources_deal_exactly_and_evenly(spark):
    """Four levels of groups of three: every quota is used up and every shard takes its share."""
    quota = [k * 37 % 101 for k in range(40)]
    q = spark.createDataFrame(list(enumerate(quota)), "sid long, quota long")
    rooms = {r["sid"]: r["room"] for r in mixing.dealt(q, 40, 13, 5, fanout=3).collect()}
    table = np.array([rooms[k] for k in range(40)])
    assert sorted(rooms) == list(range(40)) and (table >= 0).all()
    assert table.sum(axis=1).tolist() == quota
    assert table.sum(axis=0).max() - table.sum(axis=0).min() <= 1


def test_groups_draw_like_one_group(spark):
    """Mean and variance of a member's draw, taken by way of its group, over many groups alike."""
    q = spark.createDataFrame([(k, 6 if k % 2 else 4) for k in range(600)], "sid long, quota long")
    left = [r["room"][0] for r in mixing.dealt(q, 600, 2, 3, fanout=25).collect() if r["sid"] % 2]
    # 1500 of 3000 drawn, 6 of a kind: mean 3, variance 1.5
    assert len(left) == 300 and abs(np.mean(left) - 3) < 0.3 and 1.1 < np.var(left) < 2


def test_more_sources_than_one_row_holds(spark):
    """20,100 sources, null and empty among them, and one with several parts: targets are met."""
    rows = [(k, " ".join(["w"] * (1 + k % 7)), "en", None if k == 3 else "" if k == 4 else f"d{k}.example", 0) for k in range(20_100)]
    rows += [(100_000 + k, "a b c", "en", "d9.example", 0) for k in range(9_000)]
    docs = spark.createDataFrame(rows, brute.COLUMNS).repartition(4)
    mix = mixing.Mix(docs, shards=4)
    goal, taken = check(rows, mix.taken().collect())
    assert len(goal) == 20_100 and all(abs(taken[s] - t) <= 0.5001 for s, t in goal.items())
    assert len(mix.runs().collect()) == 20_100


def test_default_shards_are_dealt_by_the_tree(spark):
    """A small table has 64 shards: each takes as many blocks as the others and its documents name it."""
    rows = [(k, " ".join(brute.passage(k, 400)), "en", "abc"[k % 3], 0) for k in range(300)]
    mix = mixing.Mix(spark.createDataFrame(rows, brute.COLUMNS))
    goal, taken = check(rows, got := mix.taken().collect())
    assert all(abs(taken[s] - t) <= 0.5001 for s, t in goal.items())
    assert {x for r in got for x in r["shards"]} == set(range(64))
    ends = np.array([r["ends"] for r in mix.runs().collect()])
    dealt = np.diff(ends, axis=1, prepend=0)
    assert (dealt >= 0).all() and np.ptp(dealt.sum(axis=0)) <= 1


def test_what_is_taken_does_not_depend_on_other_sources(spark):
    """A source whose target is its own cap gives the same words whatever the other sources hold."""
    own = [(k, " ".join(brute.passage(k, 30 + k % 50)), "en", "a", 0) for k in range(120)]
    runs = []
    for others in (300, 4_000):
        rows = own + [(10_000 + k, " ".join(["w"] * 200), "en", f"z{k % 3}", 0) for k in range(others)]
        mix = mixing.Mix(spark.createDataFrame(rows, brute.COLUMNS))
        assert (mix.block, mix.shards) == (mixing.BLOCK, mixing.SHARDS)
        runs.append({r["doc_id"]: r["taken"] for r in mix.taken().where("doc_id < 1000").collect()})
    assert runs[0] == runs[1] and sum(runs[0].values()) == 2 * sum(len(r[1].split()) for r in own)


def test_block_size_bounds_a_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PRIME", 7)
    docs = spark.createDataFrame([(1, "w " * 100, "en", "a", 0)], brute.COLUMNS)
    with pytest.raises(ValueError, match="blocks must be larger"):
        mixing.Mix(docs, block=10)
    assert mixing.Mix(docs, block=100).taken().first()["taken"] == 150


def test_no_cross_join(spark):
    import contextlib
    import io

    docs = spark.createDataFrame([(k, "a b c", "en", f"s{k % 3}", 0) for k in range(20)], brute.COLUMNS)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        mixing.Mix(docs).taken().explain()
    assert "NestedLoopJoin" not in out.getvalue() and "CartesianProduct" not in out.getvalue()
