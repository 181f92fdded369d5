"""Bucketed range joins equal the nested-loop answer: sub-day bounds, NULLs, ties, any width."""

import random
from datetime import datetime, timedelta

import pytest

from tallyspark.operators import intervals


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(3)
    start = datetime(2023, 12, 30)

    def moment():
        t = start + timedelta(seconds=rnd.choice([0, 3600, 86_400, rnd.randint(0, 800_000)]), microseconds=rnd.choice([0, 0, 1, 999_999]))
        return None if rnd.random() < 0.04 else t

    points = [(i, rnd.choice([None, 0, 0, 0, 1, 2]), moment()) for i in range(300)]
    points += [(1000 + i, 0, datetime(1969, 12, 31, 23, 59, 59)) for i in range(3)]
    asked = []
    for i in range(200):
        low = moment()
        high = None if low is None or rnd.random() < 0.04 else low + timedelta(seconds=rnd.choice([-5, 0, 1, 60, 4000, 86_400, 300_000]))
        asked.append((i, rnd.choice([None, 0, 1, 2, 3]), low, high))
    asked += [(300, 0, datetime(1969, 12, 31, 23), datetime(1970, 1, 1)), (301, 3, datetime(1969, 1, 1), datetime(1970, 1, 1))]
    return (
        spark.createDataFrame(points, "p long, k long, at timestamp_ntz"),
        spark.createDataFrame(asked, "i long, k long, lo timestamp_ntz, hi timestamp_ntz"), points, asked,
    )


def nested_loop(points, asked):
    return sorted((p, i) for p, k, at in points for i, k2, lo, hi in asked if None not in (k, at, lo, hi) and k == k2 and lo <= at <= hi)


@pytest.mark.parametrize("width", [1, 977, 86_400, 10_000_000])
def test_equals_the_nested_loop(tables, width):
    points, asked, p, a = tables
    if width == 1:  # a row per second and interval: only the short ones
        asked, a = asked.where("hi < lo + interval 2 minutes"), [r for r in a if None not in r[2:] and r[3] - r[2] < timedelta(minutes=2)]
    want = nested_loop(p, a)
    got = intervals.interval_join(points, asked, ["k"], "at", "lo", "hi", width)
    assert sorted((r["p"], r["i"]) for r in got.collect()) == want and want
    hit = {i for _, i in want}
    some = intervals.with_point(points, asked, ["i"], ["k"], "at", "lo", "hi", width)
    none = intervals.without_point(points, asked, ["i"], ["k"], "at", "lo", "hi", width)
    assert some.columns == none.columns == asked.columns
    assert {r["i"] for r in some.collect()} == hit
    assert sorted(r["i"] for r in none.collect()) == sorted(r[0] for r in a if r[0] not in hit)


def test_empty(tables):
    points, asked, _, a = tables
    assert intervals.interval_join(points.limit(0), asked, ["k"], "at", "lo", "hi").collect() == []
    assert intervals.without_point(points.limit(0), asked, ["i"], ["k"], "at", "lo", "hi").count() == len(a)
