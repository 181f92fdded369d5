"""Split ledger windows equal plain per-account windows: NULL keys and dates, a hot account, hours
that are cut again, instants that are cut by id."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators import ledger


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(11)
    out = []
    start = datetime(2023, 1, 1)
    for i in range(700):
        acc = 0 if rnd.random() < 0.4 else rnd.choice([None, 1, 2, 3, 4, 5])  # account 0 is hot
        ts = start + timedelta(minutes=rnd.choice([0, 0, 7, 30, 61, 125, 600, 3000]) * rnd.randint(1, 40))
        if rnd.random() < 0.1:
            ts += timedelta(microseconds=rnd.choice([1, 250_000, 999_999]))
        if rnd.random() < 0.06:
            ts = None
        amt = None if rnd.random() < 0.05 else Decimal(rnd.randint(-5000, 5000)) / 100
        out.append((i, acc, ts, amt))
    rnd.shuffle(out)
    return spark.createDataFrame(out, "id long, acc long, ts timestamp_ntz, amt decimal(18,2)")


def order():
    return [F.col("ts").asc(), F.col("id").asc()]


AT = {"ts": "ts", "row_id": "id"}


def _same(a, b, cols):
    assert sorted(str(tuple(r[c] for c in cols)) for r in a.collect()) == sorted(str(tuple(r[c] for c in cols)) for r in b.collect())


@pytest.fixture(params=[(1_000_000, 1_000_000), (100, 50), (5, 3), (1, 1)], ids=["plain", "hot", "cut", "all cut"])
def split(rows, request):
    limit, ids = request.param
    return ledger.by_time(rows, "acc", "ts", "id", limit=limit, ids_per_leaf=ids)


def test_running_sums(rows, split):
    got = ledger.running_sums(split, "acc", {"run": F.col("amt"), "n": F.lit(1)}, **AT)
    w = Window.partitionBy("acc").orderBy(*order()).rowsBetween(Window.unboundedPreceding, 0)
    _same(got, rows.withColumns({"run": F.sum("amt").over(w), "n": F.count(F.lit(1)).over(w)}), ["id", "acc", "ts", "run", "n"])


def test_previous_values(rows, split):
    """LAG of any column and offset, several at once."""
    wanted = {"prev": ("ts", 1), "a1": ("amt", 1), "a2": ("amt", 2), "i3": ("id", 3)}
    got = ledger.previous_values(split, "acc", wanted, **AT)
    w = Window.partitionBy("acc").orderBy(*order())
    _same(got, rows.withColumns({n: F.lag(c, k).over(w) for n, (c, k) in wanted.items()}), ["id", "acc", "amt", *wanted])


def test_row_numbers_and_counts(rows, split):
    got = ledger.row_numbers(split, "acc", "i", "n", **AT)
    w = Window.partitionBy("acc")
    want = rows.withColumns({"i": F.row_number().over(w.orderBy(*order())), "n": F.count(F.lit(1)).over(w)})
    _same(got, want, ["id", "acc", "i", "n"])
    assert "n" not in ledger.row_numbers(split, "acc", "i", **AT).columns


@pytest.mark.parametrize("frame", [1, 3, 10])
def test_preceding_rows(rows, split, frame):
    x = split.withColumn("a", F.abs("amt"))
    got = ledger.preceding_rows_sum_count(x, "acc", "a", frame, "s", "n", **AT)
    w = Window.partitionBy("acc").orderBy(*order()).rowsBetween(-frame, -1)
    want = rows.withColumn("s", F.sum(F.abs("amt")).over(w)).withColumn("n", F.count(F.abs("amt")).over(w))
    _same(got, want, ["id", "acc", "s", "n"])


def test_leaves_stay_small(rows):
    x = ledger.by_time(rows, "acc", "ts", "id", limit=5, ids_per_leaf=3)
    leaf = F.col(ledger.LEAF)
    sizes = x.groupBy(ledger.LEAF).count()
    whole = sizes.where(leaf["_sp_1"].isNull() | ~leaf["_sp_1"]["l"])
    # An uncut account or hour has at most 5 rows, a cut one 3 ids of an instant; fractions of a second are one leaf.
    assert whole.agg(F.max("count")).first()[0] <= 5
    assert sizes.where(leaf["_sp_1"]["r"].isNotNull()).agg(F.max("count")).first()[0] <= 3
    # Accounts that are not crowded are one leaf, whatever their hours.
    one = ledger.by_time(rows, "acc", "ts", "id", limit=200)
    assert {r["hot"] for r in one.select("acc", leaf["hot"].alias("hot")).distinct().where("acc != 0").collect()} == {False}
    assert one.where("acc = 0").select(ledger.LEAF).distinct().count() > 50


def test_empty(rows):
    x = ledger.by_time(rows.limit(0), "acc", "ts", "id")
    assert ledger.running_sums(x, "acc", {"run": F.col("amt")}, **AT).collect() == []
    assert ledger.previous_values(x, "acc", {"p": ("amt", 2)}, **AT).collect() == []
