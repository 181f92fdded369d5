"""The distributed ranking operators equal Spark's built-in window functions, on data with a hot
group, heavy ties, NULL groups and NULL, negative and fractional values."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators import ranking


def _data(spark, seed, n=500):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = 0 if rnd.random() < 0.34 else rnd.choice([None, *range(1, 12)])  # group 0 is hot
        v = None if rnd.random() < 0.05 else Decimal(rnd.choice([100, 200, 200, 0, 800, 800, -300, rnd.randint(-90000, 500000)])) / 100
        rows.append((i, g, v))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "id long, g long, v decimal(18,2)")


def _same(a, b, cols):
    ra = sorted(str(tuple(r[c] for c in cols)) for r in a.collect())
    rb = sorted(str(tuple(r[c] for c in cols)) for r in b.collect())
    assert ra == rb


def test_value_buckets_keep_the_order(spark):
    rnd = random.Random(1)
    values = sorted({0, 1, -1, *(rnd.randint(-(10**16), 10**16) // 10 ** rnd.randint(0, 16) for _ in range(5000))})
    df = spark.createDataFrame([(Decimal(v) / 100,) for v in values], "v decimal(18,2)")
    got = [r[0] for r in df.orderBy("v").select(ranking.value_bucket(F.col("v"))).collect()]
    assert got == sorted(got) and len(set(got)) <= 7500
    for c, sign in [(d, 1) for d in ranking.digits(F.col("v"))] + [(d, -1) for d in ranking.digits(F.col("v"), True)]:
        places = [sign * r[0] for r in df.orderBy("v").select(c).collect()]
        assert places == sorted(places)
    close = spark.createDataFrame([(Decimal(10**9 + k),) for k in range(200)], "v decimal(18,2)")  # a billionth apart
    assert close.select(ranking.value_radix(F.col("v"))).distinct().count() > 100


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_dense_rank_equals_builtin(spark, by, descending):
    df = _data(spark, 3)
    got = ranking.dense_rank(df, "v", "r", descending=descending, by=by)
    o = F.col("v").desc() if descending else F.col("v").asc()
    w = Window.partitionBy(*by).orderBy(o) if by else Window.orderBy(o)
    _same(got, df.withColumn("r", F.dense_rank().over(w).cast("long")), ["id", "g", "r"])


@pytest.mark.parametrize("tiles", [1, 3, 7, 20])
@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_top_bucket_equals_ntile(spark, tiles, limit):
    df = _data(spark, 5)
    got = ranking.top_bucket(df, "v", "id", tiles, limit=limit, ids_per_leaf=7).select("id")
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    want = df.withColumn("b", F.ntile(tiles).over(Window.orderBy(*order))).where("b = 1").select("id")
    _same(got, want, ["id"])


@pytest.mark.parametrize("tiles", [1, 3, 7, 20, 499, 500, 501, 2000])
def test_every_tile_equals_ntile(spark, tiles):
    df = _data(spark, 15)
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    want = df.withColumn("b", F.ntile(tiles).over(Window.orderBy(*order)))
    _same(ranking.ntile(df, "v", "id", tiles, "b", limit=20, ids_per_leaf=9), want, ["id", "b"])


@pytest.mark.parametrize("limit", [1_000_000, 30, 2])
@pytest.mark.parametrize("descending", [True, False])
def test_positions_in_groups(spark, limit, descending):
    df = _data(spark, 16)
    w = Window.partitionBy("g")
    o = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    want = df.withColumns({"i": F.row_number().over(w.orderBy(o, "id")), "n": F.count(F.lit(1)).over(w)})
    got = ranking.positions(df, "v", "id", "i", "n", ["g"], descending, limit, 5)
    _same(got, want, ["id", "g", "i", "n"])
    tiles = df.withColumn("b", F.ntile(4).over(w.orderBy(o, "id")))
    _same(ranking.ntile(df, "v", "id", 4, "b", ["g"], descending, limit, 5), tiles, ["id", "g", "b"])


@pytest.mark.parametrize("limit", [100, 5, 1])
@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("descending", [True, False])
def test_crowded_buckets_are_refined(spark, limit, by, descending):
    """Values within one percent (one first digit), some within a millionth, with ties and NULL."""
    rnd = random.Random(limit)
    values = [Decimal(10**8 + rnd.choice([rnd.randint(0, 10**5), rnd.randint(0, 60)])) / 100 for _ in range(400)]
    df = spark.createDataFrame([(i, i % 2, v if i % 50 else None) for i, v in enumerate(values)], "id long, g long, v decimal(18,2)")
    assert df.where("v is not null").select(ranking.value_bucket(F.col("v"))).distinct().count() == 1
    o = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    w = Window.partitionBy(*by).orderBy(o) if by else Window.orderBy(o)
    got = ranking.dense_rank(df, "v", "r", descending, by, limit=limit)
    _same(got, df.withColumn("r", F.dense_rank().over(w).cast("long")), ["id", "r"])


def test_percent_rank_equals_builtin(spark):
    df = _data(spark, 6)
    want = df.withColumn("pr", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_first())))
    for threshold in (0.0, 0.3, 0.95):
        got = ranking.percent_rank_at_least(df, F.col("v"), threshold, "pr")
        _same(got, want.where(F.col("pr") >= threshold), ["id", "pr"])
    one = df.where("id = 7")
    assert ranking.percent_rank_at_least(one, F.col("v"), 0.0, "pr").first()["pr"] == 0.0


def test_percent_rank_of_counts(spark):
    df = _data(spark, 8)
    got = ranking.percent_rank_of_counts(df, ["g"], "v", "pr")
    want = df.withColumn("pr", F.percent_rank().over(Window.partitionBy("g").orderBy(F.col("v").asc_nulls_first())))
    _same(got, want, ["id", "g", "pr"])


def test_median_rows(spark):
    df = _data(spark, 9)
    w = Window.partitionBy("g")
    want = df.select(
        "g", "v", F.row_number().over(w.orderBy(F.col("v").asc_nulls_first())).alias("i"), F.count(F.lit(1)).over(w).alias("n")
    ).where("i = (n + 1) div 2 or i = (n + 2) div 2")
    _same(ranking.median_rows(df, ["g"], "v"), want, ["g", "v"])


def test_empty(spark):
    df = _data(spark, 1).limit(0)
    assert ranking.dense_rank(df, "v", "r").collect() == []
    assert ranking.top_bucket(df, "v", "id", 4).collect() == []
    assert ranking.percent_rank_at_least(df, F.col("v"), 0.5, "pr").collect() == []
