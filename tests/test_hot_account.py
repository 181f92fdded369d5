"""A third of the ledger on one account at one instant, broadcasts off: the largest task's rows, read
from Spark's event log, stay near the limit of a leaf."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ROWS, LIMIT = 60_000, 1_000

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession, functions as F
from tallyspark.operators import ledger
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", sys.argv[1])
    .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
    .config("spark.sql.shuffle.partitions", "64").config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .config("spark.sql.adaptive.coalescePartitions.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
hot = F.col("id") % 3 == 0
rows = spark.range({ROWS}).select("id", F.when(hot, 0).otherwise(F.col("id") % 900 + 1).alias("acc"),
    F.when(hot, F.lit("2024-01-01 00:00:00")).otherwise(F.concat(F.lit("2024-02-01 "), F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":00:00")))
    .cast("timestamp_ntz").alias("ts"), F.lit(1).cast("decimal(18,2)").alias("amt"))
at = {{"ts": "ts", "row_id": "id"}}
x = ledger.by_time(rows, "acc", "ts", "id", limit={LIMIT}, ids_per_leaf={LIMIT})
run = ledger.running_sums(x, "acc", {{"run": F.col("amt")}}, **at)
print(run.where("acc = 0").agg(F.max("run"), F.count("run")).first())
numbers = ledger.row_numbers(x, "acc", "i", "n", **at).where("acc = 0")
print(numbers.agg(F.max("i"), F.sum("i"), F.min("n")).first())
prev = ledger.previous_values(x, "acc", {{"prev": ("ts", 1)}}, **at)
last = ledger.preceding_rows_sum_count(x, "acc", "amt", 10, "s", "n", **at)
print(prev.where("prev is not null").count(), last.agg(F.sum("n")).first()[0])
"""


RANKS = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession, functions as F
from tallyspark.functions.core import cent_moments, variance_number, with_exact_variance
from tallyspark.operators import ranking
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", sys.argv[1])
    .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
    .config("spark.sql.shuffle.partitions", "64").config("spark.sql.autoBroadcastJoinThreshold", "-1")
    .config("spark.sql.adaptive.coalescePartitions.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
hot = F.col("id") % 3 == 0
rows = spark.range({ROWS}).select("id", F.when(hot, 0).otherwise(F.col("id") % 900 + 1).alias("g"),
    (F.lit(1000000) + F.col("id") / 100).cast("decimal(18,2)").alias("v"))
print(rows.select(ranking.value_bucket(F.col("v"))).distinct().count(), "bucket")
everywhere = ranking.dense_rank(rows, "v", "r", limit={LIMIT})
print(everywhere.agg(F.max("r"), F.sum(F.col("r") + F.col("id"))).first())
inside = ranking.dense_rank(rows, "v", "r", by=["g"], limit={LIMIT})
print(inside.where("g = 0").agg(F.max("r"), F.countDistinct("r")).first())
tiles = ranking.ntile(rows, "v", "id", 7, "t", limit={LIMIT}, ids_per_leaf={LIMIT})
print(sorted(r[1] for r in tiles.groupBy("t").count().collect()))
spread = rows.select("id", F.explode(F.array(F.lit(0), F.lit(10**7) + F.col("id"))).alias("a")).withColumn("a", F.col("a").cast("decimal(18,2)"))
std = with_exact_variance(spread.groupBy("id").agg(*cent_moments("a")), "var")
print(ranking.dense_rank(std, "var", "r", number=variance_number, limit={LIMIT}).agg(F.max("r")).first())
"""


def largest_task(script, folder):
    """What the script prints, and the most rows that one of its tasks read from shuffles."""
    out = subprocess.run([sys.executable, "-c", script, str(folder)], capture_output=True, text=True, timeout=900, check=True, env=dict(os.environ))
    most = 0
    for log in folder.iterdir():
        for line in log.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                most = max(most, event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"])
    return out.stdout, most


def test_no_task_holds_the_hot_account(tmp_path):
    out, most = largest_task(SCRIPT, tmp_path)
    hot = ROWS // 3
    assert f"count(run)={hot}" in out and str(ROWS - 601) in out
    assert f"Row(max(i)={hot}, sum(i)={hot * (hot + 1) // 2}, min(n)={hot})" in out
    # The other accounts' rows spread over 64 partitions, about 625 each, beside a few leaves of the hot one.
    assert 0 < most < ROWS // 12, most


def test_no_task_holds_a_crowded_value_bucket(tmp_path):
    """All values within one percent, a third of them in one group: ranks (q66, q75), deviations (q89) and tiles."""
    out, most = largest_task(RANKS, tmp_path)
    assert out.startswith("1 bucket")
    assert f"max(r)={ROWS}, sum((r + id))={ROWS * ROWS}" in out
    assert f"Row(max(r)={ROWS // 3}, count(DISTINCT r)={ROWS // 3})" in out
    assert "[8571, 8571, 8571, 8571, 8572, 8572, 8572]" in out and out.rstrip().endswith(f"Row(max(r)={ROWS})")
    assert 0 < most < ROWS // 12, most
