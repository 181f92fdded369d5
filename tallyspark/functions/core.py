"""Column expressions shared by the plans.

Output convention (the DuckDB oracle writes the same expressions):
ids, counts and ranks BIGINT; money DOUBLE (exact decimal sum, cast once at the end);
averages, ratios and deviations DOUBLE computed as ``CAST(SUM AS DOUBLE) / COUNT`` and
rounded to 4 places; percentages to 2; percent_rank to 6; months 'yyyy-MM'.

Rounding is ``floor(x * 10^k + 0.5) / 10^k`` on doubles: every step is one IEEE-754
operation, so Spark and DuckDB produce the identical value (their built-in ROUND functions
differ at binary half-way points).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that differ in case or accents only are equal, as under MySQL 8's default collation.
COLLATION = "UNICODE_CI_AI"
#: Digits of a step, and steps, of the exact fraction of a variance.
FRACTION_DIGITS, FRACTION_STEPS = 12, 5


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def customer_name(first: str = "first_name", last: str = "last_name") -> Column:
    """CONCAT_WS(' ', first_name, last_name): NULL parts are skipped."""
    return F.concat_ws(" ", col(first), col(last))


def lc(c: str | Column) -> Column:
    return F.lower(col(c))


def collated(c: str | Column) -> Column:
    """A text as a key for grouping, DISTINCT and joins that ignores case and accents. Aggregate by the
    raw text first where it has few values: collation keys are then made once per value."""
    return F.collate(col(c), COLLATION)


def month_label(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE: the grouping key for month rollups. Grouping on a
    date is cheaper than formatting a 'yyyy-MM' string per ledger row; the label is made
    after aggregation, once per group, and sorts in the same order."""
    return F.trunc(col(c), "MM")


def money(c: str | Column) -> Column:
    return col(c).cast("double")


def fround(c: str | Column, places: int) -> Column:
    scale = float(10**places)
    return F.floor(col(c) * scale + 0.5) / scale


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as DOUBLE, NULL when den is 0 (MySQL semantics of x / 0)."""
    return col(num).cast("double") / F.nullif(col(den), F.lit(0)).cast("double")


def avg_of(total: str | Column, count: str | Column, places: int = 4) -> Column:
    """Average from an exact sum and a count, rounded; NULL for an empty group."""
    return fround(ratio(total, count), places)


def mean_exact(c: str | Column) -> Column:
    """Unrounded average of a column as DOUBLE from its exact sum and non-NULL count.

    Use for comparisons; use ``avg_of`` on the pre-aggregated pair for output columns.
    """
    return ratio(F.sum(col(c)), F.count(col(c)))


def cent_moments(c: str | Column) -> list[Column]:
    """Exact moments of a money column: n, sum and sum of squares of the amount in cents."""
    cents = (col(c) * 100).cast("decimal(18,0)")
    whole = "decimal(38,0)"
    return [
        F.count(col(c)).alias("n"), F.sum(cents.cast(whole)).cast(whole).alias("c1"),
        F.sum((cents * cents).cast(whole)).cast(whole).alias("c2"),
    ]


def pop_std() -> Column:
    """Population standard deviation from the columns of ``cent_moments``: the numerator
    n * sum(c^2) - sum(c)^2 is an exact integer, so equal amounts give exactly 0."""
    n = F.col("n").cast("decimal(18,0)")
    spread = (n * F.col("c2")).cast("decimal(38,0)") - (F.col("c1") * F.col("c1")).cast("decimal(38,0)")
    return F.when(F.col("n") > 0, F.sqrt(spread.cast("double")) / (F.col("n").cast("double") * 100.0))


def with_exact_variance(df: DataFrame, out: str) -> DataFrame:
    """From the columns of ``cent_moments``: adds ``out``, a struct that is equal for equal population
    variances and ordered like them; null without amounts.

    With a = c1 div n, the sum of squares about a is s = c2 - 2 a c1 + n a^2 and the variance is
    s / n - ((c1 - n a) / n)^2, written as a whole number and decimal digits by long division. Two
    variances with n, m < 10^13 values differ by at least 1 / (n m)^2 > 10^-52 or not at all, so 60 digits
    tell them apart; no step multiplies more than n by what is left of a division.
    """
    whole = "decimal(38,0)"

    def wide(c: Column) -> Column:
        return c.cast(whole)

    def divided(x: Column, y: Column) -> Column:
        return wide((x - x % y) / y)

    n, c1, c2 = wide(F.col("n")), wide(F.col("c1")), wide(F.col("c2"))
    x = df.withColumn("_v_n", F.when(F.col("n") > 0, n))
    n = F.col("_v_n")
    x = x.withColumn("_v_a", wide((c1 - c1 % n) / n))
    a = F.col("_v_a")
    x = x.withColumn("_v_s", wide(wide(c2 - wide(wide(2 * a) * c1)) + wide(n * wide(a * a)))).withColumn("_v_r", wide(c1 - wide(n * a)))
    x = x.withColumn("_v_u", wide(wide(n * wide(F.col("_v_s") % n)) - wide(F.col("_v_r") * F.col("_v_r")))).withColumn("_v_nn", wide(n * n))
    u, nn, less = F.col("_v_u"), F.col("_v_nn"), F.col("_v_u") < 0
    x = x.withColumn("_v_q", wide(divided(F.col("_v_s"), n) - F.when(less, 1).otherwise(0))).withColumn("_v_u", F.when(less, wide(u + nn)).otherwise(u))
    names = []
    for i in range(FRACTION_STEPS):
        names.append(f"_v_d{i}")
        x = x.withColumn("_v_m", wide(F.col("_v_u") * F.lit(10**FRACTION_DIGITS).cast("decimal(13,0)")))
        x = x.withColumn(names[-1], divided(F.col("_v_m"), nn).cast("long")).withColumn("_v_u", F.col("_v_m") % nn)
    key = F.struct(F.col("_v_q").alias("whole"), *[F.col(c).alias(f"d{i}") for i, c in enumerate(names)])
    return x.withColumn(out, F.when(n.isNotNull(), key)).drop(*[f"_v_{c}" for c in ("n", "a", "s", "r", "u", "nn", "q", "m")], *names)


def variance_number(key: Column) -> Column:
    """The variance in square cents as DOUBLE: never decreasing in the exact key, and equal for equal keys."""
    return key["whole"].cast("double") + key["d0"].cast("double") / float(10**FRACTION_DIGITS)
