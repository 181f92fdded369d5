"""tallyspark: retail-banking analytics as Spark DataFrame plans.

Layout
------
sources/    table schemas and the mapping of the ten banking tables from Parquet
functions/  column expressions shared by every plan (names, months, rounding, money)
operators/  reusable relational building blocks (owner fan-out, absence, ranking, ...)
plans/      the 91 analytic operators, one function each, grouped by section
oracle.py   DuckDB SQL for the same operators, used as the correctness oracle
"""

from tallyspark.sources.banking import AS_OF, Bank

__all__ = ["AS_OF", "Bank"]
