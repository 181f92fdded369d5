"""Registry of the analytic operators: key ``qNNN_<name>`` -> callable(spark, sf_dir)."""

from __future__ import annotations

import importlib
import inspect
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.sources.banking import Bank

SECTIONS = ("aggregates", "joins", "subqueries", "windows", "pipelines")
_NAME = re.compile(r"^q(\d+)_(\w+)$")


def plan_functions() -> dict[str, Callable[..., DataFrame]]:
    """Plan functions taking a ``Bank``, keyed ``qNNN_<name>``, in operator order."""
    found: dict[str, Callable[..., DataFrame]] = {}
    for section in SECTIONS:
        mod = importlib.import_module(f"tallyspark.plans.{section}")
        for name, fn in inspect.getmembers(mod, inspect.isfunction):
            m = _NAME.match(name)
            if m and fn.__module__ == mod.__name__:
                found[f"q{int(m.group(1)):03d}_{m.group(2)}"] = fn
    return dict(sorted(found.items()))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, sf_dir: str, **params) -> DataFrame:
            return fn(Bank.shared(spark, sf_dir), **params)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {key: bind(fn) for key, fn in plan_functions().items()}
