"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_flagship(spark):
    df = _entry_module().entry(spark)
    assert df.columns == ["account_id", "total_fees", "overdraft_count", "risk_score"]
    assert df.count() > 0


def test_queries_and_oracle_keys_align():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    banking = {k for k in q if k.startswith("q")}
    assert len(banking) == 90 and banking <= set(o) and set(o) <= set(q)
    assert all(sql.lstrip().upper().startswith("WITH ") for sql in o.values())


def test_building_banking_plans_runs_no_job_and_writes_nothing(spark, sf_dir):
    """Queries are plans: jobs and files come with the caller's action only."""
    sc = spark.sparkContext
    sc.setJobGroup("plans-only", "building plans")
    before = set(os.listdir("/tmp"))
    for key, fn in _entry_module().queries().items():
        if key.startswith("q"):
            fn(spark, sf_dir)
    jobs = sc.statusTracker().getJobIdsForGroup("plans-only")
    sc.setLocalProperty("spark.jobGroup.id", None)
    # Reading a Parquet footer for its schema is a job of Spark's own, once per table and session.
    assert len(jobs) <= 8
    assert not {f for f in set(os.listdir("/tmp")) - before if f.startswith("tally")}
