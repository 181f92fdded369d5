"""Write PLANS.md: the physical-plan shape of every registered operator.

    python tools/plan_report.py [sf_dir]

For each operator it counts, in the plan Spark prints with ``explain()`` (before AQE
re-optimises it at run time): file scans, hash and range exchanges, exchanges to a single partition,
broadcast exchanges, window operators, sort-merge / broadcast-hash joins, scalar
subqueries, and scans of stored copies (none). The second table has automatic broadcasts off, as
on tables too large for them: what is broadcast there is broadcast by a hint. The third does the same on staged tables
without adaptive execution, where exchanges that are read twice show as reused.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyspark.plans.registry import plan_functions, queries  # noqa: E402
from tallyspark.session import local_session  # noqa: E402
from tallyspark.sources.banking import Bank  # noqa: E402

COUNTS = {
    "scans": r"FileScan parquet",
    "hash exch": r"Exchange hashpartitioning",
    "range exch": r"Exchange rangepartitioning",
    "single-part exch": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "window": r"\bWindow \[",
    "group limit": r"WindowGroupLimit",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "subquery": r"Subquery subquery",
    "stored copy": r"Scan ExistingRDD",
    "reused exch": r"ReusedExchange",
}


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    lines = [
        "# PLANS",
        "",
        f"Physical-plan shape of every registered operator (`tools/plan_report.py`, {os.path.basename(sf_dir)}, plan as",
        "printed by `explain()` before AQE's run-time changes). Exchanges to a single partition carry one row per",
        "value bucket (at most about 7,500) or one total.",
    ]
    staged = tempfile.mkdtemp(prefix="plan-report-")
    Bank(spark, sf_dir).write_staged(staged)
    bank = Bank.from_staged(spark, staged)
    mapped = {k: lambda fn=fn: fn(spark, sf_dir) for k, fn in queries().items()}
    stored = {k: lambda fn=fn: fn(bank) for k, fn in plan_functions().items()}
    no_broadcast = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    # Without adaptive execution explain() shows which exchanges are read twice (they count as "reused", not again).
    still = {**no_broadcast, "spark.sql.adaptive.enabled": "false"}
    for title, plans, conf in (
        ("as configured", mapped, {}), ("broadcasts off", mapped, no_broadcast), ("staged tables, broadcasts and adaptive execution off", stored, still)
    ):
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines += ["", f"## {title}", "", "| operator | " + " | ".join(COUNTS) + " |", "|---|" + "---|" * len(COUNTS)]
        for key, build in plans.items():
            text = re.sub(r"(ReusedExchange \[[^\n]*?\]), Exchange [^\n]*", r"\1", plan_text(build()))
            cells = [str(len(re.findall(p, text))) for p in COUNTS.values()]
            lines.append(f"| {key} | " + " | ".join(cells) + " |")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(root, "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
