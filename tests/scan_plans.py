"""List registered queries whose plans hold an operator that would not scale: scan_plans.py FOLDER [prefix ...]"""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brightledger.session import build_session  # noqa: E402

SIGNS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SinglePartition", "ArrowEvalPython", "MapInPandas",
         "FlatMapGroupsInPandas")


def main():
    folder, *prefixes = sys.argv[1:]
    from brightledger.plans.catalog import all_queries

    spark = build_session("plans", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp"), "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name, fn in all_queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        plan = fn(spark, folder)._jdf.queryExecution().executedPlan().toString()
        found = [s for s in SIGNS if s in plan]
        if "SinglePartition" in found:
            # a window over one task, unlike a final aggregate of partial results
            lines = plan.splitlines()
            found.remove("SinglePartition")
            for i, line in enumerate(lines):
                if "SinglePartition" in line and i and "Aggregate" not in lines[i - 1]:
                    found.append("single-task:" + lines[i - 1].strip(" :+-")[:60])
        if found:
            print(name, found, flush=True)


main()
