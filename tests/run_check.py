"""Run registered queries against their SQL twins: run_check.py FOLDER [name-prefix ...]"""

import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import connect, differences  # noqa: E402

from brightledger.session import build_session  # noqa: E402


def main():
    folder, *prefixes = sys.argv[1:]
    from brightledger.plans.catalog import all_queries, all_sql

    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = all_sql()
    bad = 0
    for name, fn in all_queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            df = fn(spark, folder)
            if name in sql:
                diff, n = differences(df, con, sql[name])
            else:
                rows = df.collect()
                diff, n = None, len(rows)
                if os.environ.get("SHOW"):
                    print(rows[:3])
        except Exception as e:
            diff, n = f"ERROR {type(e).__name__}: {str(e)[:600]}", -1
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name} rows={n} {time.time() - t:.2f}s {'' if name in sql else '(no sql) '}{diff or ''}",
              flush=True)
    print("bad:", bad)


main()
