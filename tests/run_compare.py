"""Run queries against their SQL forms: python tests/run_compare.py [folder] [name ...]."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from compare import differences, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from strataflow.session import build_session  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        begun = time.time()
        try:
            frame = run(spark, folder)
            found = differences(frame, con, sql[name]) if name in sql else [f"no sql, {frame.count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - begun:.1f}s", *found, flush=True)
    print("failures:", bad)
