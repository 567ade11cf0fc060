"""Command-line form of the oracle check: python tests/run_checks.py [sf_dir] [names...]."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from mdlake.session import build_session  # noqa: E402
from tests.compare import compare, duck  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                n, problem = compare(df, connection, oracles[name])
            else:
                n, problem = df.count(), ""
        except Exception as error:
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1200]}"
            if wanted:
                traceback.print_exc()
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n} {time.time() - began:.2f}s {problem}", flush=True)
    print("failed:", bad)
