"""Check named queries (all by default) against their SQL and print the times.

    python tests/check_queries.py [sf_dir] [name or prefix ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry
from flightlake.session import get_session
from tests.oracle import connect, differences


def main(sf: str, prefixes: list[str]) -> int:
    spark = get_session(
        "check", "local[8]", **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf), spark_entry.oracle_sql(), 0
    for name, run in spark_entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        began = time.time()
        try:
            frame = run(spark, sf)
            if name in oracles:
                problems = differences(con, oracles[name], frame)
                note = "ok" if not problems else "; ".join(problems)
            else:
                problems = [] if frame.count() else ["no rows"]
                note = "rows only" if not problems else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [error]
            note = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problems)
        print(f"{name:28} {time.time() - began:6.2f}s {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, args) else 0)
