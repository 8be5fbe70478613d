"""Compare registered queries with their SQL: python -m tests.check_queries FOLDER [NAME ...]"""

from __future__ import annotations

import sys
import time
import traceback

from talkmill.plans import ORACLES, QUERIES
from talkmill.session import build_session
from tests.compare import difference, duck_rows, spark_rows


def main(folder: str, names: list[str]) -> int:
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    wrong = 0
    for name in names or list(QUERIES):
        begun = time.time()
        try:
            got = spark_rows(QUERIES[name](spark, folder))
            took = time.time() - begun
            problem = difference(got, duck_rows(folder, ORACLES[name])) if name in ORACLES else None
            status = problem or ("ok" if name in ORACLES else "rows only")
            wrong += problem is not None
            empty = "" if got[1] else " EMPTY"
            print(f"{name:28s} {took:6.2f}s {len(got[1]):7d} {status}{empty}", flush=True)
        except Exception as error:
            wrong += 1
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:700]}", flush=True)
            if "--trace" in sys.argv:
                traceback.print_exc()
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], [a for a in sys.argv[2:] if not a.startswith("--")]))
