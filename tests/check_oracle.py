"""python tests/check_oracle.py [sf folder] [query ...]: compare queries, with times."""

from __future__ import annotations

import sys
import time
import traceback

sys.path[:0] = [".", "tests"]

from conftest import build_session  # noqa: E402
from oracle import database, differences  # noqa: E402

from tagloom.catalog import QUERIES, SQL  # noqa: E402


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session()
    con = database(folder)
    failed = []
    for name in names:
        start = time.time()
        try:
            if name in SQL:
                problems = differences(spark, con, QUERIES[name], SQL[name], folder)
            else:
                problems = [] if QUERIES[name](spark, folder).collect() else ["no rows"]
        except Exception as error:
            problems = [str(error)[:600], *str(error).split("Caused by")[1:4]]
            if len(names) < 4:
                traceback.print_exc()
        kind = "sql" if name in SQL else "rows"
        print(f"{'FAIL' if problems else 'ok':5}{name:32}{kind:6}{time.time() - start:6.2f}s", flush=True)
        for p in problems:
            print("     ", p, flush=True)
        failed += [name] if problems else []
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
