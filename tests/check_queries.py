"""Command line check: python -m tests.check_queries [name part ...] [--sf DIR]."""

from __future__ import annotations

import sys
import time

from tests.compare import differences, oracle


def main() -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from ledgerlens.session import build_session

    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if "--sf" in args:
        at = args.index("--sf")
        folder = args[at + 1]
        del args[at:at + 2]
    spark = build_session("check", "local[8]", 8, **{"spark__ui__enabled": "false", "spark__driver__memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = oracle(folder), oracle_sql(), 0
    for name, build in queries().items():
        if args and not any(a in name for a in args):
            continue
        began = time.time()
        try:
            got = build(spark, folder).toPandas()
            took = time.time() - began
            began = time.time()
            problem = differences(got, con.execute(sql[name]).df()) if name in sql else "rows only"
            other = time.time() - began
        except Exception as e:
            took, other, problem = time.time() - began, 0.0, f"{type(e).__name__}: {str(e)[:700]}"
            got = []
        flag = "ok  " if problem is None else ("rows" if problem == "rows only" else "FAIL")
        failed += flag == "FAIL"
        print(f"{flag} {name} rows={len(got)} spark={took:.2f}s sql={other:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
