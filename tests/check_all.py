"""Run all (or the named) registered queries against their oracles: check_all.py SF_DIR [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from leadtide.session import local_session  # noqa: E402
from tests.compare import difference, duck  # noqa: E402


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:]
    spark = local_session("check", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = duck(sf), oracle_sql()
    bad = []
    for name, query in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, sf)
            got = df.toPandas()
            took = time.time() - start
            if name in oracles:
                problem = difference(got, con.execute(oracles[name]).df())
            else:
                problem = None
        except Exception as e:
            took, problem = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}"
            if names:
                traceback.print_exc()
        kind = "oracle" if name in oracles else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name:36s} {took:6.2f}s {kind:6s} {len(got) if problem is None else problem}", flush=True)
        if problem:
            bad.append(name)
    print("bad:", bad)


if __name__ == "__main__":
    main()
