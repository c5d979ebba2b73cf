"""Command line: compare queries with their SQL twins at one scale.

    python tests/check_oracles.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import compare, connect, scans  # noqa: E402

from atlasweave.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start, read = time.time(), Counter()
        try:
            df = fn(spark, sf_dir)
            read = scans(df)
            if name in oracles:
                problem, n = compare(df, con, oracles[name])
            else:
                problem, n = "", len(df.collect())
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {name:32s} {n:7d} rows {time.time() - start:6.2f}s {problem} {dict(read.most_common(1))}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
