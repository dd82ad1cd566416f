"""Run registered queries beside their expected SQL and compare the results.

Usage: python tools/compare.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from reviewsieve.plans import catalog, expected_sql  # noqa: E402
from reviewsieve.session import build_session  # noqa: E402

TABLES = ("documents", "pages", "conversations", "events", "labels")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=repr)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = expected_sql.expected()
    failed = []
    for name, query in catalog.queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            got = rows_of(df.columns, df.collect())
            spark_seconds = time.time() - start
            start = time.time()
            if name not in expected:
                print(f"rows {name} {len(got)} spark {spark_seconds:.2f}s", flush=True)
                continue
            cursor = db.execute(expected[name])
            columns = [c[0] for c in cursor.description]
            want = rows_of(columns, cursor.fetchall())
            same = got == want and sorted(df.columns) == sorted(columns)
            print(
                f"{'ok  ' if same else 'DIFF'} {name} rows {len(got)}/{len(want)} "
                f"spark {spark_seconds:.2f}s sql {time.time() - start:.2f}s",
                flush=True,
            )
            if not same:
                failed.append(name)
                print("   columns", sorted(df.columns), sorted(columns))
                for g, w in [(g, w) for g, w in zip(got, want) if g != w][:2]:
                    print("   got ", repr(g)[:600])
                    print("   want", repr(w)[:600])
        except Exception as error:
            failed.append(name)
            print(f"FAIL {name}: {type(error).__name__}: {str(error)[:1500]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
