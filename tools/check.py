"""Compare registered queries with their check SQL in DuckDB.

    python tools/check.py [--sf DIR] [--show] [name …]
"""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normal(rows, names):
    """Rows with columns by name, in a fixed order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, name: str, build, sql: str | None, sf: str) -> tuple[bool, str]:
    started = time.time()
    df = build(spark, sf)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if sql is None:
        return True, f"{len(got)} rows (rows only) {took:.1f}s"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(names)}"
    left, right = normal(got, df.columns), normal(want, names)
    if left != right:
        in_left, in_right = set(left), set(right)
        only_left = [r for r in left if r not in in_right][:3]
        only_right = [r for r in right if r not in in_left][:3]
        return False, f"{len(left)} against {len(right)} rows\n   spark  {only_left}\n   duckdb {only_right}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    spark_types = {f.name: kinds.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    odd = {n: (spark_types[n], t) for n, t in zip(names, types) if spark_types[n] != t}
    return True, f"{len(left)} rows {took:.1f}s" + (f"  types differ: {odd}" if odd else "") + ("  EMPTY" if not left else "")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--show", action="store_true", help="print the physical plans instead")
    parser.add_argument("--zone", default="UTC", help="session time zone; results must not depend on it")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    from threatlake.plans.catalog import CHECKS, QUERIES
    from threatlake.session import build_session

    spark = build_session("check", "local[8]", **{"spark__sql__shuffle__partitions": "8", "spark__driver__memory": "8g"})
    spark.conf.set("spark.sql.session.timeZone", args.zone)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    failed = []
    for name in args.names or QUERIES:
        if args.show:
            print(f"== {name}")
            QUERIES[name](spark, args.sf).explain("formatted")
            continue
        try:
            good, note = compare(spark, con, name, QUERIES[name], CHECKS.get(name), args.sf)
        except Exception as error:  # noqa: BLE001  (reported per query)
            good, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{'ok  ' if good else 'FAIL'} {name}: {note}", flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
