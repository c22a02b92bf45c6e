"""Compare queries with their SQL twins: python tests/oracle_check.py [folder] [name ...]"""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FAMILIES = {
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "SMALLINT": "int", "TINYINT": "int", "UBIGINT": "int",
    "DOUBLE": "double", "FLOAT": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
    "bigint": "int", "int": "int", "tinyint": "int", "smallint": "int", "float": "double", "timestamp_ntz": "timestamp",
}


def family(name: str) -> str:
    name = FAMILIES.get(name, name)
    return "timestamp" if name.upper().startswith("TIMESTAMP") else name.lower()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return repr(value)
    return str(value)


def compare(spark, con, folder: str, fn, sql: str) -> list[str]:
    """Differences between the two results; empty when row count, types and values agree."""
    df = fn(spark, folder)
    names = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    cur = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cur.description}
    order = [d[0] for d in cur.description]
    theirs_raw = cur.fetchall()
    if sorted(order) != names:
        return [f"columns {names} != {sorted(order)}"]
    at = [order.index(c) for c in names]
    theirs = sorted(tuple(plain(r[i]) for i in at) for r in theirs_raw)
    out = []
    types = dict(df.dtypes)
    for c in names:
        if family(types[c]) != family(described[c]):
            out.append(f"type of {c}: {types[c]} != {described[c]}")
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} != {len(theirs)}")
    a, b = set(ours), set(theirs)
    if ours != theirs:
        out.append(f"{names}\n   only ours   {sorted(a - b)[:3]}\n   only theirs {sorted(b - a)[:3]} ({len(a - b)} differ)")
    if not ours:
        out.append("no rows")
    return out


def main() -> int:
    from shelfspark.plans.catalog import ORACLES, QUERIES
    from shelfspark.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    wanted = [n for n in QUERIES if any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = []
    for name in wanted:
        start = time.time()
        try:
            if name in ORACLES:
                problems = compare(spark, con, folder, QUERIES[name], ORACLES[name])
            else:
                rows = QUERIES[name](spark, folder).count()
                problems = [] if rows else ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'ok  ' if not problems else 'FAIL'} {kind} {name} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("    ", p, flush=True)
        bad += [name] if problems else []
    print(f"{len(wanted) - len(bad)} of {len(wanted)} agree; failing: {bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
