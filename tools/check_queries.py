"""Compare registered queries with their SQL in DuckDB on one data folder.

usage: python tools/check_queries.py [folder] [name or prefix ...]
"""

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))

from plenaria.queries import TABLE_NAMES, registry  # noqa: E402
from plenaria.session import local_session  # noqa: E402

KINDS = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp"}


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return f"{value:.6g}" if abs(value) < 1e15 else f"{value:.6e}"
    return str(value)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(cell(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main(argv):
    folder = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = local_session("check")
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    bad = 0
    for name, q in registry().items():
        if wanted and not any(name == w or name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = q(spark, folder)
            columns, rows = df.columns, [tuple(r) for r in df.collect()]
        except Exception as error:
            bad += 1
            print(f"FAIL  {name}: {str(error)[:1500]}")
            continue
        took = time.time() - start
        if q.sql is None:
            print(f"rows  {name}: {len(rows)} rows, {took:.1f}s")
            bad += not rows
            continue
        try:
            result = con.execute(q.sql)
            other = [d[0] for d in result.description]
            kinds = {d[0]: str(d[1]) for d in result.description}
            expected = result.fetchall()
        except Exception as error:
            bad += 1
            print(f"SQL   {name}: {str(error)[:800]}")
            continue
        problems = []
        if sorted(columns) != sorted(other):
            problems.append(f"columns {sorted(columns)} / {sorted(other)}")
        else:
            types = dict(df.dtypes)
            wrong = {c: (types[c], kinds[c]) for c in columns if KINDS.get(kinds[c], kinds[c]) != types[c]}
            if wrong:
                problems.append(f"types {wrong}")
            mine, left = digest(columns, rows)
            theirs, right = digest(other, expected)
            if mine != theirs:
                a, b = sorted(set(left) - set(right))[:4], sorted(set(right) - set(left))[:4]
                problems.append(f"values {len(rows)}/{len(expected)} cols={sorted(columns)}\n   spark {a}\n   sql   {b}")
        if not rows:
            problems.append("no rows")
        bad += bool(problems)
        print(f"{'DIFF ' if problems else 'ok   '} {name}: {len(rows)} rows, {took:.1f}s {'; '.join(problems)}", flush=True)
    print(f"{bad} problems")


if __name__ == "__main__":
    main(sys.argv)
