"""Compare registered queries with their SQL on DuckDB.

    python tests/oracle.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads=4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if type(value).__name__ == "Decimal":
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return str(value)


def order_key(row):
    return tuple((v is None, str(type(v) is str), f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row)


def same(a, b, exact):
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return a == b if exact else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def compare(spark_df, con, sql, exact=True):
    """None when equal, else a short description of the first difference."""
    cols = sorted(spark_df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in spark_df.collect()]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want_cols = sorted(names)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    at = [names.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in at) for r in res.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got.sort(key=order_key)
    want.sort(key=order_key)
    for g, w in zip(got, want):
        if not all(same(x, y, exact) for x, y in zip(g, w)):
            return f"{cols}\n   spark {g}\n   duck  {w}"
    types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    duck = {d[0]: str(d[1]).lower() for d in res.description}
    odd = {c: (types[c], duck[c]) for c in cols if TYPE_NAMES.get(types[c], duck[c]) != duck[c]}
    return f"types {odd}" if odd else None


TYPE_NAMES = {"int": "integer", "bigint": "bigint", "double": "double", "string": "varchar", "boolean": "boolean"}


def main():
    from __spark_entry__ import oracle_sql, queries
    from retentia.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session("oracle")
    con = connect(sf)
    oracles = oracle_sql()
    bad, total = [], 0
    for name, fn in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        total += 1
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                rows = df.collect()
                problem = None if rows else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        took = time.time() - start
        mark = "ok " if problem is None else "BAD"
        print(f"{mark} {name:42s} {took:6.2f}s {'' if name in oracles else '(rows only)'}", flush=True)
        if problem:
            bad.append(name)
            print("   ", problem, flush=True)
        spark.catalog.clearCache()
    print(f"{total - len(bad)}/{total} ok; bad: {bad}")


if __name__ == "__main__":
    main()
