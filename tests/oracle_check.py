"""Run registered queries with Spark and their DuckDB twins; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "TimestampNTZType()": "TIMESTAMP", "BooleanType()": "BOOLEAN"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir, names=None, verbose=True):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in sorted(qs):
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name]) if verbose else None
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only ({len(srows)} rows)"
            print(f"{name:32s} {results[name]} {ts:.1f}s") if verbose else None
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            dtypes = {d[0]: str(d[1]) for d in cur.description}
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name]) if verbose else None
            continue
        tdiff = {c: (stypes[c], dtypes.get(c)) for c in stypes if c in dtypes and stypes[c] != dtypes[c]}
        if sorted(scols) != sorted(dcols):
            results[name] = f"COLUMNS spark={scols} duck={dcols}"
        elif tdiff:
            results[name] = f"TYPES {tdiff}"
        elif len(srows) != len(drows):
            results[name] = f"ROWCOUNT spark={len(srows)} duck={len(drows)}"
        else:
            a, b = canon(srows, scols), canon(drows, dcols)
            if a == b:
                results[name] = f"OK ({len(srows)} rows)"
            else:
                diff = next((x, y) for x, y in zip(a, b) if x != y)
                results[name] = f"VALUES first diff spark={diff[0]} duck={diff[1]}"
        if verbose:
            print(f"{name:32s} {results[name][:400]} {ts:.1f}s")
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from velograph.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, set(sys.argv[2:]) or None)
    equal = [k for k, v in res.items() if v.startswith("OK")]
    bare = [k for k, v in res.items() if v.startswith("rows-only")]
    bad = [k for k in res if k not in equal and k not in bare]
    print(f"{len(equal)} equal to their SQL, {len(bare)} without SQL: {bare}; bad: {bad}")
