"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names and order-insensitive values."""

import math
import sys
import time

sys.path.insert(0, "/root/repo")

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from doctext.session import get_spark  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main(sf_dir, names):
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, orc = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if name not in orc:
            print(f"{name:32s} rows={len(srows):7d} (no oracle) {t1-t0:.1f}s")
            continue
        rel = con.sql(orc[name])
        dcols = rel.columns
        drows = rel.fetchall()
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows)
        if ok:
            ok = rows_of(scols, srows) == rows_of(dcols, drows)
        bad += not ok
        print(f"{name:32s} rows={len(srows):7d}/{len(drows):7d} {'OK ' if ok else 'BAD'} {t1-t0:.1f}s"
              + ("" if ok or sorted(scols) == sorted(dcols) else f" cols {sorted(scols)} vs {sorted(dcols)}"))
        if not ok and sorted(scols) == sorted(dcols):
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            sa, sb = set(a), set(b)
            print("   spark-only:", [x for x in a if x not in sb][:2])
            print("   duck-only: ", [x for x in b if x not in sa][:2])
    print("BAD", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
