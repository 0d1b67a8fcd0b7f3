"""Run registered queries in Spark and their oracle SQL in DuckDB on the same
parquet tables; compare row count, column names and order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "int": "INTEGER", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}


def compare_types(spark_schema, rel):
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_schema.fields}
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    bad = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    return (not bad), f"types differ: {bad}"


def compare(sdf, ddf):
    scols, dcols = sorted(sdf.columns), sorted(ddf.columns)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(sdf) != len(ddf):
        return False, f"rows differ: spark={len(sdf)} duck={len(ddf)}"
    srows = sorted(tuple(_norm(x) for x in r) for r in sdf[scols].astype(object).itertuples(index=False))
    drows = sorted(tuple(_norm(x) for x in r) for r in ddf[dcols].astype(object).itertuples(index=False))
    bad = [(a, b) for a, b in zip(srows, drows) if a != b]
    if bad:
        return False, f"{len(bad)} value rows differ, e.g. {bad[0]}"
    return True, f"{len(sdf)} rows"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as e
    from farelane.session import get_spark
    tz = os.environ.get("CHECK_TZ")          # run under another session zone
    if os.environ.get("CHECK_PLAIN"):        # a plain session, as a caller might build it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_spark(extra={"spark.sql.session.timeZone": tz} if tz else None)
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    ok_all = True
    for name in (names or list(qs)):
        t = time.time()
        try:
            sq = qs[name](spark, sf_dir)
            sdf = sq.toPandas()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            ok_all = False
            continue
        st = time.time() - t
        if name not in sqls:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {st:.1f}s")
            continue
        try:
            ddf = con.execute(sqls[name]).fetchdf()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(ex)[:400]}")
            ok_all = False
            continue
        ok, msg = compare_types(sq.schema, con.sql(sqls[name]))
        if ok:
            ok, msg = compare(sdf, ddf)
        ok_all &= ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {msg} ({st:.1f}s)")
    spark.stop()
    sys.exit(0 if ok_all else 1)


if __name__ == "__main__":
    main()
