"""Command line: run the jobs on monthly trip files.

    python -m farelane base  --input DIR --root OUT [--months 2009-01 2009-02 2009-03]
    python -m farelane ct    --input DIR --root OUT [--months ...]
    python -m farelane cm    --input DIR --reference DIR --root OUT
    python -m farelane score --input DIR --root OUT --output DIR
    python -m farelane waterfall --input DIR

Input files are Parquet trip files (any alias layout, e.g. ``yellow_tripdata_YYYY-MM.parquet``),
read recursively; ``--months`` prunes files at listing.
"""

from __future__ import annotations

import argparse
import json


def _read(spark, path, months=None):
    from farelane.sources import files
    # the file-and-position key is unique and stable: splits, samples and folds use it
    return files.read_canonical(spark, path, keep_extra=["month", "source_file", "row_key"], months=months) \
        .withColumnRenamed("row_key", "trip_id")


def _window(spark, a):
    """Months to read: those named, or the next ones from ``--start-month``
    that no version of the ledger has used."""
    if not a.start_month:
        return a.months
    from farelane.operators import selection as SEL
    from farelane.plans import scoring as SC
    ledger = SC.published(spark, a.root, "ledger")
    if ledger is None:
        raise SystemExit(f"no version is published under {a.root}")
    months = sorted(r["month"] for r in SEL.months_to_read(spark, ledger, a.start_month, a.window).collect())
    if not months:
        raise SystemExit("every month of the window has been used")
    return months


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="farelane")
    ap.add_argument("command", choices=["base", "ct", "cm", "score", "waterfall"])
    ap.add_argument("--input", required=True)
    ap.add_argument("--root")
    ap.add_argument("--reference")
    ap.add_argument("--output")
    ap.add_argument("--months", nargs="*")
    ap.add_argument("--start-month", help="ct: first month (YYYY-MM) of the window; used months are left out")
    ap.add_argument("--window", type=int, default=3, help="months in the window")
    ap.add_argument("--polygon", help="text file, one WKT polygon per line: trips must start and end inside one")
    ap.add_argument("--quick", action="store_true", help="small learners (smoke runs)")
    ap.add_argument("--resume", action="store_true", help="reuse completed stage tables")
    a = ap.parse_args(argv)

    from farelane.config import ModelParams
    from farelane.session import get_spark
    spark = get_spark(app=f"farelane-{a.command}")
    params = ModelParams.quick() if a.quick else ModelParams()
    raw = _read(spark, a.input, _window(spark, a))
    polygon = None
    if a.polygon:
        from pyspark.sql import functions as F
        from farelane.operators import polygon as PG
        wkt = spark.read.text(a.polygon).select(F.monotonically_increasing_id().alias("poly_id"), F.col("value").alias("wkt"))
        polygon = PG.edges_from_wkt(wkt)

    if a.command == "waterfall":
        from farelane.operators import clean
        for r in clean.waterfall(raw).orderBy("step").collect():
            print(json.dumps(r.asDict()))
        return
    from farelane.plans import jobs
    if a.command == "base":
        res = jobs.run_base(spark, raw, a.root, params, resume=a.resume, polygon=polygon)
    elif a.command == "ct":
        res = jobs.run_ct(spark, raw, a.root, params, polygon=polygon)
    elif a.command == "cm":
        res = jobs.run_cm(spark, raw, _read(spark, a.reference), a.root, polygon=polygon)
    else:
        res = jobs.run_score(spark, raw, a.root, a.output)
    print(json.dumps({"version": res.version, "tables": res.tables,
                      "info": {k: v for k, v in res.info.items() if isinstance(v, (str, int, float, type(None)))}}))


if __name__ == "__main__":
    main()
