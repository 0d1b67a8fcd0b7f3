"""Benchmark: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line.

Each query is fully computed with a ``noop`` write (no driver collect).  JVM
warm-up (class loading, JIT) is paid once beforehand by running the same
queries on the smallest scale factor, a different input, so nothing measured
is reused from the warm-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_table", "trips_clean", "filter_waterfall", "poi_distances", "scale_robust", "half_split",
    "quantile_bins", "stratified_sample", "regression_metrics", "mcdm_scores", "drift_w1", "route_features",
    "points_in_polygon", "profile", "histogram", "alias_read",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    from farelane.plans import catalog
    from farelane.session import get_spark

    spark = get_spark(app="farelane-bench")
    qs = catalog.queries()
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in names:
            try:
                qs[name](spark, warm).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - the timed run reports it
                pass
    times, errors = {}, {}
    for name in names:
        t = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t, 3)
        except Exception as ex:  # noqa: BLE001 - keep measuring the others
            errors[name] = f"{type(ex).__name__}: {str(ex)[:200]}"
    m = re.search(r"sf([\d.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
