"""Registered queries: profile, histogram, box-plot outliers, extras variance,
W1 drift, drift report, regression drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelane.functions.quantiles import quantiles
from farelane.operators import drift as D
from farelane.operators import knn as K
from farelane.operators import profile as P
from farelane.plans import pipeline
from farelane.plans.common import comparable
from farelane.plans.sqltext import clean_ctes
from farelane.sources.tables import TRIPS_SQL, load_monthly_trips, load_trips

Q, SQL = {}, {}

PROFILE_COLS = ["Passenger_Count", "Fare_Amt", "Total_Amt", "Real_time", "Real_distance", "haversine_distance_m"]
DRIFT_COLS = ["Passenger_Count", "Fare_Amt", "Real_time", "Real_distance", "haversine_distance_m"]


def _cleaned(spark, sf):
    return pipeline.clean_trips(load_trips(spark, sf))


def profile(spark, sf):
    return comparable(P.describe(_cleaned(spark, sf), PROFILE_COLS), 4)


def _profile_sql():
    parts = []
    for c in PROFILE_COLS:
        x = f"CAST({c} AS DOUBLE)"
        for st, e in [("count", f"count({x})"), ("mean", f"avg({x})"), ("std", f"stddev_samp({x})"),
                      ("min", f"min({x})"), ("max", f"max({x})"), ("25%", f"quantile_cont({x}, 0.25)"),
                      ("50%", f"quantile_cont({x}, 0.5)"), ("75%", f"quantile_cont({x}, 0.75)")]:
            parts.append(f"SELECT '{c}' AS column, '{st}' AS stat, round(CAST({e} AS DOUBLE), 4) AS value FROM cleaned")
    return f"WITH {clean_ctes()}\n" + "\nUNION ALL ".join(parts)


Q["profile"] = profile
SQL["profile"] = _profile_sql()


def histogram(spark, sf):
    return comparable(P.histogram(_cleaned(spark, sf), "Real_distance", 100), 4)


Q["histogram"] = histogram
SQL["histogram"] = f"""WITH {clean_ctes()},
v AS (SELECT CAST(Real_distance AS DOUBLE) AS x FROM cleaned),
r AS (SELECT min(x) AS mn, max(x) AS mx FROM v),
b AS (SELECT least(floor((x - mn) / (mx - mn) * 100), 99) + 1 AS bin FROM v, r),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT g.i::BIGINT AS bin, round(mn + (g.i - 1) * ((mx - mn) / 100), 4) AS lo,
       round(mn + g.i * ((mx - mn) / 100), 4) AS hi, coalesce(c.n, 0)::BIGINT AS count
FROM range(1, 101) g(i) CROSS JOIN r LEFT JOIN c ON c.bin = g.i"""


KNN_COLS = ["Passenger_Count", "Start_Lon", "Start_Lat", "End_Lon", "End_Lat"]


def knn_impute(spark, sf):
    """Missing passenger counts, and start points that can't be (zero or out of
    range), from the five nearest trips of all that have them."""
    t = load_trips(spark, sf)
    t = t.withColumns({c: F.when((F.col("Start_Lon") != 0) & (F.abs("Start_Lon") <= 180), F.col(c)) if c == "Start_Lon" else
                       F.when(F.col("Start_Lat") != 0, F.col(c)) for c in ("Start_Lon", "Start_Lat")})
    return comparable(K.knn_impute(t.select("trip_id", *KNN_COLS), KNN_COLS, "trip_id"))


def _knn_sql():
    targets = ["Passenger_Count", "Start_Lon", "Start_Lat"]
    parts = []
    for t in targets:
        others = [c for c in KNN_COLS if c != t]
        d2 = " + ".join(f"CASE WHEN r.{c} IS NULL OR d.{c} IS NULL THEN 0e0 ELSE (r.{c} - d.{c}) * (r.{c} - d.{c}) END" for c in others)
        n = " + ".join(f"(r.{c} IS NOT NULL AND d.{c} IS NOT NULL)::INT" for c in others)
        parts.append(f"""n_{t} AS (
  SELECT trip_id, coalesce(avg(v), (SELECT avg({t}) FROM t)) AS v FROM (
    SELECT r.trip_id, d.{t} AS v, row_number() OVER (PARTITION BY r.trip_id ORDER BY ({d2}) * ({len(KNN_COLS)}e0 / ({n})), d.trip_id) AS rn
    FROM t r JOIN t d ON r.{t} IS NULL AND d.{t} IS NOT NULL AND {n} > 0) WHERE rn <= 5 GROUP BY trip_id)""")
    cols = ", ".join(f"round(coalesce(t.{c}, n_{c}.v), 6) AS {c}" if c in targets else f"round(t.{c}, 6) AS {c}" for c in KNN_COLS)
    joins = " ".join(f"LEFT JOIN n_{t} ON n_{t}.trip_id = t.trip_id" for t in targets)
    return f"""WITH raw AS ({TRIPS_SQL}),
t AS (SELECT * REPLACE (CASE WHEN Start_Lon <> 0 AND abs(Start_Lon) <= 180 THEN Start_Lon END AS Start_Lon,
                        CASE WHEN Start_Lat <> 0 THEN Start_Lat END AS Start_Lat) FROM raw),
{", ".join(parts)}
SELECT t.trip_id, {cols} FROM t {joins}"""


Q["knn_impute"] = knn_impute
SQL["knn_impute"] = _knn_sql()


def iqr_outliers(spark, sf):
    s, _ = P.iqr_outliers(_cleaned(spark, sf), "Fare_Amt")
    return comparable(s, 4)


def iqr_outlier_rows(spark, sf):
    _, rows = P.iqr_outliers(_cleaned(spark, sf), "Fare_Amt")
    return comparable(rows.select("trip_id", "Fare_Amt"), 4)


_IQR = f"""WITH {clean_ctes()},
q AS (SELECT quantile_cont(CAST(Fare_Amt AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(Fare_Amt AS DOUBLE), 0.75) AS q3
      FROM cleaned),
f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)"""

Q["iqr_outliers"] = iqr_outliers
SQL["iqr_outliers"] = _IQR + """
SELECT 'Fare_Amt' AS column, round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr,
       round(lower, 4) AS lower, round(upper, 4) AS upper,
       (SELECT count(*) FROM cleaned, f f2 WHERE Fare_Amt < f2.lower OR Fare_Amt > f2.upper)::BIGINT AS n_outliers
FROM f"""
Q["iqr_outlier_rows"] = iqr_outlier_rows
SQL["iqr_outlier_rows"] = _IQR + """
SELECT trip_id, round(CAST(Fare_Amt AS DOUBLE), 4) AS Fare_Amt FROM cleaned, f
WHERE Fare_Amt < f.lower OR Fare_Amt > f.upper"""


def extras_variance(spark, sf):
    return comparable(P.extras_variance(_cleaned(spark, sf)), 6)


Q["extras_variance"] = extras_variance
SQL["extras_variance"] = f"""WITH {clean_ctes()},
e AS (SELECT CAST(Total_Amt AS DOUBLE) - CAST(Fare_Amt AS DOUBLE) AS x FROM cleaned)
SELECT round(var_samp(x), 6) AS extras_var, round(sqrt(var_samp(x)), 6) AS rmse_floor,
       round(avg(x), 6) AS extras_mean FROM e"""


# -- drift -----------------------------------------------------------------------
def _ref_cur(spark, sf):
    """Reference = the two training months, current = the third month."""
    from farelane.operators import split as S
    cl = pipeline.clean_trips(S.month_split(load_monthly_trips(spark, sf)))
    return cl.filter(F.col("split") == "train"), cl.filter(F.col("split") == "valtest")


def drift_w1(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    return comparable(D.wasserstein(ref, cur, DRIFT_COLS), 6)


def drift_report(spark, sf):
    ref, cur = _ref_cur(spark, sf)
    per, _ = D.drift_report(D.wasserstein(ref, cur, DRIFT_COLS))
    return comparable(per.select("feature", "score", "drifted"), 6)


def drift_summary(spark, sf):
    """Dataset decision: share of drifted features over all of them."""
    ref, cur = _ref_cur(spark, sf)
    _, summary = D.drift_report(D.wasserstein(ref, cur, DRIFT_COLS))
    return comparable(summary, 6)


def drift_w1_sketch(spark, sf):
    """The third month against the merged sketches of the first two, with the
    exact distance next to it and whether it lies within the bound."""
    ref, cur = _ref_cur(spark, sf)
    months = D.sketch(ref, DRIFT_COLS, ("month",))
    got = D.wasserstein_sketch(D.merge_sketches(months), D.sketch(cur, DRIFT_COLS))
    exact = D.wasserstein(ref, cur, DRIFT_COLS).select("feature", F.col("w1").alias("exact"))
    got = got.join(exact, "feature").withColumn("within", F.abs(F.col("w1") - F.col("exact")) <= F.col("error_bound") + 1e-9)
    return comparable(got.drop("ref_std").withColumn("within", F.col("within").cast("long")), 4)


def quantiles_tied(spark, sf):
    """Quantiles of columns where a dozen values hold all rows."""
    cl = pipeline.clean_trips(load_trips(spark, sf)).withColumn("whole_fare", F.floor("Fare_Amt"))
    q = quantiles(cl, ["Passenger_Count", "whole_fare"], [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0])
    return comparable(q.select("column", "p", "value"), 6)


def _w1_sql():
    melt = "\n    UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, CASE WHEN rk <= 2 THEN 1 ELSE 0 END AS r FROM lab"
        for c in DRIFT_COLS)
    return f"""WITH {clean_ctes(monthly=True)},
months AS (SELECT month, dense_rank() OVER (ORDER BY month) AS rk FROM (SELECT DISTINCT month FROM trips) m),
lab AS (SELECT c.*, rk FROM cleaned c JOIN months USING (month) WHERE rk <= 3),
long AS (
    {melt}),
tot AS (SELECT feature, sum(r) AS nr, sum(1 - r) AS nc, stddev_pop(CASE WHEN r = 1 THEN x END) AS ref_std
        FROM long GROUP BY feature),
c AS (SELECT feature, x, sum(r) AS cr, sum(1 - r) AS cc FROM long GROUP BY feature, x),
cum AS (SELECT c.feature, x,
          sum(cr) OVER (PARTITION BY c.feature ORDER BY x ROWS UNBOUNDED PRECEDING) / nr AS Fr,
          sum(cc) OVER (PARTITION BY c.feature ORDER BY x ROWS UNBOUNDED PRECEDING) / nc AS Gc,
          lead(x) OVER (PARTITION BY c.feature ORDER BY x) - x AS dx
        FROM c JOIN tot USING (feature)),
w AS (SELECT feature, sum(abs(Fr - Gc) * coalesce(dx, 0)) AS w1 FROM cum GROUP BY feature)"""


def _w1_sketch_sql():
    g = repr(D.GAMMA)
    rep = f"sign(x) * pow({g}e0, CASE WHEN x = 0 THEN 0 ELSE floor(ln(abs(x)) / ln({g}e0)) END) * {(1 + D.GAMMA) / 2!r}e0"
    exact = _w1_sql()
    moved = exact[exact.index("tot AS ("):].replace("tot AS", "tot2 AS").replace("c AS (SELECT feature, x", "c2 AS (SELECT feature, rep AS x") \
        .replace("FROM long GROUP BY feature, x", "FROM long GROUP BY feature, rep").replace("cum AS", "cum2 AS").replace("SELECT c.feature", "SELECT c2.feature") \
        .replace("PARTITION BY c.feature", "PARTITION BY c2.feature").replace("FROM c JOIN tot", "FROM c2 JOIN tot2").replace("w AS", "w2 AS").replace("FROM cum", "FROM cum2")
    exact = exact.replace("long AS (", "melt AS (", 1).replace("tot AS (", f"long AS (SELECT *, {rep} AS rep FROM melt),\ntot AS (", 1)
    return f"""{exact}, {moved},
e AS (SELECT feature, sum(r) AS n_ref, sum(1 - r) AS n_cur, avg(abs(x - rep)) FILTER (r = 1) + avg(abs(x - rep)) FILTER (r = 0) AS bound
      FROM long GROUP BY feature)
SELECT e.feature, round(w2.w1, 4) AS w1, n_ref::BIGINT AS n_ref, n_cur::BIGINT AS n_cur, round(bound, 4) AS error_bound,
       round(w.w1, 4) AS exact, (abs(w2.w1 - w.w1) <= bound + 1e-9)::BIGINT AS within
FROM e JOIN w USING (feature) JOIN w2 USING (feature)"""


Q["drift_w1_sketch"] = drift_w1_sketch
SQL["drift_w1_sketch"] = _w1_sketch_sql()
Q["drift_w1"] = drift_w1
SQL["drift_w1"] = _w1_sql() + """
SELECT w.feature, round(w1, 6) AS w1, nr::BIGINT AS n_ref, nc::BIGINT AS n_cur, round(ref_std, 6) AS ref_std
FROM w JOIN tot USING (feature)"""
Q["drift_report"] = drift_report
SQL["drift_report"] = _w1_sql() + """
SELECT w.feature, round(CASE WHEN ref_std > 0 THEN w1 / ref_std WHEN w1 > 0 THEN 'inf'::DOUBLE ELSE 0 END, 6) AS score,
       CASE WHEN ref_std > 0 THEN w1 / ref_std WHEN w1 > 0 THEN 'inf'::DOUBLE ELSE 0 END >= 0.1 AS drifted
FROM w JOIN tot USING (feature)"""


Q["drift_summary"] = drift_summary
SQL["drift_summary"] = _w1_sql() + """,
f AS (SELECT CASE WHEN ref_std > 0 THEN w1 / ref_std WHEN w1 > 0 THEN 'inf'::DOUBLE ELSE 0 END >= 0.1 AS drifted
      FROM w JOIN tot USING (feature))
SELECT count(*)::BIGINT AS n_features, count(*) FILTER (drifted)::BIGINT AS n_drifted,
       round(count(*) FILTER (drifted) / count(*), 6) AS share_drifted,
       count(*) FILTER (drifted) / count(*) >= 0.5 AS dataset_drift FROM f"""
Q["quantiles_tied"] = quantiles_tied
SQL["quantiles_tied"] = f"""WITH {clean_ctes()},
ps AS (SELECT unnest([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]::DOUBLE[]) AS p),
qs AS (SELECT quantile_cont(CAST(Passenger_Count AS DOUBLE), [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) AS a,
              quantile_cont(CAST(floor(CAST(Fare_Amt AS DOUBLE)) AS DOUBLE), [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) AS b FROM cleaned)
SELECT 'Passenger_Count' AS "column", unnest([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]::DOUBLE[]) AS p, round(unnest(a), 6) AS value FROM qs
UNION ALL SELECT 'whole_fare', unnest([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]::DOUBLE[]), round(unnest(b), 6) FROM qs"""


def regression_drift(spark, sf):
    """OLS-on-distance quality: validation half (reference) vs test half."""
    from farelane.plans.q_select import candidate_predictions
    d, _ = candidate_predictions(spark, sf)
    out = D.regression_drift(d.filter(F.col("split") == "val"), d.filter(F.col("split") == "test"),
                             "Fare_Amt", "pred_distance")
    return comparable(out, 6)


def _regression_drift_sql():
    from farelane.plans.q_select import _base_sql
    return _base_sql() + """,
rd AS (SELECT CASE WHEN split = 'val' THEN 'reference' ELSE 'current' END AS dataset, y, p
       FROM preds WHERE candidate = 'ols_distance' AND split IN ('val', 'test')),
m AS (SELECT dataset, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
        avg(abs((y - p) / CASE WHEN abs(y) < 1e-8 THEN 1e-8 ELSE y END)) * 100 AS mape,
        quantile_cont(abs(y - p), 0.5) AS medae,
        CASE WHEN var_pop(y) = 0 THEN (CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1e0 ELSE 0e0 END)
             ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS r2,
        avg(y - p) AS mean_error, stddev_pop(y - p) AS error_std FROM rd GROUP BY dataset),
l AS (SELECT dataset, metric, value FROM m UNPIVOT (value FOR metric IN (rmse, mae, mape, medae, r2, mean_error, error_std))),
x AS (SELECT metric, max(CASE WHEN dataset = 'reference' THEN value END) AS reference,
             max(CASE WHEN dataset = 'current' THEN value END) AS current FROM l GROUP BY metric)
SELECT metric, round(reference, 6) AS reference, round(current, 6) AS current,
       CASE WHEN metric = 'r2' THEN current >= reference - 0.1
            WHEN metric = 'mean_error' THEN abs(current - reference) <= 0.1 * (SELECT reference FROM x WHERE metric = 'error_std')
            ELSE current <= reference * (1 + 0.1) END AS passed
FROM x"""


Q["regression_drift"] = regression_drift
SQL["regression_drift"] = _regression_drift_sql()
