"""Registered queries: regression metrics, multi-criteria selection, ridge
stacking, promotion, version registry and ledger.

Candidates are closed-form models fitted on the training months of the
derived trips (so that SQL can state them too): the train mean, OLS on the
metered distance, OLS on the duration, and a ridge stack of the two OLS
predictions.  Their work grows with the trips table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from farelane.operators import metrics as M
from farelane.operators import selection as SEL
from farelane.operators import split as S
from farelane.operators import stacking as ST
from farelane.plans import pipeline
from farelane.plans.common import comparable
from farelane.plans.sqltext import clean_ctes
from farelane.session import materialize
from farelane.sources.tables import MONTHLY_TRIPS_SQL, load_monthly_trips

Q, SQL = {}, {}
ALPHA = 0.5


def labelled_clean(spark, sf):
    """Ingest -> month split -> val/test half split -> outlier rules."""
    t = pipeline.ingest(load_monthly_trips(spark, sf))
    return pipeline.clean.filter_outliers(S.split_train_val_test(t))


def candidate_predictions(spark, sf):
    """Rows of val/test with the four candidates' predictions, plus the fitted
    coefficients."""
    cl = materialize(labelled_clean(spark, sf))
    train = cl.filter(F.col("split") == "train")
    feats = ["Real_distance", "Real_time"]
    sums = ST.gram_sums(train, feats, "Fare_Amt")          # one pass, three fits
    mean = ST.ridge_from_sums(sums, feats, [], "Fare_Amt", 0.0)["intercept"]
    ols_d = ST.ridge_from_sums(sums, feats, ["Real_distance"], "Fare_Amt", 0.0)
    ols_t = ST.ridge_from_sums(sums, feats, ["Real_time"], "Fare_Amt", 0.0)
    d = ST.ridge_predict(ST.ridge_predict(cl, ols_d, "pred_distance"), ols_t, "pred_time")
    d = d.withColumn("pred_mean", F.lit(mean))
    meta = ST.ridge_fit(d.filter(F.col("split") == "train"), ["pred_time", "pred_distance"], "Fare_Amt", ALPHA)
    d = ST.ridge_predict(d, meta, "pred_stacked")
    return d, meta


PREDS = {"mean": "pred_mean", "ols_distance": "pred_distance", "ols_time": "pred_time",
         "stacked": "pred_stacked"}


def regression_metrics(spark, sf):
    d, _ = candidate_predictions(spark, sf)
    long = M.melt_predictions(d.filter(F.col("split").isin("val", "test")), "Fare_Amt", PREDS, ["split"])
    wide = M.regression_metrics(long, ["candidate", "split"])
    return comparable(M.metrics_long(wide, ["candidate", "split"]), 6)


def val_metrics(spark, sf):
    d, _ = candidate_predictions(spark, sf)
    long = M.melt_predictions(d.filter(F.col("split") == "val"), "Fare_Amt", PREDS)
    return M.metrics_long(M.regression_metrics(long, ["candidate"]), ["candidate"])


def mcdm_scores(spark, sf):
    return comparable(SEL.mcdm_scores(val_metrics(spark, sf)), 6)


def mcdm_gaps(spark, sf):
    """Selection with a metric that one candidate lacks, an infinite value, and
    two equal candidates that keep their order of evaluation."""
    m = val_metrics(spark, sf)
    m = m.filter(~((F.col("candidate") == "ols_time") & (F.col("metric") == "mape")))
    m = m.withColumn("value", F.when((F.col("candidate") == "mean") & (F.col("metric") == "medae"), F.lit(float("inf")))
                     .otherwise(F.col("value")))
    twin = m.filter(F.col("candidate") == "stacked").withColumn("candidate", F.lit("a_twin"))
    order = (F.when(F.col("candidate") == "mean", 0).when(F.col("candidate") == "ols_distance", 1)
             .when(F.col("candidate") == "ols_time", 2).when(F.col("candidate") == "stacked", 3).otherwise(4))
    scored = SEL.mcdm_scores(m.unionByName(twin).withColumn("evaluated", order), order_col="evaluated")
    return comparable(scored.withColumn("score", F.round("score", 9)).drop("evaluated"), 6)


def scoring_resolution(spark, sf):
    """Versions made from the trips: one per remainder of the trip's number by
    17, with a meta-model for every third one; promoted in turn as nothing,
    new, stacked and old; every seventh lacks a final model."""
    v = load_monthly_trips(spark, sf).select((F.col("trip_id") % 17 + 1).alias("n")).distinct()
    version = F.concat(F.lit("v"), F.col("n").cast("string"))
    entries = (("gbt_b", "base", F.lit(True)), ("stacked", "meta", F.col("n") % 3 == 0), ("final", "new", F.col("n") % 7 != 0))
    rows = F.array(*[F.struct(F.lit(k).alias("model_key"), F.lit(t).alias("kind"), has.alias("has")) for k, t, has in entries])
    reg = v.select(version.alias("version"), F.inline(rows)).filter("has").drop("has")
    chosen = F.when(F.col("n") % 4 == 1, "new").when(F.col("n") % 4 == 2, "old").when(F.col("n") % 4 == 3, "stacked")
    promo = v.select(version.alias("version"), chosen.alias("chosen_on_val")).filter(F.col("chosen_on_val").isNotNull())
    return comparable(SEL.scoring_resolution(reg, promo))


def promotion_choice(spark, sf):
    """old = OLS on duration, new = OLS on distance, stacked = ridge of both."""
    m = val_metrics(spark, sf).withColumn(
        "candidate", F.when(F.col("candidate") == "ols_time", "old")
        .when(F.col("candidate") == "ols_distance", "new").otherwise(F.col("candidate")))
    return comparable(SEL.promotion_choice(m, "rmse"), 6)


def ridge_stack(spark, sf):
    _, meta = candidate_predictions(spark, sf)
    return comparable(ST.coef_table(spark, meta).select("column", "value"), 6)


def stack_in_sample(spark, sf):
    """Ridge (alpha 1.2) on an 80 % hash sample of the training rows over the
    two OLS candidates' predictions: the base stacking mode."""
    d, _ = candidate_predictions(spark, sf)
    coefs = ST.stack_in_sample(d.filter(F.col("split") == "train"), ["pred_time", "pred_distance"], "Fare_Amt",
                               alpha=1.2, fraction=0.8, seed=42)
    return comparable(ST.coef_table(spark, coefs).select("column", "value"), 6)


Q["stack_in_sample"] = stack_in_sample


def _ledger(spark, sf):
    ms = S.month_split(load_monthly_trips(spark, sf))
    v1 = SEL.ledger_from(ms.filter(F.col("split") == "train"), "v1")
    v2 = SEL.ledger_from(ms.filter(F.col("split") == "valtest"), "v2")
    return v1.unionByName(v2)


def ledger(spark, sf):
    return _ledger(spark, sf)


def latest_version(spark, sf):
    return comparable(SEL.latest_version(_ledger(spark, sf)))


def months_to_read(spark, sf):
    """Next 3-month window from the newest ledger month, minus months used."""
    led = _ledger(spark, sf)
    start = led.agg(F.max("month")).first()[0]
    return SEL.months_to_read(spark, led, start, 3)


def month_window(spark, sf):
    """The three-month read window starting at the newest ledger month."""
    led = _ledger(spark, sf)
    start = led.agg(F.max("month")).first()[0]
    return spark.range(1).select(F.explode(F.expr(SEL.month_window(start, 3))).alias("month"))


Q.update(month_window=month_window)


def version_chain(spark, sf):
    """Each version of the ledger with its previous version (stacked scoring
    needs both)."""
    return comparable(SEL.versions_ordered(_ledger(spark, sf)).select("version", "num", "previous"))


Q["version_chain"] = version_chain
Q.update(mcdm_gaps=mcdm_gaps, scoring_resolution=scoring_resolution)
Q.update(regression_metrics=regression_metrics, mcdm_scores=mcdm_scores, promotion_choice=promotion_choice,
         ridge_stack=ridge_stack, ledger=ledger, latest_version=latest_version, months_to_read=months_to_read)


# ---------------------------------------------------------------------------
# oracle SQL
# ---------------------------------------------------------------------------
def _base_sql() -> str:
    return f"""WITH {clean_ctes(monthly=True)},
months AS (SELECT month, dense_rank() OVER (ORDER BY month) AS rk FROM (SELECT DISTINCT month FROM trips) m),
vt AS (SELECT trip_id, row_number() OVER (ORDER BY Trip_Pickup_DateTime ASC NULLS LAST, trip_id) AS rn,
              count(*) OVER () AS n FROM ranged JOIN months USING (month) WHERE rk = 3),
labels AS (SELECT r.trip_id, CASE WHEN m.rk <= 2 THEN 'train' WHEN m.rk = 3 THEN
             (CASE WHEN vt.rn <= vt.n // 2 THEN 'val' ELSE 'test' END) ELSE 'extra' END AS split
           FROM ranged r JOIN months m USING (month) LEFT JOIN vt USING (trip_id)),
cl AS (SELECT c.trip_id, l.split, CAST(c.Fare_Amt AS DOUBLE) AS y, CAST(c.Real_distance AS DOUBLE) AS xd,
              CAST(c.Real_time AS DOUBLE) AS xt FROM cleaned c JOIN labels l USING (trip_id)),
fit AS (SELECT avg(y) AS mean_y, regr_intercept(y, xd) AS a_d, regr_slope(y, xd) AS b_d,
               regr_intercept(y, xt) AS a_t, regr_slope(y, xt) AS b_t FROM cl WHERE split = 'train'),
p AS (SELECT cl.*, fit.mean_y AS pred_mean, a_d + b_d * xd AS pred_distance, a_t + b_t * xt AS pred_time
      FROM cl, fit),
mt AS (SELECT avg(pred_time) AS m1, avg(pred_distance) AS m2, avg(y) AS my,
              regr_sxx(y, pred_time) + {ALPHA!r} AS a11, regr_sxx(y, pred_distance) + {ALPHA!r} AS a22,
              covar_pop(pred_time, pred_distance) * count(*) AS a12,
              covar_pop(pred_time, y) * count(*) AS b1, covar_pop(pred_distance, y) * count(*) AS b2
       FROM p WHERE split = 'train'),
meta AS (SELECT (b1 * a22 - a12 * b2) / (a11 * a22 - a12 * a12) AS c1,
                (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS c2, m1, m2, my FROM mt),
coef AS (SELECT my - c1 * m1 - c2 * m2 AS c0, c1, c2 FROM meta),
pp AS (SELECT p.*, c0 + c1 * pred_time + c2 * pred_distance AS pred_stacked FROM p, coef),
preds AS (
  SELECT split, 'mean' AS candidate, y, pred_mean AS p FROM pp
  UNION ALL SELECT split, 'ols_distance', y, pred_distance FROM pp
  UNION ALL SELECT split, 'ols_time', y, pred_time FROM pp
  UNION ALL SELECT split, 'stacked', y, pred_stacked FROM pp),
met AS (SELECT candidate, split, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
          CASE WHEN var_pop(y) * count(*) = 0 THEN (CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1e0 ELSE 0e0 END)
               ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS r2,
          avg(abs((y - p) / CASE WHEN abs(y) < 1e-8 THEN 1e-8 ELSE y END)) * 100 AS mape,
          quantile_cont(abs(y - p), 0.5) AS medae
        FROM preds WHERE split IN ('val', 'test') GROUP BY candidate, split),
ml AS (SELECT candidate, split, metric, value FROM met
       UNPIVOT (value FOR metric IN (rmse, mae, r2, mape, medae)))"""


SQL["regression_metrics"] = _base_sql() + """
SELECT candidate, split, metric, round(value, 6) AS value FROM ml"""

SQL["ridge_stack"] = _base_sql() + """
SELECT 'intercept' AS column, round(c0, 6) AS value FROM coef
UNION ALL SELECT 'pred_time', round(c1, 6) FROM coef
UNION ALL SELECT 'pred_distance', round(c2, 6) FROM coef"""

SQL["mcdm_scores"] = _base_sql() + """,
v AS (SELECT candidate, metric, value FROM ml WHERE split = 'val'),
mm AS (SELECT *, min(value) OVER (PARTITION BY metric) AS mn, max(value) OVER (PARTITION BY metric) AS mx FROM v),
nm AS (SELECT candidate, metric,
         CASE WHEN mx = mn THEN 0.5
              ELSE least(greatest(CASE WHEN metric = 'r2' THEN (mx - value) / (mx - mn)
                                       ELSE (value - mn) / (mx - mn) END, 0e0), 1e0) END AS norm FROM mm),
sc AS (SELECT candidate, sum(norm * CASE metric WHEN 'rmse' THEN 0.5 WHEN 'mae' THEN 0.25 WHEN 'r2' THEN 0.05
                                   WHEN 'mape' THEN 0.1 ELSE 0.1 END) AS score FROM nm GROUP BY candidate)
SELECT candidate, round(score, 6) AS score, row_number() OVER (ORDER BY score, candidate)::BIGINT AS rank FROM sc"""

SQL["promotion_choice"] = _base_sql() + """,
v AS (SELECT candidate, metric, value FROM ml WHERE split = 'val'),
w AS (SELECT max(CASE WHEN candidate = 'ols_time' AND metric = 'rmse' THEN value END) AS old_val,
             max(CASE WHEN candidate = 'ols_distance' AND metric = 'rmse' THEN value END) AS new_val,
             max(CASE WHEN candidate = 'stacked' AND metric = 'rmse' THEN value END) AS stacked_val FROM v)
SELECT CASE WHEN new_val < old_val AND stacked_val < old_val THEN
              (CASE WHEN new_val <= stacked_val THEN 'new' ELSE 'stacked' END)
            WHEN new_val < old_val THEN 'new' WHEN stacked_val < old_val THEN 'stacked' END AS chosen_on_val,
       'rmse' AS metric, round(old_val, 6) AS old_val, round(new_val, 6) AS new_val,
       round(stacked_val, 6) AS stacked_val, round(old_val, 6) AS rmse_old, round(new_val, 6) AS rmse_new,
       round(stacked_val, 6) AS rmse_stacked FROM w"""

SQL["mcdm_gaps"] = _base_sql() + """,
v0 AS (SELECT candidate, metric, CASE WHEN candidate = 'mean' AND metric = 'medae' THEN 'inf'::DOUBLE ELSE value END AS value
       FROM ml WHERE split = 'val' AND NOT (candidate = 'ols_time' AND metric = 'mape')),
v AS (SELECT * FROM v0 UNION ALL SELECT 'a_twin', metric, value FROM v0 WHERE candidate = 'stacked'),
cands AS (SELECT * FROM (VALUES ('mean', 0), ('ols_distance', 1), ('ols_time', 2), ('stacked', 3), ('a_twin', 4)) t(candidate, ord)),
g AS (SELECT candidate, ord, m.metric, wt FROM cands, (VALUES ('rmse', 0.5), ('mae', 0.25), ('r2', 0.05), ('mape', 0.1), ('medae', 0.1)) m(metric, wt)),
x AS (SELECT g.*, v.value, min(v.value) OVER (PARTITION BY g.metric) AS mn, max(v.value) OVER (PARTITION BY g.metric) AS mx
      FROM g LEFT JOIN v ON v.candidate = g.candidate AND v.metric = g.metric),
nm AS (SELECT candidate, ord, wt,
         CASE WHEN value IS NULL OR isinf(value) OR mx = mn THEN 0.5
              WHEN isinf(mx) THEN 0.0
              ELSE greatest(0.0, least(1.0, CASE WHEN metric = 'r2' THEN (mx - value) / (mx - mn) ELSE (value - mn) / (mx - mn) END)) END AS norm FROM x),
sc AS (SELECT candidate, ord, round(sum(norm * wt), 9) AS score FROM nm GROUP BY candidate, ord)
SELECT candidate, round(score, 6) AS score, row_number() OVER (ORDER BY score, ord)::BIGINT AS rank FROM sc"""

SQL["scoring_resolution"] = f"""WITH trips AS ({MONTHLY_TRIPS_SQL}),
v AS (SELECT DISTINCT trip_id % 17 + 1 AS n FROM trips),
w AS (SELECT n, n % 3 = 0 AS has_meta, n % 7 <> 0 AS fin, lag(n) OVER (ORDER BY n) AS prev,
             lag(n % 7 <> 0) OVER (ORDER BY n) AS prev_fin,
             CASE n % 4 WHEN 1 THEN 'new' WHEN 2 THEN 'old' WHEN 3 THEN 'stacked' END AS chosen FROM v)
SELECT 'v' || n::VARCHAR AS version, n AS num, 'v' || prev::VARCHAR AS previous, chosen AS chosen_on_val,
       CASE WHEN chosen = 'stacked' AND has_meta AND fin AND prev_fin THEN 'stacked'
            WHEN chosen = 'old' AND prev_fin THEN 'old' ELSE 'latest' END AS method FROM w"""

_LEDGER_SQL = f"""WITH trips AS ({MONTHLY_TRIPS_SQL}),
months AS (SELECT month, dense_rank() OVER (ORDER BY month) AS rk FROM (SELECT DISTINCT month FROM trips) m),
led AS (SELECT CASE WHEN rk <= 2 THEN 'v1' ELSE 'v2' END AS version, month FROM months WHERE rk <= 3)"""

SQL["ledger"] = _LEDGER_SQL + "\nSELECT version, month FROM led"
SQL["latest_version"] = _LEDGER_SQL + """,
v AS (SELECT DISTINCT version, CAST(regexp_extract(version, '(\\d+)', 1) AS BIGINT) AS num FROM led)
SELECT arg_max(version, num) AS latest, max(num) AS latest_num, 'v' || CAST(max(num) + 1 AS VARCHAR) AS next,
       count(*)::BIGINT AS n_versions FROM v"""
SQL["version_chain"] = _LEDGER_SQL + """,
v AS (SELECT DISTINCT version, CAST(regexp_extract(version, '(\\d+)', 1) AS BIGINT) AS num FROM led)
SELECT version, num, lag(version) OVER (ORDER BY num) AS previous FROM v"""
SQL["month_window"] = _LEDGER_SQL + """,
st AS (SELECT max(month) AS m FROM led)
SELECT strftime(CAST(m || '-01' AS DATE) + to_months(CAST(i AS INTEGER)), '%Y-%m') AS month
FROM st, range(0, 3) t(i)"""
SQL["months_to_read"] = _LEDGER_SQL + """,
st AS (SELECT max(month) AS m FROM led),
w AS (SELECT strftime(CAST(m || '-01' AS DATE) + to_months(CAST(i AS INTEGER)), '%Y-%m') AS month
      FROM st, range(0, 3) t(i))
SELECT month FROM w WHERE month NOT IN (SELECT month FROM led)"""


def _stack_in_sample_sql():
    from farelane.plans.q_split import hash_sql
    base = _base_sql()
    return base + f""",
smp AS (SELECT p.* FROM p WHERE split = 'train' AND {hash_sql()} < {int(0.8 * 2 ** 32)}),
st AS (SELECT avg(pred_time) AS m1, avg(pred_distance) AS m2, avg(y) AS my,
              regr_sxx(y, pred_time) + 1.2 AS a11, regr_sxx(y, pred_distance) + 1.2 AS a22,
              covar_pop(pred_time, pred_distance) * count(*) AS a12,
              covar_pop(pred_time, y) * count(*) AS b1, covar_pop(pred_distance, y) * count(*) AS b2 FROM smp),
sc AS (SELECT (b1 * a22 - a12 * b2) / (a11 * a22 - a12 * a12) AS c1,
              (a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS c2, m1, m2, my FROM st)
SELECT 'intercept' AS column, round(my - c1 * m1 - c2 * m2, 6) AS value FROM sc
UNION ALL SELECT 'pred_time', round(c1, 6) FROM sc
UNION ALL SELECT 'pred_distance', round(c2, 6) FROM sc"""


SQL["stack_in_sample"] = _stack_in_sample_sql()
