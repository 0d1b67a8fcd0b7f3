"""Base pipeline: raw trips -> cleaned trips -> feature table.

One lazily built plan; the only actions are the fit aggregations over the
training rows (their results are a few dozen numbers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.config import IMPUTER_COLUMNS, ROUTE_SCALED_COLUMNS, SCALED_COLUMNS, OutlierRules
from farelane.operators import clean, features, prep
from farelane.operators.polygon import filter_in_polygon
from farelane.session import materialize


def ingest(raw: DataFrame, polygon: DataFrame | None = None) -> DataFrame:
    """NaN -> null, strings -> timestamps, coordinates in range and, with a
    polygon (edge table), start and end inside it."""
    df = clean.coordinates_in_range(clean.to_datetime(clean.nan_to_nulls(raw)))
    return filter_in_polygon(df, polygon)


def ingest_requests(requests: DataFrame, ts: str = "Trip_Pickup_DateTime") -> DataFrame:
    """Request rows: NaN -> null; the pickup time is parsed leniently and a
    missing or invalid one becomes the current time."""
    df = clean.to_datetime(clean.nan_to_nulls(requests), [ts])
    return df.withColumn(ts, F.coalesce(F.col(ts), F.current_timestamp().cast("timestamp_ntz")))


def clean_trips(raw: DataFrame, rules: OutlierRules = OutlierRules()) -> DataFrame:
    """Ingest + outlier rules.  The rules reject NaN themselves, so the raw
    columns go straight into them and their comparisons are pushed to the scan."""
    return clean.filter_outliers(clean.coordinates_in_range(clean.to_datetime(raw)), rules)


def base_features(cleaned: DataFrame, imputer=None) -> DataFrame:
    """Impute (when params are given) -> cyclic time -> POI distances."""
    df = prep.transform_imputer(cleaned, imputer) if imputer is not None else cleaned
    df = features.time_features(df)
    return features.poi_distances(df)


def feature_table(raw: DataFrame, split_col: str | None = "split", fit_on: str = "train",
                  method: str = "standard", rules: OutlierRules = OutlierRules(),
                  scaler=None, imputer=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (features, scaler params, imputer params).

    Params are fitted on ``split_col == fit_on`` unless given (transform-only
    reuse in later runs)."""
    cleaned = clean_trips(raw, rules)
    if imputer is None or scaler is None:
        # the fits and the transform all read the cleaned stage: write it once
        cleaned = materialize(cleaned)
    train = cleaned.filter(F.col(split_col) == fit_on) if split_col else cleaned
    if imputer is None:
        imputer = prep.fit_imputer(train, IMPUTER_COLUMNS)
    feats = base_features(cleaned, imputer)
    if scaler is None:
        scaler = prep.fit_scaler(feats.filter(F.col(split_col) == fit_on) if split_col else feats,
                                 SCALED_COLUMNS, method)
    out = features.passenger_scale(prep.transform_scaler(feats, scaler))
    return out, scaler, imputer


def processed_table(split_raw: DataFrame, provider=None, routes: DataFrame | None = None,
                    artefacts: dict | None = None, rules: OutlierRules = OutlierRules(),
                    add_routes: bool = True, use_raw_haversine: bool = False,
                    route_cache: str | None = None):
    """Feature table with route features: clean -> features -> scale ->
    routes -> route filter -> ratios -> route scaling.

    Params are fitted on ``split == 'train'`` unless ``artefacts`` (dicts from
    a previous run) are given; ``route_cache`` names a routes table that is
    read and extended with the keys it lacks.  Returns (table, artefacts as dicts)."""
    from farelane.operators import routes as R
    a = dict(artefacts or {})
    feats, scaler, imputer = feature_table(split_raw, "split", "train", "standard", rules,
                                           scaler=a.get("scaler"), imputer=a.get("imputer"))
    a["scaler"] = scaler if isinstance(scaler, dict) else prep.params_dict(scaler)
    a["imputer"] = imputer if isinstance(imputer, dict) else prep.params_dict(imputer)
    # stage boundary (the processed table): cuts the lineage before the route
    # join so later stages neither recompute nor fuse the whole feature chain
    feats = materialize(feats)
    if not add_routes:
        return feats, a
    if routes is None and route_cache:
        # keys come from the stage just written: no second cleaning pass
        routes = R.update_route_cache(feats.sparkSession, feats, provider or R.taxicab_provider, route_cache)
    elif routes is None:
        # written: the provider is called once per key, whatever reads the routes
        routes = materialize(R.fetch_routes(R.route_keys(feats), provider or R.taxicab_provider))
    t = R.route_filter(R.join_routes(feats, routes))
    if use_raw_haversine:
        # undo the z-score for the ratio only (the stored column stays scaled)
        st = a["scaler"]["haversine_distance_m"]
        t = t.withColumn("haversine_raw_m", F.col("haversine_distance_m") * st["scale"] + st["center"])
    t = features.route_ratios(t, use_raw_haversine=use_raw_haversine).drop("haversine_raw_m")
    if "route_scaler" not in a:
        a["route_scaler"] = prep.params_dict(prep.fit_scaler(
            t.filter(F.col("split") == "train"), ROUTE_SCALED_COLUMNS, "standard", artefact="route_scaler"))
    return prep.transform_scaler(t, a["route_scaler"]), a


def score_features(requests: DataFrame, artefacts: dict, routes: DataFrame | None = None,
                   provider=None) -> DataFrame:
    """Request rows -> model features with stored params, no outlier rules:
    haversine -> impute -> time -> POI -> scale -> passengers -> routes ->
    ratios -> route scale.  Row-wise except the route lookup, so a streaming
    DataFrame works with a static routes table (stream-static join)."""
    from farelane.operators import routes as R
    from farelane.functions.columns import as_float, haversine_m
    df = requests.withColumn("haversine_distance_m", as_float(haversine_m("Start_Lat", "Start_Lon",
                                                                           "End_Lat", "End_Lon")))
    df = prep.transform_imputer(df, artefacts["imputer"])
    df = features.poi_distances(features.time_features(df))
    df = features.passenger_scale(prep.transform_scaler(df, artefacts["scaler"]))
    if routes is None:
        routes = R.fetch_routes(R.route_keys(df), provider or R.taxicab_provider)
    df = features.route_ratios(R.join_routes(df, routes))
    return prep.transform_scaler(df, artefacts["route_scaler"])
