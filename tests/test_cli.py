"""Command line on monthly files with an alias column layout."""

import json

from farelane.__main__ import main
from farelane.sources.tables import load_monthly_trips

from conftest import SF001

RENAME = {"Trip_Pickup_DateTime": "tpep_pickup_datetime", "Trip_Dropoff_DateTime": "tpep_dropoff_datetime",
          "Passenger_Count": "passenger_count", "Trip_Distance": "trip_distance", "Start_Lon": "pickup_longitude",
          "Start_Lat": "pickup_latitude", "End_Lon": "dropoff_longitude", "End_Lat": "dropoff_latitude",
          "Fare_Amt": "fare_amount", "Total_Amt": "total_amount"}


def test_cli_base_waterfall_score(spark, tmp_path, capsys):
    t = load_monthly_trips(spark, SF001).toPandas().rename(columns=RENAME)
    src = tmp_path / "raw"
    src.mkdir()
    for m, g in t.groupby("month"):
        g.drop(columns=["month", "trip_id"]).to_parquet(src / f"yellow_tripdata_{m}.parquet", index=False,
                                                        coerce_timestamps="us", allow_truncated_timestamps=True)
    root, out = str(tmp_path / "root"), str(tmp_path / "scored")
    main(["waterfall", "--input", str(src)])
    steps = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert steps[0]["rows"] == len(t) and steps[-1]["rows"] <= steps[0]["rows"]
    main(["base", "--input", str(src), "--root", root, "--quick"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["version"] == "v1"
    main(["score", "--input", str(src), "--months", "2024-03", "--root", root, "--output", out])
    assert spark.read.parquet(out).count() > 0
