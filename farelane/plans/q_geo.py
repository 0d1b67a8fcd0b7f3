"""Registered queries: point in polygon and the polygon filter.

The polygon is a parameter (an outer ring with a hole, plus a second
triangle), given as WKT like a user's land mask; the points are the trips."""

from __future__ import annotations

from farelane.operators import polygon as PG
from farelane.plans import pipeline
from farelane.plans.common import comparable
from farelane.plans.sqltext import clean_ctes, lit
from farelane.sources.tables import load_trips

Q, SQL = {}, {}

# Polygon set (parameter): a pentagon with a square hole and a triangle (one
# multi-polygon), and a square that overlaps the pentagon and covers half of
# the hole.  Trip coordinates are multiples of 1e-4, so some lie on edges.
POLYGONS = {
    1: ("MULTIPOLYGON (((-74.02 40.62, -73.78 40.62, -73.80 40.80, -73.90 40.88, -74.02 40.85, "
        "-74.02 40.62), (-73.95 40.70, -73.90 40.70, -73.90 40.75, -73.95 40.75, -73.95 40.70)), "
        "((-74.05 40.86, -73.98 40.90, -74.05 40.90, -74.05 40.86)))"),
    2: "POLYGON ((-73.925 40.65, -73.85 40.65, -73.85 40.85, -73.925 40.85, -73.925 40.65))",
}


def _edges(spark):
    return PG.edges_from_wkt(spark.createDataFrame(list(POLYGONS.items()), "poly_id long, wkt string"))


def points_in_polygon(spark, sf):
    cl = pipeline.clean_trips(load_trips(spark, sf))
    e = _edges(spark)
    t = PG.point_in_polygon(cl, e, "Start_Lon", "Start_Lat", "start_inside")
    t = PG.point_in_polygon(t, e, "End_Lon", "End_Lat", "end_inside")
    return t.select("trip_id", "start_inside", "end_inside")


def polygon_filter(spark, sf):
    cl = pipeline.clean_trips(load_trips(spark, sf))
    return comparable(PG.filter_in_polygon(cl, _edges(spark)).select("trip_id", "Start_Lon", "End_Lat"), 6)


Q.update(points_in_polygon=points_in_polygon, polygon_filter=polygon_filter)


def _edge_values() -> str:
    import re
    rows = []
    for pid, wkt in POLYGONS.items():
        for ring in re.findall(r"\(([^()]+)\)", wkt):
            pts = [tuple(float(v) for v in p.split()) for p in ring.split(",")]
            rows += [f"({pid}, {lit(a[0])}, {lit(a[1])}, {lit(b[0])}, {lit(b[1])})" for a, b in zip(pts[:-1], pts[1:])]
    return "VALUES " + ", ".join(rows)


def _inside(name: str, x: str, y: str) -> str:
    """Per point and polygon: crossings of the upward edges minus those of the
    downward ones differ by parity, and no edge holds the point."""
    return f"""{name} AS (
  SELECT trip_id, bool_or(odd AND NOT on_edge) AS inside FROM (
    SELECT trip_id, pid,
           sum(CASE WHEN least(y1, y2) <= {y} AND {y} < greatest(y1, y2)
                     AND {x} < x1 + ({y} - y1) * (x2 - x1) / (y2 - y1) THEN 1 ELSE 0 END) % 2 = 1 AS odd,
           bool_or({x} BETWEEN least(x1, x2) AND greatest(x1, x2) AND {y} BETWEEN least(y1, y2) AND greatest(y1, y2)
                   AND ({x} - x1) * (y2 - y1) = ({y} - y1) * (x2 - x1)) AS on_edge
    FROM pts CROSS JOIN edges GROUP BY trip_id, pid) GROUP BY trip_id)"""


_GEO = f"""WITH {clean_ctes()},
edges AS (SELECT * FROM ({_edge_values()}) e(pid, x1, y1, x2, y2)),
pts AS (SELECT trip_id, CAST(Start_Lon AS DOUBLE) AS sx, CAST(Start_Lat AS DOUBLE) AS sy,
               CAST(End_Lon AS DOUBLE) AS ex, CAST(End_Lat AS DOUBLE) AS ey FROM cleaned),
{_inside('s_in', 'sx', 'sy')},
{_inside('e_in', 'ex', 'ey')},
io AS (SELECT trip_id, sx, ey, s_in.inside AS start_inside, e_in.inside AS end_inside
       FROM pts JOIN s_in USING (trip_id) JOIN e_in USING (trip_id))"""

SQL["points_in_polygon"] = _GEO + "\nSELECT trip_id, start_inside, end_inside FROM io"
SQL["polygon_filter"] = _GEO + """
SELECT trip_id, round(sx, 6) AS Start_Lon, round(ey, 6) AS End_Lat FROM io WHERE start_inside AND end_inside"""
