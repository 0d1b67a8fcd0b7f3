"""Point in polygon at table scale.

The polygons enter as an edge table ``(poly_id, ring, x1, y1, x2, y2)`` in
WGS84 (from rings or from WKT text).  A point is inside a set of polygons if it
lies strictly inside any of them: even-odd ray casting per polygon (so overlaps
don't cancel and holes work), and a point on an edge is not inside.

The plane is cut into square cells.  A cell that no edge touches is wholly
inside or outside, so most points need no edge at all: they look their cell up.
Only the cells that edges touch hold, per polygon, the edges of their latitude
band to the right of the cell's left border, which is all that a ray towards +x
can meet.  The cell table grows with the polygons, not with the trips; it is
broadcast after a count, and beyond the limit both sides shuffle by cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.session import materialize

EDGE_SCHEMA = "poly_id long, ring long, x1 double, y1 double, x2 double, y2 double"
BROADCAST_LIMIT = 2_000_000        # cells and edge copies that may be broadcast


def edges_from_rings(spark: SparkSession, polygons: dict) -> DataFrame:
    """``{poly_id: [ring, ...]}``, ring = list of (x, y); rings are closed if needed."""
    rows = []
    for pid, rings in polygons.items():
        for ri, ring in enumerate(rings):
            pts = list(ring)
            if pts[0] != pts[-1]:
                pts.append(pts[0])
            rows += [(int(pid), ri, float(a[0]), float(a[1]), float(b[0]), float(b[1]))
                     for a, b in zip(pts[:-1], pts[1:])]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def edges_from_wkt(df: DataFrame, wkt_col: str = "wkt", id_col: str = "poly_id") -> DataFrame:
    """POLYGON / MULTIPOLYGON WKT -> edge table, with native string functions.
    The parts of a multi-polygon don't overlap, so they keep one ``poly_id``."""
    rings = df.select(F.col(id_col).cast("long").alias("poly_id"),
                      F.posexplode(F.regexp_extract_all(F.col(wkt_col), F.lit(r"\(([^()]+)\)"), 1))
                      .alias("ring", "txt"))
    pts = rings.withColumn("pts", F.transform(F.split("txt", ","),
                                              lambda p: F.split(F.trim(p), r"\s+").cast("array<double>")))
    pairs = pts.select("poly_id", F.col("ring").cast("long").alias("ring"),
                       F.explode(F.arrays_zip(F.slice("pts", 1, F.size("pts") - 1).alias("a"),
                                              F.slice("pts", 2, F.size("pts")).alias("b"))).alias("e"))
    return pairs.select("poly_id", "ring", F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"),
                        F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2"))


def cell_index(v: Column, cell: float) -> Column:
    return F.floor(v / F.lit(cell)).cast("long")


def strictly_inside(x: Column, y: Column, edges: Column) -> Column:
    """Odd number of crossings to the right, and on none of the edges."""
    hit = F.filter(edges, lambda e: ((e["y1"] <= y) != (e["y2"] <= y))
                   & (x < e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])))
    on = F.exists(edges, lambda e: (x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
                  & (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"]))
                  & ((x - e["x1"]) * (e["y2"] - e["y1"]) == (y - e["y1"]) * (e["x2"] - e["x1"])))
    return (F.size(hit) % 2 == 1) & ~on


def cell_table(edges: DataFrame, cell: float = 0.05) -> DataFrame:
    """``(cx, cy, whole, polys)``: the cells that are wholly inside
    (``whole``), and those that an edge touches with their edges per polygon.
    Other cells are outside."""
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    e = edges.withColumn("cy", F.explode(F.sequence(cell_index(lo, cell), cell_index(hi, cell))))
    # the part of the edge inside the band, a little widened against rounding
    eps = cell * 1e-9
    top, bottom = (F.col("cy") + 1) * cell, F.col("cy") * cell
    flat = F.col("y1") == F.col("y2")

    def x_at(y):
        t = F.least(F.greatest((y - F.col("y1")) / F.when(flat, 1.0).otherwise(F.col("y2") - F.col("y1")), F.lit(0.0)), F.lit(1.0))
        return F.col("x1") + t * (F.col("x2") - F.col("x1"))

    left = F.when(flat, F.least("x1", "x2")).otherwise(F.least(x_at(bottom), x_at(top)))
    right = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(x_at(bottom), x_at(top)))
    e = e.withColumns({"_left": left, "_right": right})
    touched = e.select("poly_id", "cy", F.explode(F.sequence(cell_index(F.col("_left") - eps, cell),
                                                              cell_index(F.col("_right") + eps, cell))).alias("cx")).distinct()
    band = F.struct("x1", "y1", "x2", "y2")
    bands = e.groupBy("poly_id", "cy").agg(F.collect_list(band).alias("all"), F.min("_left").alias("_l"), F.max("_right").alias("_r"))
    # cells between a polygon's ends in the band that its edges don't touch
    free = (bands.withColumn("cx", F.explode(F.sequence(cell_index(F.col("_l"), cell), cell_index(F.col("_r"), cell))))
            .join(touched, ["poly_id", "cy", "cx"], "left_anti"))
    whole = free.filter(strictly_inside((F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell, F.col("all"))) \
        .select("cx", "cy").distinct()
    part = (touched.join(bands, ["poly_id", "cy"])
            .withColumn("edges", F.filter("all", lambda s: F.greatest(s["x1"], s["x2"]) >= F.col("cx") * cell - eps))
            .groupBy("cx", "cy").agg(F.collect_list("edges").alias("polys")).join(whole, ["cx", "cy"], "left_anti"))
    return (whole.select("cx", "cy", F.lit(True).alias("whole"), F.lit(None).cast(part.schema["polys"].dataType).alias("polys"))
            .unionByName(part.withColumn("whole", F.lit(False))))


def _lookup(points: DataFrame, cells: DataFrame, small: bool, lon: str, lat: str, out: str, cell: float) -> DataFrame:
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    names = {c: f"_{c}_{out}" for c in ("cx", "cy", "whole", "polys")}
    side = cells.select(*[F.col(c).alias(n) for c, n in names.items()])
    p = points.withColumns({f"_px_{out}": cell_index(x, cell), f"_py_{out}": cell_index(y, cell)})
    cond = (F.col(f"_px_{out}") == F.col(names["cx"])) & (F.col(f"_py_{out}") == F.col(names["cy"]))
    j = p.join(F.broadcast(side) if small else side, cond, "left")
    inside = (F.when(F.col(names["whole"]).isNull(), False).when(F.col(names["whole"]), True)
              .otherwise(F.exists(names["polys"], lambda e: strictly_inside(x, y, e))))
    return j.withColumn(out, inside).drop(f"_px_{out}", f"_py_{out}", *names.values())


def _prepared(edges: DataFrame, cell: float) -> tuple[DataFrame, bool]:
    cells = materialize(cell_table(edges, cell))
    n = cells.agg(F.sum(1 + F.coalesce(F.aggregate("polys", F.lit(0), lambda a, e: a + F.size(e)), F.lit(0)))).first()[0] or 0
    return cells, n <= BROADCAST_LIMIT


def point_in_polygon(points: DataFrame, edges: DataFrame, lon: str, lat: str, out: str = "inside",
                     cell: float = 0.05) -> DataFrame:
    """Adds boolean ``out``: the (lon, lat) point is strictly inside one of the
    polygons (false for a missing coordinate)."""
    cells, small = _prepared(edges, cell)
    return _lookup(points, cells, small, lon, lat, out, cell)


def filter_in_polygon(trips: DataFrame, edges: DataFrame | None, cell: float = 0.05) -> DataFrame:
    """Keep trips whose start and end are both inside; no polygon -> unchanged."""
    if edges is None:
        return trips
    cells, small = _prepared(edges, cell)
    t = _lookup(trips, cells, small, "Start_Lon", "Start_Lat", "_in_start", cell)
    t = _lookup(t, cells, small, "End_Lon", "End_Lat", "_in_end", cell)
    return t.filter(F.col("_in_start") & F.col("_in_end")).drop("_in_start", "_in_end")
