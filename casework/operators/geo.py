"""Point-in-polygon zone tagging (G01-G03) over a grid index.

A zone layer is a table of rings (``read_rings``, ``read_kml``: one ring a
row; several rings of a zone are its parts and holes).  ``zone_index`` cuts it
on Spark into cells: each edge is dealt to the row bands that it meets and, in
a band, to the cells that its part there may touch.  Edges that lie to the
right of a cell cross the ray of a point in it or not by the point's height
alone; heights at which that changes are summed up by exclusive or from right
to left, where those of neighbouring edges cancel out, so that a cell keeps its
own edges and a few heights (one at minus infinity if it lies inside).

Points compute their cell and take an equi-join on it (no cross join, no
per-point fan-out: one cell row a point), broadcast if the index is small in
bytes.  The exact test runs in higher-order functions over the cell's edges:
crossing parity (ray cast) and an explicit on-edge check, because the
predicate is *strict* ``within``: boundary and corner points are outside.  The
first zone by (priority, ord) that strictly contains the point wins, giving
sub-zone > district > null and first-match for duplicates without any shuffle.
The built-in layer is a handful of zones and is cut here.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from casework.functions.scalars import to_coordinate
from casework.operators.joins import DEFAULT_BROADCAST_BYTES
from casework.session import ensure_checkpoint_dir, write_table


@dataclass(frozen=True)
class Zone:
    zone_id: str
    comuna: float
    priority: int
    ord: int
    ring: tuple[tuple[float, float], ...]
    #: further rings: a ring inside another is a hole, one outside a part
    more: tuple[tuple[tuple[float, float], ...], ...] = field(default=())

    def edges(self):
        out = []
        for ring in (self.ring, *self.more):
            pts = list(ring)
            if pts[0] != pts[-1]:
                pts.append(pts[0])
            out += [(a[0], a[1], b[0], b[1]) for a, b in zip(pts, pts[1:])]
        return out

    def box(self) -> tuple[float, float, float, float]:
        xs, ys = zip(*(p for ring in (self.ring, *self.more) for p in ring))
        return min(xs), min(ys), max(xs), max(ys)


# Synthetic layer (the source's district shapefile is not available): a
# priority sub-zone split in two rings sharing an edge, districts with shared
# edges, one concave ring.  Coordinates are planar (x = longitude, y = latitude).
SYNTHETIC_ZONES = [
    Zone("sub_a", 1.5, 0, 0, ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))),
    Zone("sub_b", 1.5, 0, 1, ((2, 0), (4, 0), (4, 2), (2, 2), (2, 0))),
    Zone("d1", 1.0, 1, 0, ((0, 0), (6, 0), (6, 4), (0, 4), (0, 0))),
    Zone("d2", 2.0, 1, 1, ((6, 0), (9, 1), (8, 4), (6, 4), (6, 0))),
    Zone("d12", 12.0, 1, 2, ((9, 1), (10, 1), (10, 4), (8, 4), (9, 1))),
    Zone("d13", 13.0, 1, 3, ((0, 4), (5, 4), (5, 6), (0, 6), (0, 4))),
    Zone("d14", 14.0, 1, 4, ((5, 4), (8, 4), (7, 5), (9, 6), (5, 6), (5, 4))),
]

LEAST_SIDE, MOST_SIDE, EDGES_A_CELL = 32, 4096, 8  # cells along the longer side: the root of edges over EDGES_A_CELL

_EDGE = T.StructType([T.StructField(n, T.DoubleType()) for n in ("x1", "y1", "x2", "y2")])
_ZONE = T.StructType([
    T.StructField("zone_id", T.StringType()),
    T.StructField("comuna", T.DoubleType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("ord", T.IntegerType()),
    T.StructField("edges", T.ArrayType(_EDGE)),
    T.StructField("ys", T.ArrayType(T.DoubleType())),
])
_CELLS = T.StructType([
    T.StructField("_cx", T.LongType()),
    T.StructField("_cy", T.LongType()),
    T.StructField("_zones", T.ArrayType(_ZONE)),
])


def _zone_row(z: Zone):
    return (z.zone_id, float(z.comuna), z.priority, z.ord,
            [tuple(float(v) for v in e) for e in z.edges()], [])


def zone_cells(zones: list[Zone], cell: float) -> list[tuple]:
    """Grid index of the built-in layer: cell -> ordered zones, each with all
    its edges."""
    index: dict[tuple[int, int], list[Zone]] = {}
    for z in zones:
        x1, y1, x2, y2 = z.box()
        for cx in range(math.floor(x1 / cell), math.floor(x2 / cell) + 1):
            for cy in range(math.floor(y1 / cell), math.floor(y2 / cell) + 1):
                index.setdefault((cx, cy), []).append(z)
    return [(cx, cy, [_zone_row(z) for z in sorted(zs, key=lambda z: (z.priority, z.ord))])
            for (cx, cy), zs in sorted(index.items())]


def cell_size(zones: list[Zone], per_side: int = 32) -> float:
    """Grid step of the built-in layer: its longer side in ``per_side`` cells."""
    x1, y1, x2, y2 = (f(v) for f, v in zip((min, min, max, max), zip(*(z.box() for z in zones))))
    return max(x2 - x1, y2 - y1) / per_side or 1.0


def read_rings(spark: SparkSession, path: str) -> DataFrame:
    """A zone layer from a Parquet table with one ring per row: zone_id,
    comuna, priority, ord, ring (array of structs x, y, in the units of the
    records' coordinates).  Rings of equal (priority, ord, zone_id, comuna)
    make one zone."""
    return spark.read.parquet(path).select("zone_id", F.col("comuna").cast("double").alias("comuna"), "priority", "ord", "ring")


_BOUNDARY = "struct<LinearRing: struct<coordinates: string>>"
_POLYGON = f"struct<outerBoundaryIs: {_BOUNDARY}, innerBoundaryIs: array<{_BOUNDARY}>>"
KML_SCHEMA = f"name string, Polygon array<{_POLYGON}>, MultiGeometry array<struct<Polygon: array<{_POLYGON}>>>"


def read_kml(spark: SparkSession, path: str, comuna: float, priority: int = 0) -> DataFrame:
    """The rings of KML files, as ``read_rings`` gives them.  Every
    placemark is a zone of the given district, named by its name; its outer
    and inner boundaries are its parts and holes; heights are left out.  Zones
    count in the order of file and name."""
    marks = (spark.read.format("xml").option("rowTag", "Placemark").schema(KML_SCHEMA).load(path)
             .withColumn("file", F.col("_metadata.file_path")))
    flat = F.flatten(F.transform(F.coalesce("MultiGeometry", F.array()), lambda g: F.coalesce(g["Polygon"], F.array())))
    polygons = F.concat(F.coalesce("Polygon", F.array()), flat)
    bounds = F.flatten(F.transform(polygons, lambda p: F.concat(F.array(p["outerBoundaryIs"]), F.coalesce(p["innerBoundaryIs"], F.array()))))
    texts = marks.select("file", "name", F.explode(F.transform(bounds, lambda b: b["LinearRing"]["coordinates"])).alias("text"))

    def point(word):
        xy = F.split(word, ",")
        return F.struct(F.get(xy, 0).try_cast("double").alias("x"), F.get(xy, 1).try_cast("double").alias("y"))

    points = F.transform(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " "), point)
    named = texts.select("file", "name", F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull()).alias("ring"))
    order = named.select(F.col("file").alias("_f"), F.col("name").alias("_n")).distinct().withColumn(  # map data: one row a placemark
        "ord", F.row_number().over(Window.orderBy("_f", "_n")) - 1)
    return (named.join(order, F.col("file").eqNullSafe(F.col("_f")) & F.col("name").eqNullSafe(F.col("_n")))
            .select(F.col("name").alias("zone_id"), F.lit(float(comuna)).alias("comuna"), F.lit(priority).alias("priority"),
                    F.col("ord").cast("int").alias("ord"), "ring"))


@dataclass(frozen=True)
class ZoneIndex:
    """A layer's cells, as a written table, their size, and whether they are
    small enough to broadcast."""
    path: str
    cell: float
    small: bool

    def cells(self, spark: SparkSession) -> DataFrame:
        df = spark.read.parquet(self.path)
        return F.broadcast(df) if self.small else df


def zone_index(rings: DataFrame, cell: float | None = None, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> ZoneIndex:
    """The grid index of a table of rings; null and short rings are left out.
    What the driver gets are the layer's bounds and counts."""
    spark = rings.sparkSession
    key = F.to_json(F.struct("priority", "ord", "zone_id", "comuna"))
    n = F.size("ring")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.get("ring", i)["x"].alias("x1"), F.get("ring", i)["y"].alias("y1"),
        F.get("ring", (i + 1) % n)["x"].alias("x2"), F.get("ring", (i + 1) % n)["y"].alias("y2")))
    edges = (rings.filter(n >= 3).select(key.alias("zone"), "zone_id", "comuna", "priority", "ord", F.explode(pairs).alias("e"))
             .select("zone", "zone_id", "comuna", "priority", "ord", "e.*").filter("x1 <> x2 OR y1 <> y2"))
    edges = write_table(edges, "zone-edges")
    box = edges.agg(F.min(F.least("x1", "x2")).alias("x1"), F.max(F.greatest("x1", "x2")).alias("x2"),
                    F.min(F.least("y1", "y2")).alias("y1"), F.max(F.greatest("y1", "y2")).alias("y2"), F.count(F.lit(1)).alias("n")).first()
    if not box["n"]:
        raise ValueError("the zone layer has no rings")
    if cell is None:
        side = min(MOST_SIDE, max(LEAST_SIDE, math.ceil(math.sqrt(box["n"] / EDGES_A_CELL))))
        cell = max(box["x2"] - box["x1"], box["y2"] - box["y1"]) / side or 1.0

    def at(x):
        return F.floor(x / cell)

    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = edges.select("*", F.explode(F.sequence(at(low), at(high))).alias("b"))
    # the part of the edge within the band, a little more than that for rounding
    slope = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))

    def x_at(y):
        return F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (y - F.col("y1")) * slope)

    xa = x_at(F.greatest(low, F.col("b") * cell - cell * 1e-9))
    xb = F.when(F.col("y1") == F.col("y2"), F.col("x2")).otherwise(x_at(F.least(high, (F.col("b") + 1) * cell + cell * 1e-9)))
    banded = banded.withColumns({"c0": at(F.least(xa, xb) - cell * 1e-6), "c1": at(F.greatest(xa, xb) + cell * 1e-6)})
    banded = write_table(banded, "zone-bands")
    near = banded.select("zone", "b", F.explode(F.sequence("c0", "c1")).alias("c"), F.struct("x1", "y1", "x2", "y2").alias("e"))
    near = near.groupBy("zone", "b", "c").agg(F.collect_list("e").alias("edges"))

    heights = F.array(F.when(at(low) < F.col("b"), F.lit(float("-inf"))).otherwise(low), F.when(at(high) == F.col("b"), high))
    odd = F.count(F.lit(1)) % 2 == 1
    changes = (banded.filter("y1 <> y2").select("zone", "b", "c0", F.explode(heights).alias("y")).filter("y is not null")
               .groupBy("zone", "b", "c0", "y").agg(odd.alias("odd")).filter("odd").drop("odd"))
    spans = (banded.groupBy("zone", "b").agg(F.min("c0").alias("first"), F.max("c1").alias("last"))
             .select("zone", "b", F.explode(F.sequence("first", "last")).alias("c")))
    right = (spans.join(changes, ["zone", "b"]).filter("c0 > c").groupBy("zone", "b", "c", "y").agg(odd.alias("odd")).filter("odd")
             .groupBy("zone", "b", "c").agg(F.sort_array(F.collect_list("y")).alias("ys")))
    named = edges.select("zone", "zone_id", "comuna", "priority", "ord").distinct()
    full = (near.join(right, ["zone", "b", "c"], "full").join(named, "zone")
            .select("b", "c", F.struct("priority", "ord", "zone_id", "comuna", F.coalesce("edges", F.array()).alias("edges"),
                                       F.coalesce("ys", F.array()).alias("ys")).alias("z")))
    path = f"{ensure_checkpoint_dir(spark)}/tables/zone-index-{uuid.uuid4().hex}"
    (full.groupBy(F.col("c").alias("_cx"), F.col("b").alias("_cy")).agg(F.sort_array(F.collect_list("z")).alias("_zones"))
     .write.parquet(path))
    size = F.aggregate("_zones", F.lit(64).cast("long"), lambda a, z: a + 96 + 48 * F.size(z["edges"]) + 8 * F.size(z["ys"]))
    total = spark.read.parquet(path).agg(F.sum(size)).first()[0] or 0
    return ZoneIndex(path, float(cell), total <= max_bytes)


def read_zones(spark: SparkSession, path: str) -> ZoneIndex:
    """The index of a ring table."""
    return zone_index(read_rings(spark, path))


def zones_df(spark: SparkSession, zones: list[Zone] = SYNTHETIC_ZONES) -> DataFrame:
    return spark.createDataFrame([_zone_row(z) for z in zones], _ZONE)


# Strict containment of (_px, _py) in zone z, as a SQL lambda body.
_INSIDE = ("aggregate(z.edges, size(filter(z.ys, y -> y <= _py)) % 2 = 1, (acc, e) -> acc != "
           "(((e.y1 > _py) != (e.y2 > _py)) AND "
           "(_px < (e.x2 - e.x1) * (_py - e.y1) / (e.y2 - e.y1) + e.x1)))")
_ON_EDGE = ("exists(z.edges, e -> (e.x2 - e.x1) * (_py - e.y1) - (e.y2 - e.y1) * (_px - e.x1) = 0 "
            "AND _px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
            "AND _py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))")
_FIRST_CONTAINING = f"get(filter(_zones, z -> ({_INSIDE}) AND NOT ({_ON_EDGE})), 0)"


def assign_zone(df: DataFrame, lon_col: str = "longitud", lat_col: str = "latitud",
                out_col: str = "comuna_calculada", zones: ZoneIndex | None = None,
                cell: float | None = None) -> DataFrame:
    """Priority overlay of zone layers (``zones``, else the built-in one);
    rows without coordinates get null.  An index above the byte bound is joined
    by a shuffle."""
    spark = df.sparkSession
    if zones is None:
        cell = cell or cell_size(SYNTHETIC_ZONES)
        cell_df = F.broadcast(spark.createDataFrame(zone_cells(SYNTHETIC_ZONES, cell), _CELLS))  # a few hundred cells
    else:
        cell, cell_df = zones.cell, zones.cells(spark)
    pts = (df.withColumn("_px", to_coordinate(F.col(lon_col)))
             .withColumn("_py", to_coordinate(F.col(lat_col)))
             .withColumn("_pcx", F.floor(F.col("_px") / cell))
             .withColumn("_pcy", F.floor(F.col("_py") / cell)))
    joined = pts.join(cell_df, (F.col("_pcx") == F.col("_cx")) & (F.col("_pcy") == F.col("_cy")), "left")
    # a column of its own: both of its fields are read, and Spark finds no common part in lambdas
    return (joined.withColumn("_hit", F.expr(_FIRST_CONTAINING))
                  .withColumn(out_col, F.col("_hit")["comuna"])
                  .withColumn("zone_id", F.col("_hit")["zone_id"])
                  .drop("_px", "_py", "_pcx", "_pcy", "_cx", "_cy", "_zones", "_hit"))
