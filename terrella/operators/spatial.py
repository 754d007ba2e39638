"""Spatial filters and joins: plain box predicates that reach the scan, then exact tests.

A polygon join never compares all pairs. Both sides are laid on a grid and joined on the cell. A small polygon
goes to a grid whose cells are about as large as its own box; a wide one to a grid 16 times as fine, where cells
inside of it need no test and cells on its border carry only the edges that decide there, so no candidate carries a
whole geometry. A polygon that is just its box needs no edges: it goes to a coarse grid, and comparisons decide. A point
goes to one cell of each grid in use, of which there are a few dozen at most. The cells of wide polygons are salted, as
many points may lie in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.functions import geometry as G


def box_overlaps(bbox: Column, x1: float, y1: float, x2: float, y2: float) -> Column:
    """Comparisons of plain numbers, which Parquet statistics can prune."""
    return (bbox["xmin"] <= x2) & (bbox["xmax"] >= x1) & (bbox["ymin"] <= y2) & (bbox["ymax"] >= y1)


def within_envelope(df: DataFrame, x1: float, y1: float, x2: float, y2: float, geometry: str = "geometry", bbox: str = "bbox") -> DataFrame:
    """Rows whose geometry shares a point with the envelope: the box first, then the geometry."""
    exact = G.st_intersects_box(F.col(geometry), *[F.lit(float(v)) for v in (x1, y1, x2, y2)])
    return df.filter(box_overlaps(F.col(bbox), x1, y1, x2, y2)).filter(exact)


def near_point(df: DataFrame, x: float, y: float, d: float, geometry: str = "geometry", bbox: str = "bbox") -> DataFrame:
    """Rows within a planar distance of a point."""
    return df.filter(box_overlaps(F.col(bbox), x - d, y - d, x + d, y + d)).filter(G.st_distance(F.col(geometry), F.lit(float(x)), F.lit(float(y))) <= d)


def near_point_xy(df: DataFrame, x: float, y: float, d: float, px: str = "x", py: str = "y") -> DataFrame:
    """The same for points in two columns, without a function call."""
    box = F.col(px).between(x - d, x + d) & F.col(py).between(y - d, y + d)
    return df.filter(box).filter(F.hypot(F.col(px) - x, F.col(py) - y) <= d)


def extent(df: DataFrame, by: list[str], box: str = "extent") -> DataFrame:
    """The extent of each group; with no group, of all rows."""
    b = F.col(box)
    return df.groupBy(*by).agg(F.struct(F.min(b["xmin"]).alias("xmin"), F.min(b["ymin"]).alias("ymin"), F.max(b["xmax"]).alias("xmax"), F.max(b["ymax"]).alias("ymax")).alias("whole"))


def with_hilbert_key(df: DataFrame, by: list[str], box: str = "extent", out: str = "hilbert") -> DataFrame:
    """Adds the place of each box's centre on the Hilbert curve over its group's extent."""
    whole = extent(df, by, box)
    joined = df.join(whole, by) if by else df.crossJoin(F.broadcast(whole))  # one row
    b, w = F.col(box), F.col("whole")
    return joined.withColumn(out, G.hilbert_key((b["xmin"] + b["xmax"]) / 2, (b["ymin"] + b["ymax"]) / 2, w["xmin"], w["ymin"], w["xmax"], w["ymax"])).drop("whole")


#: Grid levels: cells of 2**level units; a small polygon covers 3 x 3 cells of its level at most.
_LEAST, _MOST = -40, 20

#: Units from which a polygon is wide; levels by which its cells are finer, and by which a box's are; salts of a cell of it.
WIDE, FINER, BOX_FINER, SALTS = 0.5, 4, 1, 8


def _level(width: Column) -> Column:
    return F.greatest(F.lit(_LEAST), F.least(F.lit(_MOST), F.ceil(F.log2(F.greatest(width, F.lit(1e-11)))))).cast("int")


def _cell(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(2.0), level)).cast("long")


def join_containing(polygons: DataFrame, points: DataFrame, geometry: str = "geometry", box: str = "extent", x: str = "x", y: str = "y") -> DataFrame:
    """Pairs of polygon and point where the polygon contains the point; columns of both sides, less the geometry.

    polygons: with WKB and a double box. A point lies in one cell of a grid, so no pair comes twice. Parts of a
    multipolygon don't overlap. A geometry that is null, has no box or a coordinate that is no finite number contains
    nothing.
    """
    b = F.col(box)
    width = F.greatest(b["xmax"] - b["xmin"], b["ymax"] - b["ymin"])
    known = F.col(geometry).isNotNull() & b["xmin"].isNotNull() & b["ymin"].isNotNull() & b["xmax"].isNotNull() & b["ymax"].isNotNull()
    p = polygons.filter(known).withColumns({"__wide": width >= WIDE, "__box": G.is_box(geometry, *[b[c] for c in ("xmin", "ymin", "xmax", "ymax")])})
    p = p.withColumn("__level", _level(width) - F.when(F.col("__wide"), F.when(F.col("__box"), BOX_FINER).otherwise(FINER)).otherwise(0))
    boxes, others = p.filter("__box").drop(geometry, "__box"), p.filter("not __box").drop("__box")

    step = F.pow(F.lit(2.0), F.col("__level"))
    for cell, low, high in (("__cx", "xmin", "xmax"), ("__cy", "ymin", "ymax")):
        boxes = boxes.withColumn(cell, F.explode(F.sequence(F.floor(b[low] / step), F.floor(b[high] / step))))
    in_box = (F.col(x) > b["xmin"]) & (F.col(x) < b["xmax"]) & (F.col(y) > b["ymin"]) & (F.col(y) < b["ymax"])
    settled = _join_cells(boxes, points, p.filter("__box"), x, y).filter(in_box)

    others = G.with_cells(others, geometry, "__level", "__wide", ["__cx", "__cy", "__edges"])
    in_box = (F.col(x) >= b["xmin"]) & (F.col(x) <= b["xmax"]) & (F.col(y) >= b["ymin"]) & (F.col(y) <= b["ymax"])
    tested = _join_cells(others, points, p.filter("not __box"), x, y).filter(in_box).filter(G.st_within_edges(F.col("__edges"), F.col(x), F.col(y)))
    return settled.unionByName(tested.drop("__edges"))


def _join_cells(cells: DataFrame, points: DataFrame, polygons: DataFrame, x: str, y: str) -> DataFrame:
    """Pairs of a polygon and the points in its cells. polygons: tell which grids are in use. A size estimate doesn't
    know how many cells a polygon has, so neither side is ever broadcast."""
    salts = F.when(F.col("__wide"), SALTS).otherwise(1)
    p = cells.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    grids = polygons.select("__wide", "__level").distinct()  # twice _MOST - _LEAST + 1 rows at most
    q = points.crossJoin(F.broadcast(grids)).withColumn("__cx", _cell(F.col(x), F.col("__level"))).withColumn("__cy", _cell(F.col(y), F.col("__level")))
    plain = [f.name for f in points.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    q = q.withColumn("__salt", F.pmod(F.xxhash64(*plain), salts).cast("int"))
    by = ["__wide", "__level", "__cx", "__cy", "__salt"]
    return p.hint("merge").join(q, by).drop(*by)


def clip_to_regions(points: DataFrame, regions: DataFrame, geometry: str = "region_geometry", box: str = "region_extent", x: str = "x", y: str = "y") -> DataFrame:
    """Each point with each region that contains it."""
    return join_containing(regions, points, geometry, box, x, y)
