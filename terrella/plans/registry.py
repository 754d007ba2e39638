"""Queries by name, and the SQL that gives the same rows over the same tables.

The tables hold no geometry, so features, points, regions, keys and snapshots are derived from their columns; the
SQL says how. Every query reads its tables whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.functions import geometry as G
from terrella.functions import tags as T
from terrella.functions import text as X
from terrella.operators import listing, manifests, snapshots, spatial, themes
from terrella.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- Derived inputs -------------------------------------------------------------------------------------------------


def building_features(spark: SparkSession, sf: str) -> DataFrame:
    """part as buildings: (p_partkey, tags)."""
    tags = F.create_map(F.lit("building"), F.lower("p_type"), F.lit("name"), F.col("p_name"), F.lit("building:levels"), F.col("p_size").cast("string"), F.lit("height"), F.col("p_retailprice").cast("string"))
    return table(spark, sf, "part").select("p_partkey", tags.alias("tags"))


def points(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings as points: (vec_id, label, x, y)."""
    x, y = (F.element_at("embedding", k).cast("double") * w for k, w in ((1, 180), (2, 90)))
    return table(spark, sf, "embeddings").select("vec_id", "label", x.alias("x"), y.alias("y"))


def with_extent(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Points with their box."""
    return df.withColumn("extent", F.struct(F.col(x).alias("xmin"), F.col(y).alias("ymin"), F.col(x).alias("xmax"), F.col(y).alias("ymax")))


def boxes(spark: SparkSession, sf: str, half: float, where: str) -> DataFrame:
    """Points as squares around them: (box_id, extent, geometry)."""
    b = points(spark, sf).filter(where).select(F.col("vec_id").alias("box_id"), F.struct((F.col("x") - half).alias("xmin"), (F.col("y") - half).alias("ymin"), (F.col("x") + half).alias("xmax"), (F.col("y") + half).alias("ymax")).alias("extent"))
    return b.withColumn("geometry", G.wkb_box("extent.xmin", "extent.ymin", "extent.xmax", "extent.ymax"))


def region_names(spark: SparkSession, sf: str) -> DataFrame:
    """nation and region as admin regions: (iso, name)."""
    iso = F.concat(F.upper(F.substring("r_name", 1, 2)), F.lit("-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(iso.alias("iso"), F.col("n_name").alias("name"))


def elements(spark: SparkSession, sf: str) -> DataFrame:
    """part as tagged elements: (kind, tags)."""
    n = F.col("p_partkey")
    kind = F.element_at(F.array(F.lit("node"), F.lit("way"), F.lit("relation")), (n % 3 + 1).cast("int"))
    pairs = [("building", F.when(n % 4 == 0, "yes")), ("highway", F.when(n % 5 == 0, "bus_stop").when(n % 5 == 1, "primary")), ("natural", F.when(n % 7 == 0, "water").when(n % 7 == 1, "wood")), ("railway", F.when(n % 6 == 0, "station").when(n % 6 == 1, "rail")), ("boundary", F.when(n % 11 == 0, "administrative").when(n % 11 == 1, "maritime")), ("shop", F.when(n % 13 == 0, "books"))]
    tags = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in pairs]), lambda e: e["v"].isNotNull()))
    return table(spark, sf, "part").select("p_partkey", kind.alias("kind"), tags.alias("tags"))


def objects(spark: SparkSession, sf: str) -> DataFrame:
    """pages as stored objects: (key, size, uploaded, etag)."""
    p = table(spark, sf, "pages")
    key = F.regexp_replace("url", "^https?://", "")
    return p.select(F.concat(key, F.lit("/"), F.col("page_id").cast("string")).alias("key"), F.length("html").cast("long").alias("size"), F.timestamp_seconds(F.col("page_id") + 1_600_000_000).alias("uploaded"), F.concat(F.lit('"'), F.md5(F.col("page_id").cast("string")), F.lit('"')).alias("etag"))


_PTS = "SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) * 180 AS x, CAST(embedding[2] AS DOUBLE) * 90 AS y FROM embeddings"
_REGIONS = "SELECT upper(substr(r_name, 1, 2)) || '-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey"
_OBJECTS = "SELECT regexp_replace(url, '^https?://', '') || '/' || CAST(page_id AS VARCHAR) AS key, CAST(length(html) AS BIGINT) AS size, '\"' || md5(CAST(page_id AS VARCHAR)) || '\"' AS etag, page_id FROM pages"
_ELEMENTS = """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'node' WHEN 1 THEN 'way' ELSE 'relation' END AS kind,
 CASE WHEN p_partkey % 4 = 0 THEN 'yes' END AS building, CASE p_partkey % 5 WHEN 0 THEN 'bus_stop' WHEN 1 THEN 'primary' END AS highway,
 CASE p_partkey % 7 WHEN 0 THEN 'water' WHEN 1 THEN 'wood' END AS "natural", CASE p_partkey % 6 WHEN 0 THEN 'station' WHEN 1 THEN 'rail' END AS railway,
 CASE p_partkey % 11 WHEN 0 THEN 'administrative' WHEN 1 THEN 'maritime' END AS boundary, CASE WHEN p_partkey % 13 = 0 THEN 'books' END AS shop FROM part"""


# ---- Themes, tags and projection ------------------------------------------------------------------------------------


@query("g2_building_top5", "SELECT lower(p_type) AS building, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, building LIMIT 5")
def g2_building_top5(spark, sf):
    typed = building_features(spark, sf).select(*themes.THEMES["buildings"].typed())
    return typed.groupBy("building").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "building").limit(5)


@query(
    "p1_theme_buildings_typed",
    """SELECT p_partkey, lower(p_type) AS building, p_name AS name, p_size AS levels, p_retailprice AS height, CAST(NULL AS VARCHAR) AS addr_street,
 CAST(NULL AS VARCHAR) AS addr_housenumber, CAST(NULL AS VARCHAR) AS addr_postcode, CAST(NULL AS VARCHAR) AS addr_city, CAST(NULL AS VARCHAR) AS operator, CAST(NULL AS VARCHAR) AS start_date FROM part""",
)
def p1_theme_buildings_typed(spark, sf):
    return building_features(spark, sf).select("p_partkey", *themes.THEMES["buildings"].typed())


#: Strings whose reading as numbers differs from engine to engine.
NUMBERS = ["3", "3.5", "2.5", "-3.5", " 3 ", "3;4", "1e3", "", "+5", "0x10", "3,000", "12 m", "inf", "Infinity", "99999999999", "1_000", ".5", "5.", "1e400", "3f", "3d", "true", "-0.4", "1e-1", "_1", "1_", "1__0", "-0x10", "0X1F", "2147483647.4", "2147483647.5", "1e40", ".", "-", "1.5e1", " +7.5", "1e", "12abc"]


@query(
    "p5_try_cast_matrix",
    "WITH s AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in NUMBERS) + "]) AS v), w AS (SELECT v, p_partkey, v || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE ' ' END AS t FROM s, part) "
    "SELECT p_partkey, v, TRY_CAST(t AS INTEGER) AS i, CASE WHEN isinf(TRY_CAST(t AS DOUBLE)) THEN 'inf' ELSE CAST(round(TRY_CAST(t AS DOUBLE), 6) AS VARCHAR) END IS NOT NULL AS is_number, CASE WHEN abs(TRY_CAST(t AS DOUBLE)) < 1e15 THEN round(TRY_CAST(t AS DOUBLE), 6) END AS d FROM w",
)
def p5_try_cast_matrix(spark, sf):
    v = F.explode(F.array(*[F.lit(x) for x in NUMBERS])).alias("v")
    rows = table(spark, sf, "part").select("p_partkey", v).withColumn("t", F.concat("v", F.when(F.col("p_partkey") % 2 == 0, "").otherwise(" ")))
    d = T.to_double(F.col("t"))
    return rows.select("p_partkey", "v", T.to_int(F.col("t")).alias("i"), d.isNotNull().alias("is_number"), F.when(F.abs(d) < 1e15, F.round(d, 6)).alias("d"))


@query("f2_props_to_map", "SELECT event_id, json_extract_string(props, '$.k') AS k, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int FROM events")
def f2_props_to_map(spark, sf):
    tags = table(spark, sf, "events").select("event_id", T.tag_map("props").alias("tags"))
    return tags.select("event_id", T.tag("tags", "k").alias("k"), T.tag("tags", "k", "int").alias("k_int"))


@query("p8_postfilter_coalesce", f"SELECT p_partkey, \"natural\" FROM ({_ELEMENTS}) WHERE coalesce(\"natural\", '') <> 'water'")
def p8_postfilter_coalesce(spark, sf):
    e = elements(spark, sf)
    return e.filter(themes.post_filter("natural_areas", F.col("tags"))).select("p_partkey", T.tag("tags", "natural").alias("natural"))


def _filter_sql(text: str) -> str:
    known = ("building", "highway", "natural", "railway", "boundary", "shop")
    parts = []
    for kinds, key, values in themes.parse_filter(text):
        if key in known:
            held = f"\"{key}\" IN ({', '.join(repr(v) for v in values)})" if values else f'"{key}" IS NOT NULL'
            parts.append(f"(kind IN ({', '.join(repr(k) for k in kinds)}) AND {held})")
    return "coalesce(" + (" OR ".join(parts) or "false") + ", false)"


@query(
    "p9_tag_filter_compile",
    " UNION ALL ".join(f"SELECT '{t.name}' AS theme, count(*) AS n FROM ({_ELEMENTS}) WHERE {_filter_sql(t.filter)}" + (" AND coalesce(\"natural\", '') <> 'water'" if t.name == "natural_areas" else "") for t in themes.THEMES.values()),
)
def p9_tag_filter_compile(spark, sf):
    """All themes in one pass over the elements."""
    e, tags = elements(spark, sf), F.col("tags")
    sums = [F.count(F.when(themes.tag_filter(t.filter, F.col("kind"), tags) & themes.post_filter(t.name, tags), 1)).alias(t.name) for t in themes.THEMES.values()]
    return e.agg(*sums).unpivot([], [t for t in themes.THEMES], "theme", "n")


@query("p10_geometry_filter", "SELECT theme, n FROM (SELECT 'roads' AS theme, count(*) FILTER (WHERE p_partkey % 3 = 1) AS n FROM part UNION ALL SELECT 'power', count(*) FROM part UNION ALL SELECT 'places', count(*) FILTER (WHERE p_partkey % 3 = 0) FROM part)")
def p10_geometry_filter(spark, sf):
    kind = F.element_at(F.array(F.lit("Point"), F.lit("MultiLineString"), F.lit("Polygon")), (F.col("p_partkey") % 3 + 1).cast("int"))
    rows = table(spark, sf, "part").select(kind.alias("kind"))
    return rows.agg(*[F.count(F.when(themes.geometry_filter(themes.THEMES[t], F.col("kind")), 1)).alias(t) for t in ("roads", "power", "places")]).unpivot([], ["roads", "power", "places"], "theme", "n")


@query("p2_constant_columns", "SELECT p_partkey, 'US' AS country, 'New York' AS state, 'US-NY' AS state_iso FROM part WHERE p_size > 25")
def p2_constant_columns(spark, sf):
    return spark.sql("SELECT p_partkey, :country AS country, :state AS state, :iso AS state_iso FROM {part} WHERE p_size > 25", args={"country": "US", "state": "New York", "iso": "US-NY"}, part=table(spark, sf, "part"))


@query("p14_subset_in_catalogue_order", "SELECT * FROM (VALUES (0, 'buildings'), (1, 'roads'), (2, 'power')) t(position, theme)")
def p14_subset_in_catalogue_order(spark, sf):
    chosen = themes.choose(["power", "buildings", "roads"], list(themes.THEMES), "themes")
    return spark.createDataFrame(list(enumerate(chosen)), "position int, theme string")


# ---- Boxes, distances, spatial joins --------------------------------------------------------------------------------


@query(
    "f5_bbox_outward",
    f"SELECT vec_id, CAST(x - abs(x) * 1e-6 - 1e-9 AS FLOAT) AS xmin, CAST(y - abs(y) * 1e-6 - 1e-9 AS FLOAT) AS ymin, CAST(x + abs(x) * 1e-6 + 1e-9 AS FLOAT) AS xmax, CAST(y + abs(y) * 1e-6 + 1e-9 AS FLOAT) AS ymax FROM ({_PTS})",
)
def f5_bbox_outward(spark, sf):
    return with_extent(points(spark, sf)).select("vec_id", G.outward_box(F.col("extent")).alias("bbox")).select("vec_id", "bbox.*")


@query("g3_extent_by_label", f"SELECT label, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM ({_PTS}) GROUP BY label")
def g3_extent_by_label(spark, sf):
    return spatial.extent(with_extent(points(spark, sf)), ["label"]).select("label", "whole.*")


@query("j1_relative_to_extent", f"WITH p AS ({_PTS}), e AS (SELECT min(x) AS x1, max(x) AS x2 FROM p) SELECT vec_id, round((x - x1) / (x2 - x1), 9) AS u FROM p, e")
def j1_relative_to_extent(spark, sf):
    p = with_extent(points(spark, sf))
    return p.crossJoin(F.broadcast(spatial.extent(p, []))).select("vec_id", F.round((F.col("x") - F.col("whole.xmin")) / (F.col("whole.xmax") - F.col("whole.xmin")), 9).alias("u"))


@query("p12_bbox_filter_count", f"SELECT count(*) AS n FROM ({_PTS}) WHERE x <= 20 AND x >= -20 AND y <= 10 AND y >= -10")
def p12_bbox_filter_count(spark, sf):
    return with_extent(points(spark, sf)).filter(spatial.box_overlaps(F.col("extent"), -20, -10, 20, 10)).agg(F.count("*").alias("n"))


@query("f13_intersects_envelope", f"SELECT vec_id FROM ({_PTS}) WHERE x + 0.5 >= -20 AND x - 0.5 <= 20 AND y + 0.5 >= -10 AND y - 0.5 <= 10")
def f13_intersects_envelope(spark, sf):
    b = boxes(spark, sf, 0.5, "true")
    return spatial.within_envelope(b, -20, -10, 20, 10, bbox="extent").select(F.col("box_id").alias("vec_id"))


@query("p11_tag_num_bbox", f"SELECT count(*) AS n FROM ({_PTS}) JOIN part ON vec_id = p_partkey WHERE p_size > 30 AND label = 3 AND x BETWEEN -60 AND 60 AND y BETWEEN -30 AND 30")
def p11_tag_num_bbox(spark, sf):
    typed = building_features(spark, sf).select("p_partkey", *themes.THEMES["buildings"].typed())
    inside = with_extent(points(spark, sf)).filter(spatial.box_overlaps(F.col("extent"), -60, -30, 60, 30) & (F.col("label") == 3))
    return inside.join(typed.filter("levels > 30"), F.col("vec_id") == F.col("p_partkey")).agg(F.count("*").alias("n"))


@query("j2_contains_grid_join", f"WITH p AS ({_PTS}) SELECT b.vec_id AS box_id, p.vec_id AS point_id FROM p b JOIN p ON p.x > b.x - 3.0 AND p.x < b.x + 3.0 AND p.y > b.y - 3.0 AND p.y < b.y + 3.0")
def j2_contains_grid_join(spark, sf):
    p = points(spark, sf).select(F.col("vec_id").alias("point_id"), "x", "y")
    return spatial.join_containing(boxes(spark, sf, 3.0, "true"), p).select("box_id", "point_id")


@query("j3_dwithin", f"SELECT vec_id FROM ({_PTS}) WHERE sqrt((x - 5) * (x - 5) + (y - 2) * (y - 2)) <= 15")
def j3_dwithin(spark, sf):
    return spatial.near_point_xy(points(spark, sf), 5, 2, 15).select("vec_id")


@query("f16_dwithin_geometry", f"SELECT vec_id FROM ({_PTS}) WHERE sqrt(power(greatest(abs(x - 5) - 0.25, 0), 2) + power(greatest(abs(y - 2) - 0.25, 0), 2)) <= 10")
def f16_dwithin_geometry(spark, sf):
    return spatial.near_point(boxes(spark, sf, 0.25, "true"), 5, 2, 10, bbox="extent").select(F.col("box_id").alias("vec_id"))


_CELLS = "SELECT iso, -180 + 72.0 * (k % 5) AS x1, -90 + 36.0 * (k // 5) AS y1 FROM (SELECT iso, row_number() OVER (ORDER BY iso) - 1 AS k FROM ({regions}))".format(regions=_REGIONS)


@query("j4_region_clip", f"SELECT iso, vec_id FROM ({_PTS}) p JOIN ({_CELLS}) r ON x > x1 AND x < x1 + 72 AND y > y1 AND y < y1 + 36")
def j4_region_clip(spark, sf):
    """Points to regions laid out as a 5 by 5 grid of rectangles."""
    return spatial.clip_to_regions(points(spark, sf), laid_out_regions(spark, sf)).select("iso", "vec_id")


def laid_out_regions(spark, sf) -> DataFrame:
    from pyspark.sql import Window

    k = F.row_number().over(Window.orderBy("iso")) - 1  # 25 regions
    r = region_names(spark, sf).withColumn("k", k)
    x1, y1 = -180 + 72.0 * (F.col("k") % 5), -90 + 36.0 * F.floor(F.col("k") / 5)
    r = r.select("iso", F.struct(x1.alias("xmin"), y1.alias("ymin"), (x1 + 72).alias("xmax"), (y1 + 36).alias("ymax")).alias("region_extent"))
    return r.withColumn("region_geometry", G.wkb_box("region_extent.xmin", "region_extent.ymin", "region_extent.xmax", "region_extent.ymax"))


def _hilbert_sql(bits: int = 16) -> str:
    """One step of the curve for each bit, from the highest: the quadrant's number, then the turn."""
    cell = lambda v, a, b: f"CAST(trunc(CASE WHEN {b} > {a} THEN ({v} - {a}) / ({b} - {a}) * 65535 ELSE 0 END) AS BIGINT)"
    sql = f"SELECT vec_id, label, {cell('x', 'x1', 'x2')} AS x, {cell('y', 'y1', 'y2')} AS y, CAST(0 AS BIGINT) AS h FROM ({_PTS}) JOIN (SELECT label AS l, min(x) AS x1, max(x) AS x2, min(y) AS y1, max(y) AS y2 FROM ({_PTS}) GROUP BY 1) ON label = l"
    for k in range(bits - 1, -1, -1):
        rx, ry, top = f"((x >> {k}) & 1)", f"((y >> {k}) & 1)", (1 << bits) - 1
        turned = lambda v, other: f"CASE WHEN {ry} = 1 THEN {v} WHEN {rx} = 1 THEN {top} - {other} ELSE {other} END"
        sql = f"SELECT vec_id, label, {turned('x', 'y')} AS x, {turned('y', 'x')} AS y, h + {1 << 2 * k} * xor(3 * {rx}, {ry}) AS h FROM ({sql})"
    return f"SELECT vec_id, label, h AS hilbert FROM ({sql})"


@query("o1_hilbert_key", _hilbert_sql())
def o1_hilbert_key(spark, sf):
    return spatial.with_hilbert_key(with_extent(points(spark, sf)), ["label"]).select("vec_id", "label", "hilbert")


@query("f8_geojson_bounds", f"SELECT vec_id, x AS xmin, y AS ymin, x + 1 AS xmax, y + 2 AS ymax FROM ({_PTS})")
def f8_geojson_bounds(spark, sf):
    """A GeoJSON line is written, parsed to WKB and measured."""
    text = F.to_json(F.struct(F.lit("LineString").alias("type"), F.array(F.array("x", "y"), F.array(F.col("x") + 1, F.col("y") + 2)).alias("coordinates")))
    return points(spark, sf).select("vec_id", G.extent_of(G.wkb_from_geojson(text)).alias("e")).select("vec_id", "e.*")


# ---- Scans, sets, joins ---------------------------------------------------------------------------------------------


@query("s6_multi_scan_union", "SELECT l_returnflag, count(*) AS n FROM (SELECT l_returnflag FROM lineitem UNION ALL SELECT l_returnflag FROM lineitem) GROUP BY 1")
def s6_multi_scan_union(spark, sf):
    path = f"{sf}/lineitem.parquet"
    return spark.read.parquet(path, path).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("x1_union_by_schema", "SELECT kind, count(*) AS n FROM (SELECT c_custkey AS k, 'c' AS kind FROM customer UNION ALL SELECT s_suppkey, 's' FROM supplier) GROUP BY 1")
def x1_union_by_schema(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lit("c").alias("kind"))
    s = table(spark, sf, "supplier").select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("k"))
    return c.unionByName(s).groupBy("kind").agg(F.count("*").alias("n"))


@query("x2_set_difference", "SELECT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def x2_set_difference(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).subtract(table(spark, sf, "supplier").filter("s_acctbal > 5000").select("s_nationkey"))


@query("x3_set_intersection", "SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def x3_set_intersection(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, sf, "supplier").filter("s_acctbal > 5000").select("s_nationkey"))


@query("j5_semi", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def j5_semi(spark, sf):
    return table(spark, sf, "orders").join(table(spark, sf, "lineitem").filter("l_quantity > 45"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("j6_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01')")
def j6_anti(spark, sf):
    late = table(spark, sf, "orders").filter("o_orderdate >= TIMESTAMP_NTZ '2000-06-01 00:00:00'")
    return table(spark, sf, "customer").join(late, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j8_count_mismatch", "SELECT o_orderkey, claimed, coalesce(actual, 0) AS actual FROM (SELECT o_orderkey, 1 + o_orderkey % 7 AS claimed FROM orders) LEFT JOIN (SELECT l_orderkey, count(*) AS actual FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE actual IS NULL OR actual <> claimed")
def j8_count_mismatch(spark, sf):
    claims = table(spark, sf, "orders").select("o_orderkey", (1 + F.col("o_orderkey") % 7).alias("claimed"))
    actual = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("actual"))
    return claims.join(actual, "o_orderkey", "left").filter("actual is null or actual <> claimed").select("o_orderkey", "claimed", F.coalesce("actual", F.lit(0)).alias("actual"))


@query("j9_j10_set_checks", "WITH w AS (SELECT list_sort(list(DISTINCT event_type)) AS want FROM events) SELECT user_id, list_sort(list(DISTINCT event_type)) = want AS same, len(list(DISTINCT event_type) FILTER (WHERE event_type IN (SELECT event_type FROM events WHERE user_id % 2 = 0))) = count(DISTINCT event_type) AS subset FROM events, w GROUP BY user_id, want")
def j9_j10_set_checks(spark, sf):
    e = table(spark, sf, "events")
    want = e.agg(F.collect_set("event_type").alias("want"), F.collect_set(F.when(F.col("user_id") % 2 == 0, F.col("event_type"))).alias("even"))  # as many values as kinds of event
    got = e.groupBy("user_id").agg(F.collect_set("event_type").alias("got")).crossJoin(F.broadcast(want))
    return got.select("user_id", manifests.same_set(F.col("got"), F.col("want")).alias("same"), manifests.is_subset(F.col("got"), F.col("even")).alias("subset"))


# ---- Counts, manifests, checks --------------------------------------------------------------------------------------


def theme_counts(spark, sf) -> DataFrame:
    """Counts by region and theme from customers: segment as theme, balance below 0 as a failed build."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    n = F.when(F.min("c_acctbal") < -990, -1).otherwise(F.count("*"))
    return c.groupBy(F.concat(F.lit("US-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("state_iso"), F.col("n_name").alias("state_name"), F.lower("c_mktsegment").alias("theme")).agg(n.cast("long").alias("n"))


_COUNTS = "SELECT 'US-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_iso, n_name AS state_name, lower(c_mktsegment) AS theme, CASE WHEN min(c_acctbal) < -990 THEN -1 ELSE count(*) END AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3"


@query("g4_total_features", f"SELECT state_iso, CAST(sum(CASE WHEN n > 0 THEN n ELSE 0 END) AS BIGINT) AS total_features FROM ({_COUNTS}) GROUP BY 1")
def g4_total_features(spark, sf):
    return manifests.manifests(theme_counts(spark, sf), "x.pbf").select("state_iso", "total_features")


@query(
    "g5_manifest_counts",
    f"""SELECT state_iso, '{{"schema_version":"0.2.0","country":"US","state_iso":"' || state_iso || '","state_name":"' || state_name || '","source_pbf":"x.pbf","duration_s":0.0,"total_features":'
 || CAST(sum(CASE WHEN n > 0 THEN n ELSE 0 END) AS VARCHAR) || ',"themes":{{' || string_agg('"' || theme || '":' || CAST(n AS VARCHAR), ',' ORDER BY theme) || '}}}}' AS manifest FROM ({_COUNTS}) GROUP BY state_iso, state_name""",
)
def g5_manifest_counts(spark, sf):
    return manifests.manifests(theme_counts(spark, sf), "x.pbf").select("state_iso", "manifest")


@query("p15_positive_claims", f"SELECT state_iso, theme, n FROM ({_COUNTS}) WHERE n > 0")
def p15_positive_claims(spark, sf):
    return theme_counts(spark, sf).filter("n > 0").select("state_iso", "theme", "n")


@query("g11_pass_fail_totals", f"SELECT count(*) FILTER (WHERE n > 0) AS passed, count(*) FILTER (WHERE n <= 0) AS failed FROM ({_COUNTS})")
def g11_pass_fail_totals(spark, sf):
    return manifests.totals(theme_counts(spark, sf).select((F.col("n") > 0).alias("passed")))


@query("g1_filtered_count", "SELECT count(*) AS n FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'R'")
def g1_filtered_count(spark, sf):
    return table(spark, sf, "lineitem").filter("l_quantity > 30 and l_returnflag = 'R'").agg(F.count("*").alias("n"))


@query("f18_country_prefix", f"SELECT iso, name, split_part(iso, '-', 1) AS country FROM ({_REGIONS})")
def f18_country_prefix(spark, sf):
    return region_names(spark, sf).withColumn("country", X.iso_prefix(F.col("iso")))


@query("p16_expected_regions", f"SELECT DISTINCT iso FROM ({_REGIONS}) WHERE split_part(iso, '-', 1) IN ('AM', 'AS', 'EU') AND iso NOT IN ('AM-01', 'EU-07')")
def p16_expected_regions(spark, sf):
    return manifests.expected_regions(region_names(spark, sf), ("AM", "AS", "EU"), ("AM-01", "EU-07"))


@query("p20_header_policy", "SELECT o_orderpriority AS cache_control, contains(o_orderpriority, 'I') AND NOT contains(o_orderpriority, 'LOW') AS passed, count(*) AS n FROM orders GROUP BY 1, 2")
def p20_header_policy(spark, sf):
    h = table(spark, sf, "orders").select(F.col("o_orderkey").alias("object"), F.col("o_orderpriority").alias("cache_control"), F.lit("I").alias("want"), F.lit("LOW").alias("forbid"))
    return manifests.header_policy(h).groupBy("cache_control", "passed").agg(F.count("*").alias("n"))


# ---- Snapshots ------------------------------------------------------------------------------------------------------


def dated_objects(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/"), F.col("o_orderkey").cast("string")).alias("key"), F.col("o_custkey").alias("size"))


@query("g6_snapshot_rollup", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, strftime(o_orderdate, '%Y-%m-%d') || '/' AS path, count(*) AS objects, CAST(sum(o_custkey) AS BIGINT) AS bytes FROM orders GROUP BY 1, 2")
def g6_snapshot_rollup(spark, sf):
    return snapshots.rollup(dated_objects(spark, sf))


@query("o3_latest_snapshots", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) AS objects FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 10")
def o3_latest_snapshots(spark, sf):
    return snapshots.rollup(dated_objects(spark, sf)).orderBy(F.desc("date")).limit(10).select("date", "objects")


_NAMES = "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS name FROM orders"
_VERDICT = "CASE WHEN datediff('day', day, DATE '2001-07-20') <= 14 OR (month(day) = 12 AND day(day) = 31) OR (datediff('day', day, DATE '2001-07-20') <= 365 AND day(day) = 1) THEN 'keep' ELSE 'delete' END"


def dated_names(spark, sf) -> DataFrame:
    names = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("name")).distinct()
    return snapshots.retention(names, F.lit("2001-07-20").cast("date"))


@query("p19_retention", f"SELECT name, {_VERDICT} AS verdict FROM (SELECT name, CAST(name AS DATE) AS day FROM ({_NAMES}))")
def p19_retention(spark, sf):
    return dated_names(spark, sf).select("name", "verdict")


@query("g10_verdicts", f"SELECT {_VERDICT} AS verdict, count(*) AS n FROM (SELECT name, CAST(name AS DATE) AS day FROM ({_NAMES})) GROUP BY 1")
def g10_verdicts(spark, sf):
    return dated_names(spark, sf).groupBy("verdict").agg(F.count("*").alias("n"))


@query("p17_dated_names", "SELECT p_partkey, regexp_full_match(s, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS dated FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '2024-01-' || lpad(CAST(p_size AS VARCHAR), 2, '0') WHEN 1 THEN '2024-1-2' ELSE 'latest' END AS s FROM part)")
def p17_dated_names(spark, sf):
    n = F.col("p_partkey") % 3
    s = F.when(n == 0, F.concat(F.lit("2024-01-"), F.lpad(F.col("p_size").cast("string"), 2, "0"))).when(n == 1, "2024-1-2").otherwise("latest")
    return table(spark, sf, "part").select("p_partkey", X.is_dated(s).alias("dated"))


@query("g7_bytes_and_files", "SELECT CAST(sum(n_chars) AS BIGINT) AS bytes, count(*) FILTER (WHERE doc_id % 4 = 0) AS parquet_files FROM documents")
def g7_bytes_and_files(spark, sf):
    d = table(spark, sf, "documents").select(F.concat("source", F.when(F.col("doc_id") % 4 == 0, ".parquet").otherwise(".json")).alias("key"), "n_chars")
    return d.agg(F.sum("n_chars").alias("bytes"), F.count(F.when(F.col("key").endswith(".parquet"), 1)).alias("parquet_files"))


# ---- Listings -------------------------------------------------------------------------------------------------------


@query("c1_list_page", f"SELECT name, is_prefix FROM (SELECT key AS name, false AS is_prefix FROM ({_OBJECTS}) WHERE key NOT LIKE '%/%' UNION SELECT split_part(key, '/', 1) || '/', true FROM ({_OBJECTS}) WHERE key LIKE '%/%') WHERE name > 'm' ORDER BY name LIMIT 50")
def c1_list_page(spark, sf):
    return listing.list_objects(objects(spark, sf), delimiter="/", start_after="m", max_keys=50).rows.select("name", "is_prefix")


@query("o7_keyset_page", f"SELECT key AS name, size FROM ({_OBJECTS}) WHERE key > 'n' ORDER BY key LIMIT 100")
def o7_keyset_page(spark, sf):
    return listing.list_objects(objects(spark, sf), token="n", start_after="z", max_keys=100).rows.select("name", "size")


@query("g8_common_prefixes", f"SELECT DISTINCT split_part(key, '/', 1) || '/' AS prefix FROM ({_OBJECTS}) WHERE key LIKE '%/%'")
def g8_common_prefixes(spark, sf):
    return listing.common_prefixes(objects(spark, sf))


@query("g9_key_count", f"SELECT CAST(0 AS BIGINT) AS objects, CAST(count(*) AS BIGINT) AS prefixes, count(*) AS key_count FROM (SELECT DISTINCT split_part(key, '/', 1) FROM ({_OBJECTS}) ORDER BY 1 LIMIT 1000)")
def g9_key_count(spark, sf):
    page = listing.page_counts(listing.list_objects(objects(spark, sf), delimiter="/"))
    return page.select(*[F.col(c).cast("long").alias(c) for c in page.columns])


_FOLDERS = "SELECT DISTINCT CASE WHEN o_orderkey % 50 = 0 THEN 'latest/' WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || '/' ELSE lower(o_orderpriority) || '/' END AS name FROM orders"


@query("o5_listing_order", f"SELECT name, row_number() OVER (ORDER BY CASE WHEN name = 'latest/' THEN 0 WHEN dated THEN 1 ELSE 2 END, CASE WHEN dated THEN name END DESC NULLS LAST, name) AS position FROM (SELECT name, regexp_full_match(name, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}/') AS dated FROM ({_FOLDERS}))")
def o5_listing_order(spark, sf):
    from pyspark.sql import Window

    k = F.col("o_orderkey")
    name = F.when(k % 50 == 0, "latest/").when(k % 3 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/"))).otherwise(F.concat(F.lower("o_orderpriority"), F.lit("/")))
    names = table(spark, sf, "orders").select(name.alias("name")).distinct()  # as many as days
    return names.withColumn("position", F.row_number().over(Window.orderBy(*listing.folder_order(F.col("name")))))


@query("o8_page_walk", f"SELECT name FROM (SELECT DISTINCT split_part(key, '/', 1) || '/' AS name FROM ({_OBJECTS})) ORDER BY name LIMIT 20")
def o8_page_walk(spark, sf):
    return listing.walk(objects(spark, sf), page=10, pages=2)[0].select("name")


@query("p18_prefix_filter", f"SELECT key, substr(key, 3) AS rest FROM ({_OBJECTS}) WHERE starts_with(key, 'm.') AND key <> 'm.'")
def p18_prefix_filter(spark, sf):
    return listing.under(objects(spark, sf), "m.").filter("key <> 'm.'").select("key", "rest")


@query(
    "c2_read_status",
    f"""SELECT key, page_id % 5 AS kind, CASE page_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 206 WHEN 2 THEN 206 WHEN 3 THEN 304 ELSE 416 END AS status,
 CASE page_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN size - least(7, size) END AS "offset", CASE page_id % 5 WHEN 0 THEN size WHEN 1 THEN least(20, size - 10) WHEN 2 THEN least(7, size) END AS length FROM ({_OBJECTS})""",
)
def c2_read_status(spark, sf):
    kind = F.col("page_id") % 5
    keyed = table(spark, sf, "pages").select("page_id", F.concat(F.regexp_replace("url", "^https?://", ""), F.lit("/"), F.col("page_id").cast("string")).alias("key"))
    asked = keyed.select("key", F.when(kind == 0, "bytes=-").when(kind == 1, "bytes=10-29").when(kind == 2, "bytes=-7").when(kind == 4, "bytes=9-5").alias("range"), F.when(kind == 3, F.concat(F.lit('"'), F.md5(F.col("page_id").cast("string")), F.lit('"'))).alias("if_none_match"))
    got = listing.read_status(objects(spark, sf), asked)
    return got.join(keyed, "key").select("key", kind.alias("kind"), "status", "offset", "length")


# ---- Text functions -------------------------------------------------------------------------------------------------


@query(
    "f20_parse_size",
    "SELECT doc_id, CAST(trunc(n_chars / 8 * CASE doc_id % 6 WHEN 0 THEN 1024 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 1 WHEN 4 THEN 1000000 ELSE 0 END) AS BIGINT) AS size FROM documents",
)
def f20_parse_size(spark, sf):
    unit = F.element_at(F.array(*[F.lit(u) for u in ("KiB", "B", "kB", "iB", "MB", "junk")]), (F.col("doc_id") % 6 + 1).cast("int"))
    text = F.concat((F.col("n_chars") / 8).cast("decimal(20,3)").cast("string"), F.lit(" "), unit)
    return table(spark, sf, "documents").select("doc_id", X.parse_size(text).alias("size"))


@query("f21_parse_progress", "SELECT doc_id, n_chars * 1024 AS done, n_chars * 1048576 AS total FROM documents")
def f21_parse_progress(spark, sf):
    n = F.col("n_chars").cast("string")
    return table(spark, sf, "documents").select("doc_id", X.parse_progress(F.concat(F.lit("at "), n, F.lit(" KiB / "), n, F.lit(" MiB, 3%"))).alias("p")).select("doc_id", "p.*")


@query("f22_format_bytes", "SELECT doc_id, CASE WHEN b < 1024 THEN CAST(b AS VARCHAR) || ' B' WHEN b < 1048576 THEN printf('%.1f KiB', round(b / 1024.0::DOUBLE, 1)) WHEN b < 1073741824 THEN printf('%.1f MiB', round(b / 1048576.0::DOUBLE, 1)) ELSE printf('%.2f GiB', round(b / 1073741824.0::DOUBLE, 2)) END AS shown FROM (SELECT doc_id, n_chars * CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END AS b FROM documents)")
def f22_format_bytes(spark, sf):
    size = F.col("n_chars") * F.when(F.col("doc_id") % 3 == 0, 1).when(F.col("doc_id") % 3 == 1, 1000).otherwise(1_000_000)
    return table(spark, sf, "documents").select("doc_id", X.format_bytes(size).alias("shown"))


@query("f23_ts_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%SZ') AS shown FROM orders")
def f23_ts_format(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.listed_time(F.col("o_orderdate")).alias("shown"))


@query("f25_date_parts", "SELECT o_orderkey, datediff('day', CAST(o_orderdate AS DATE), DATE '2001-07-20') AS age, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders")
def f25_date_parts(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", F.datediff(F.lit("2001-07-20").cast("date"), d.cast("date")).cast("long").alias("age"), F.month(d).cast("long").alias("month"), F.dayofmonth(d).cast("long").alias("day"))


def _escaped(apostrophe: str) -> str:
    return f"replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '{apostrophe}')"


@query("f26_xml_escape", f"SELECT page_id, md5({_escaped('&apos;')}) AS digest FROM pages")
def f26_xml_escape(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(X.escape_xml(F.col("html"))).alias("digest"))


@query("f27_html_escape", f"SELECT page_id, md5({_escaped('&#39;')}) AS digest FROM pages")
def f27_html_escape(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(X.escape_html(F.col("html"))).alias("digest"))


@query("f28_url_codec", "SELECT page_id, replace(replace(replace(replace(replace(url_encode(url || ' +a'), '%21', '!'), '%7E', '~'), '%27', ''''), '%28', '('), '%29', ')') AS encoded, url || ' +a' AS decoded FROM pages")
def f28_url_codec(spark, sf):
    encoded = X.encode_component(F.concat("url", F.lit(" +a")))
    return table(spark, sf, "pages").select("page_id", encoded.alias("encoded"), X.decode_component(encoded).alias("decoded"))


@query(
    "f29_range_parse_bounds",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 5 WHEN 1 THEN 3 WHEN 2 THEN n_chars - least(doc_id, n_chars) END AS "offset",
 CASE doc_id % 4 WHEN 0 THEN doc_id - 4 WHEN 1 THEN n_chars - 3 WHEN 2 THEN least(doc_id, n_chars) END AS length FROM documents""",
)
def f29_range_parse_bounds(spark, sf):
    k, n = F.col("doc_id") % 4, F.col("doc_id").cast("string")
    header = F.when(k == 0, F.concat(F.lit("bytes=5-"), n)).when(k == 1, "bytes=3-").when(k == 2, F.concat(F.lit("bytes=-"), n)).otherwise("bytes=0-1,3-4")
    return table(spark, sf, "documents").select("doc_id", X.range_bounds(X.parse_range(header), F.col("n_chars")).alias("b")).select("doc_id", "b.*")


@query("f31_path_parts", f"SELECT key, CAST(len(p) AS INTEGER) AS depth, CASE WHEN len(p) <= 1 THEN '' ELSE array_to_string(p[1:len(p) - 1], '/') || '/' END AS parent FROM (SELECT key, list_filter(string_split(key, '/'), lambda x: x <> '') AS p FROM ({_OBJECTS}))")
def f31_path_parts(spark, sf):
    k = F.col("key")
    return objects(spark, sf).select("key", F.size(X.parts_of(k)).alias("depth"), X.parent_of(k).alias("parent"))


@query("f34_tenths", "SELECT p_partkey, CASE WHEN (p_partkey * 5) % 10 = 5 THEN (CASE WHEN ((p_partkey * 5) // 10) % 2 = 0 THEN (p_partkey * 5) // 10 ELSE (p_partkey * 5) // 10 + 1 END) / 10.0::DOUBLE ELSE (p_partkey * 5) // 10 / 10.0::DOUBLE END AS shown FROM part")
def f34_tenths(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.tenths((F.col("p_partkey") * 5).cast("decimal(18,2)") / F.lit(100).cast("decimal(3,0)")).cast("double").alias("shown"))


@query("f36_json_version", "SELECT event_id, json_extract_string('{\"version\":\"' || CASE WHEN event_id % 2 = 0 THEN '2.0.0' ELSE '1.1.0' END || '\"}', '$.version') = '2.0.0' AS current FROM events")
def f36_json_version(spark, sf):
    text = F.to_json(F.struct(F.when(F.col("event_id") % 2 == 0, "2.0.0").otherwise("1.1.0").alias("version")))
    return table(spark, sf, "events").select("event_id", (F.get_json_object(text, "$.version") == manifests.GEO_VERSION).alias("current"))


@query("u1_url_function", f"SELECT iso, '/data/country=' || split_part(iso, '-', 1) || '/state=' || iso || '/pois.parquet' AS path FROM ({_REGIONS})")
def u1_url_function(spark, sf):
    from terrella.sources.tables import register_url

    register_url(spark, "/data")
    return region_names(spark, sf).select("iso", F.expr("url(iso, 'pois')").alias("path"))


@query("f33_strip_dir", f"SELECT replace('state=' || iso, 'state=', '') AS iso FROM ({_REGIONS})")
def f33_strip_dir(spark, sf):
    return region_names(spark, sf).select(X.region_of_dir(F.concat(F.lit("state="), "iso")).alias("iso"))


# ---- Samples, slices, batches ---------------------------------------------------------------------------------------


@query("o9_seeded_sample", f"SELECT iso FROM ({_REGIONS}) ORDER BY md5(iso || ':42'), iso LIMIT 18")
def o9_seeded_sample(spark, sf):
    return region_names(spark, sf).select("iso").orderBy(F.md5(F.concat("iso", F.lit(":42"))), "iso").limit(18)


@query("o10_first_five", "SELECT c_mktsegment AS segment, array_to_string(list_sort(list(c_custkey))[1:5], ',') AS first_five FROM customer WHERE c_acctbal < 0 GROUP BY 1")
def o10_first_five(spark, sf):
    """The five least by group: ranks before the list, so no list grows."""
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy("c_custkey"))
    first = table(spark, sf, "customer").filter("c_acctbal < 0").withColumn("k", k).filter("k <= 5")
    return first.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.array_join(F.array_sort(F.collect_list("c_custkey")).cast("array<string>"), ",").alias("first_five"))


@query("o11_batches_of_five", f"SELECT iso, CAST((row_number() OVER (ORDER BY iso) - 1) // 5 AS BIGINT) AS batch FROM ({_REGIONS})")
def o11_batches_of_five(spark, sf):
    from pyspark.sql import Window

    k = F.row_number().over(Window.orderBy("iso")) - 1  # 25 regions
    return region_names(spark, sf).select("iso", F.floor(k / 5).alias("batch"))


@query("g12_distinct_regions", "SELECT DISTINCT c_nationkey AS nation FROM customer WHERE c_acctbal > 0")
def g12_distinct_regions(spark, sf):
    return table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_nationkey").alias("nation")).distinct()


# ---- Element assembly -----------------------------------------------------------------------------------------------


def ways_and_nodes(spark, sf) -> dict[str, DataFrame]:
    """Orders as ways over parts as nodes: a line item is a reference, a part lies at (size, price / 100)."""
    tags = F.create_map(F.lit("highway"), F.lit("x"))
    nodes = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("lon"), (F.col("p_retailprice") / 100).alias("lat"), tags.alias("tags"))
    refs = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    ways = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(refs.alias("refs")).withColumn("tags", tags)
    relations = spark.createDataFrame([], "id bigint, members array<struct<type:string,ref:bigint,role:string>>, tags map<string,string>")
    return {"nodes": nodes, "ways": ways, "relations": relations}


def one_region(spark, x1: float, y1: float, x2: float, y2: float) -> DataFrame:
    r = spark.range(1).select(F.lit("XX-1").alias("iso"), F.struct(F.lit(x1).alias("xmin"), F.lit(y1).alias("ymin"), F.lit(x2).alias("xmax"), F.lit(y2).alias("ymax")).alias("region_extent"))
    return r.withColumn("region_geometry", G.wkb_box("region_extent.xmin", "region_extent.ymin", "region_extent.xmax", "region_extent.ymax"))


_INSIDE = "p_size > 10.5 AND p_size < 30.5 AND p_retailprice / 100 > 9.001 AND p_retailprice / 100 < 12.003"


@query("j11_way_assembly", "SELECT l_orderkey AS way, count(*) AS points, string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS sizes FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def j11_way_assembly(spark, sf):
    from terrella.operators.elements import way_lines

    e = ways_and_nodes(spark, sf)
    lines = way_lines(e["ways"], e["nodes"])
    return lines.select("way", F.size("line").cast("long").alias("points"), F.array_join(F.transform("line", lambda p: p["lon"].cast("int").cast("string")), ",").alias("sizes"))


@query("e2_extract_simple", f"SELECT l_orderkey AS way, count(*) AS inside FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {_INSIDE} GROUP BY 1")
def e2_extract_simple(spark, sf):
    from terrella.operators.elements import extract, refs_of

    e = ways_and_nodes(spark, sf)
    got = extract(e["nodes"], e["ways"], e["relations"], one_region(spark, 10.5, 9.001, 30.5, 12.003))
    at = refs_of(got["ways"]).join(got["nodes"].select(F.col("id").alias("ref")), "ref")
    return at.groupBy("way").agg(F.count("*").alias("inside"))


@query("e1_extract_complete_ways", f"SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {_INSIDE}) UNION SELECT p_partkey FROM part WHERE {_INSIDE}")
def e1_extract_complete_ways(spark, sf):
    from terrella.operators.elements import extract

    e = ways_and_nodes(spark, sf)
    return extract(e["nodes"], e["ways"], e["relations"], one_region(spark, 10.5, 9.001, 30.5, 12.003), "complete_ways")["nodes"].select("id")


@query("e4_clipped_runs", f"WITH i AS (SELECT l_orderkey AS way, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos, p_size, p_retailprice FROM lineitem JOIN part ON l_partkey = p_partkey), k AS (SELECT way, pos - row_number() OVER (PARTITION BY way ORDER BY pos) AS run FROM i WHERE {_INSIDE}) SELECT way, count(*) AS points FROM k GROUP BY way, run HAVING count(*) >= 2")
def e4_clipped_runs(spark, sf):
    from terrella.operators.elements import clipped_runs, extract

    e = ways_and_nodes(spark, sf)
    got = extract(e["nodes"], e["ways"], e["relations"], one_region(spark, 10.5, 9.001, 30.5, 12.003))
    return clipped_runs(e["ways"], got["nodes"]).select("way", F.size("line").cast("long").alias("points"))


@query("e3_extract_strategies", f"SELECT 'simple' AS strategy, count(DISTINCT p_partkey) AS nodes, (SELECT count(DISTINCT l_orderkey) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {_INSIDE}) AS ways FROM part WHERE {_INSIDE} UNION ALL SELECT 'complete_ways', count(DISTINCT id), (SELECT count(DISTINCT l_orderkey) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {_INSIDE}) FROM (SELECT l_partkey AS id FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {_INSIDE}) UNION SELECT p_partkey FROM part WHERE {_INSIDE})")
def e3_extract_strategies(spark, sf):
    from terrella.operators.elements import extract

    e, out = ways_and_nodes(spark, sf), None
    for strategy in ("simple", "complete_ways"):
        got = extract(e["nodes"], e["ways"], e["relations"], one_region(spark, 10.5, 9.001, 30.5, 12.003), strategy)
        both = got["nodes"].agg(F.count("*").alias("nodes")).crossJoin(got["ways"].agg(F.count("*").alias("ways")))  # one row by one row
        row = both.select(F.lit(strategy).alias("strategy"), "nodes", "ways")
        out = row if out is None else out.unionByName(row)
    return out


@query("e5_filter_with_referenced", "SELECT 'node' AS kind, count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000) UNION ALL SELECT 'way', count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000)")
def e5_filter_with_referenced(spark, sf):
    """Ways that meet a filter, and the nodes, without tags that do, to which they refer."""
    from terrella.operators.elements import matching

    e = ways_and_nodes(spark, sf)
    priced = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_totalprice") > 100000, "primary").alias("highway"))
    ways = e["ways"].drop("tags").join(priced, "id").withColumn("tags", F.when(F.col("highway").isNull(), F.create_map(F.lit("name"), F.lit("x"))).otherwise(F.create_map(F.lit("highway"), F.col("highway")))).drop("highway")
    got = matching({"nodes": e["nodes"], "ways": ways, "relations": e["relations"]}, themes.THEMES["roads"], include_referenced=True)
    return got["nodes"].agg(F.count("*").alias("n")).select(F.lit("node").alias("kind"), "n").unionByName(got["ways"].agg(F.count("*").alias("n")).select(F.lit("way").alias("kind"), "n"))


@query(
    "e6_export_features",
    """WITH s AS (SELECT s_suppkey AS s, CAST(s_suppkey % 100 AS DOUBLE) AS x, CAST(s_suppkey // 100 AS DOUBLE) AS y FROM supplier)
 SELECT s AS osm_id, 'relation' AS osm_type, 'polygon' AS geometry_kind, x AS xmin, y AS ymin, x + 0.5 AS xmax, y + 0.5 AS ymax FROM s
 UNION ALL SELECT 1000000000 + s, 'way', k, x, y, x + 0.5, y + 0.5 FROM s, (SELECT unnest(['polygon', 'linestring']) AS k) WHERE s % 2 = 0
 UNION ALL SELECT 8 * s, 'node', 'point', x, y, x, y FROM s WHERE s % 3 = 0""",
)
def e6_export_features(spark, sf):
    """Suppliers as squares: a relation of two half rings, for even ones a closed way too, and a tagged corner for each third."""
    from terrella.operators.elements import features

    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("s"))
    corners = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for k, dx, dy in ((0, 0.0, 0.0), (1, 0.5, 0.0), (2, 0.5, 0.5), (3, 0.0, 0.5))]))
    no_tags = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    building = F.create_map(F.lit("building"), F.lit("yes"))
    c = s.select("s", corners.alias("c"))
    nodes = c.select((8 * F.col("s") + F.col("c.k")).alias("id"), (F.col("s") % 100 + F.col("c.dx")).alias("lon"), (F.floor(F.col("s") / 100) + F.col("c.dy")).alias("lat"), F.when((F.col("c.k") == 0) & (F.col("s") % 3 == 0), F.create_map(F.lit("shop"), F.lit("books"))).otherwise(no_tags).alias("tags"))
    at = lambda *ks: F.array(*[8 * F.col("s") + k for k in ks])
    halves = [s.select((10 * F.col("s") + k).alias("id"), at(*ks).alias("refs"), no_tags.alias("tags")) for k, ks in ((0, (0, 1, 2)), (1, (0, 3, 2)))]
    closed = s.filter("s % 2 = 0").select((F.lit(1_000_000_000) + F.col("s")).alias("id"), at(0, 1, 2, 3, 0).alias("refs"), building.alias("tags"))
    member = lambda k: F.struct(F.lit("way").alias("type"), (10 * F.col("s") + k).alias("ref"), F.lit("outer").alias("role"))
    relations = s.select(F.col("s").alias("id"), F.array(member(0), member(1)).alias("members"), F.create_map(F.lit("type"), F.lit("multipolygon"), F.lit("building"), F.lit("yes")).alias("tags"))
    got = features({"nodes": nodes, "ways": halves[0].unionByName(halves[1]).unionByName(closed), "relations": relations})
    return got.select("osm_id", "osm_type", "geometry_kind", G.extent_of("geometry").alias("e")).select("osm_id", "osm_type", "geometry_kind", "e.*")


@query("e7_extract_all_regions", f"SELECT iso, count(*) AS nodes FROM ({_PTS}) p JOIN ({_CELLS}) r ON x > x1 AND x < x1 + 72 AND y > y1 AND y < y1 + 36 GROUP BY iso")
def e7_extract_all_regions(spark, sf):
    """All regions in one pass over the elements."""
    from terrella.operators.elements import extract

    nodes = points(spark, sf).select(F.col("vec_id").alias("id"), F.col("x").alias("lon"), F.col("y").alias("lat"), F.create_map(F.lit("a"), F.lit("b")).alias("tags"))
    ways = nodes.select("id", F.array("id", "id").alias("refs"), "tags")
    none = spark.createDataFrame([], "id bigint, members array<struct<type:string,ref:bigint,role:string>>, tags map<string,string>")
    got = extract(nodes, ways, none, laid_out_regions(spark, sf))
    return got["nodes"].groupBy("iso").agg(F.count("*").alias("nodes")).join(got["ways"].select("iso").distinct(), "iso")


# ---- Sources and sinks: what is written is read back ----------------------------------------------------------------


_SHOPS = f"SELECT p_partkey, CAST(p_partkey % 50 AS DOUBLE) AS x, shop, railway, highway, CASE p_partkey % 2 WHEN 0 THEN 'US-NY' ELSE 'CA-ON' END AS iso FROM ({_ELEMENTS}) WHERE kind = 'node'"
_TREE = f"SELECT 'pois' AS theme, iso AS state_iso, p_partkey AS osm_id FROM ({_SHOPS}) WHERE shop IS NOT NULL UNION ALL SELECT 'public_transport', iso, p_partkey FROM ({_SHOPS}) WHERE coalesce(highway = 'bus_stop', false) OR coalesce(railway = 'station', false)"
_BUILT = ("pois", "public_transport", "places")


def feature_lines(spark, sf) -> str:
    """Writes the elements as GeoJSON lines, one in seven without a geometry; the path."""
    at = F.struct(F.lit("Point").alias("type"), F.array((F.col("p_partkey") % 50).cast("double"), F.lit(1.0)).alias("coordinates"))
    line = F.struct(F.lit("Feature").alias("type"), F.col("p_partkey").cast("string").alias("id"), F.col("tags").alias("properties"), F.when(F.col("p_partkey") % 7 != 0, at).alias("geometry"))
    path = scratch(spark)
    elements(spark, sf).select(F.to_json(line, {"ignoreNullFields": "false"}).alias("value")).write.text(path)
    return path


def built_tree(spark, sf) -> str:
    """Builds three themes, one of them empty, for two regions; the root of the tree."""
    from terrella.sources import tables

    root, n = scratch(spark), F.col("p_partkey")
    nodes = elements(spark, sf).filter("kind = 'node'")
    located = nodes.select(n.alias("osm_id"), F.col("kind").alias("osm_type"), F.when(n % 2 == 0, "US").otherwise("CA").alias("country"), F.when(n % 2 == 0, "New York").otherwise("Ontario").alias("state"), F.when(n % 2 == 0, "US-NY").otherwise("CA-ON").alias("state_iso"), "tags", (n % 50).cast("double").alias("x"), F.lit(1.0).alias("y"))
    located = with_extent(located).withColumns({"geometry": G.wkb_point("x", "y"), "geometry_kind": F.lit("Point")}).drop("x", "y")
    tables.build(located, root, list(_BUILT), "x.pbf", "osm_type")
    return root


@query("s3_feature_lines", f"SELECT p_partkey AS osm_id, 'Point' AS geometry_kind, CAST(p_partkey % 50 AS DOUBLE) AS xmin, shop, highway FROM ({_ELEMENTS}) WHERE p_partkey % 7 <> 0")
def s3_feature_lines(spark, sf):
    """Lines written and read; those without a geometry drop, and a path that isn't there gives no rows."""
    from terrella.sources import geojson

    path = feature_lines(spark, sf)
    got = geojson.features(geojson.read_lines(spark, path, f"{path}/none.jsonl"))
    return got.select("osm_id", "geometry_kind", "extent.xmin", T.tag("tags", "shop").alias("shop"), T.tag("tags", "highway").alias("highway"))


@query("s2_region_collection", f"SELECT iso, name, split_part(iso, '-', 1) AS country, CAST(length(name) AS DOUBLE) AS xmax FROM ({_REGIONS})")
def s2_region_collection(spark, sf):
    """Regions written as a FeatureCollection, one of them without a code, and read."""
    from terrella.operators.snapshots import Store
    from terrella.sources import geojson

    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    found = [{"type": "Feature", "properties": {"ISO3166-2": r["iso"], "name": r["name"]}, "geometry": {"type": "Polygon", "coordinates": [[[x * len(r["name"]), y] for x, y in ring]]}} for r in region_names(spark, sf).collect()]  # 25 regions
    root = scratch(spark)
    Store(spark, root).write_text("regions.json", json.dumps({"type": "FeatureCollection", "features": [*found, {"type": "Feature", "properties": {"name": "x"}, "geometry": None}]}))
    return geojson.regions(spark, f"{root}/regions.json").select("iso", "name", "country", "region_extent.xmax")


@query("k1_theme_tree", f"SELECT *, CASE state_iso WHEN 'US-NY' THEN 'New York' ELSE 'Ontario' END AS state FROM ({_TREE})")
def k1_theme_tree(spark, sf):
    """A tree written, and read back by glob; the empty theme has no file and gives no rows."""
    from terrella.sources import tables

    root, out = built_tree(spark, sf), None
    for name in _BUILT:
        rows = tables.read_theme(spark, root, name).select(F.lit(name).alias("theme"), "state_iso", "osm_id", "state")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("s9_read_manifests", f"SELECT iso AS state_iso, t.theme, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (SELECT unnest(['US-NY', 'CA-ON']) AS iso), (SELECT unnest(['pois', 'public_transport', 'places']) AS theme) t LEFT JOIN (SELECT state_iso, theme, count(*) AS n FROM ({_TREE}) GROUP BY 1, 2) c ON c.state_iso = iso AND c.theme = t.theme")
def s9_read_manifests(spark, sf):
    got = manifests.read_manifests(spark, built_tree(spark, sf))
    return got.select(F.col("iso").alias("state_iso"), F.explode("themes").alias("theme", "n"))


@query("s8_footers", f"SELECT state_iso, theme, count(*) AS rows, '2.0.0' AS geo_version, true AS has_base FROM ({_TREE}) GROUP BY 1, 2")
def s8_footers(spark, sf):
    root = built_tree(spark, sf)
    files = snapshots.Store(spark, root).objects().filter(F.col("key").endswith(".parquet")).select("key", F.concat(F.lit(f"{root}/"), "key").alias("path"))
    parts = X.parts_of(F.col("key"))
    base = F.array(*[F.lit(c) for c in (*themes.BASE_FIRST, *themes.BASE_LAST)])
    got = files.join(manifests.footers(files), "path")
    return got.select(X.region_of_dir(F.element_at(parts, 2)).alias("state_iso"), F.regexp_replace(F.element_at(parts, 3), "[.]parquet$", "").alias("theme"), "rows", "geo_version", manifests.is_subset(base, F.col("columns")).alias("has_base"))


@query("c6_check_tree", "SELECT * FROM (VALUES ('every region has a manifest', 1), ('every manifest lists the themes', 0), ('every theme was built', 0), ('every listed file is there', 1), ('row counts match', 0), ('base columns and metadata are there', 0)) t(\"check\", failures)")
def c6_check_tree(spark, sf):
    """A tree of which a file is lost, against a list with one region more than it has."""
    from terrella.sources import tables

    root = built_tree(spark, sf)
    snapshots.Store(spark, root).delete(tables.url("", "US-NY", "pois").lstrip("/"))
    expected = spark.createDataFrame([("US-NY",), ("CA-ON",), ("MX-XX",)], "iso string")
    return manifests.check_tree(spark, root, expected, list(_BUILT)).select("check", F.col("failures").cast("int").alias("failures"))


@query("c8_publish", f"WITH f AS (SELECT count(DISTINCT (state_iso, theme)) AS n FROM ({_TREE})) SELECT unnest(['2024-05-06', 'latest']) AS folder, n AS parquet_files, 2 AS manifests, true AS same FROM f UNION ALL SELECT 'root', 0, 0, true")
def c8_publish(spark, sf):
    """A build published to its dated folder and the mirror; the root holds the notice and an index that says the same."""
    built, root = built_tree(spark, sf), scratch(spark)
    store = snapshots.Store(spark, root)
    snapshots.publish(spark, built, root, "2024-05-06")
    said = snapshots.read_index(spark, f"{root}/snapshots.json").select(F.col("date").alias("folder"), F.col("bytes").alias("told"))
    o = store.objects().withColumn("folder", F.when(F.col("key").contains("/"), F.substring_index("key", "/", 1)).otherwise("root"))
    own = o.groupBy("folder").agg(F.count(F.when(F.col("key").endswith(".parquet"), 1)).alias("parquet_files"), F.count(F.when(F.col("key").endswith("_manifest.json"), 1)).cast("int").alias("manifests"), F.sum("size").alias("bytes"))
    return own.join(said, "folder", "left").select("folder", "parquet_files", "manifests", F.coalesce(F.col("bytes") == F.col("told"), F.lit(True)).alias("same"))


@query("c5_prune", f"SELECT DISTINCT strftime(day, '%Y-%m-%d') AS folder FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders), LATERAL (SELECT unnest([CAST(m AS DATE), CAST(m AS DATE) + 30]) AS day) WHERE {_VERDICT} = 'keep'")
def c5_prune(spark, sf):
    """The folders left of two for each month after those to delete went."""
    month = F.date_trunc("month", "o_orderdate").cast("date")
    days = table(spark, sf, "orders").select(month.alias("m")).distinct().select(F.explode(F.array("m", F.date_add("m", 30))).alias("day"))
    root = scratch(spark)
    store = snapshots.Store(spark, root)
    for r in days.select(F.date_format("day", "yyyy-MM-dd").alias("name")).distinct().collect():  # two folders a month
        store.write_text(f"{r['name']}/x.json", "{}")
    snapshots.prune(spark, root, date(2001, 7, 20), execute=True)
    return spark.createDataFrame([(x,) for x in store.folders()], "folder string")


@query("s12_snapshot_index", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, strftime(o_orderdate, '%Y-%m-%d') || '/' AS path, count(*) AS objects, CAST(sum(o_custkey) AS BIGINT) AS bytes FROM orders GROUP BY 1, 2")
def s12_snapshot_index(spark, sf):
    """The index written, and read back."""
    root = scratch(spark)
    snapshots.Store(spark, root).write_text("snapshots.json", snapshots.index(dated_objects(spark, sf)))
    return snapshots.read_index(spark, f"{root}/snapshots.json")


@query("p13_not_null_on_join", "SELECT p_partkey, name FROM (SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN p_name END AS name FROM part) JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45) ON p_partkey = l_partkey WHERE name IS NOT NULL")
def p13_not_null_on_join(spark, sf):
    named = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 3 > 0, F.col("p_name")).alias("name")).filter(F.col("name").isNotNull())
    return named.join(table(spark, sf, "lineitem").filter("l_quantity > 45"), F.col("p_partkey") == F.col("l_partkey"), "left_semi")


@query("j7_unknown_names", "SELECT DISTINCT lower(c_mktsegment) AS name FROM customer")
def j7_unknown_names(spark, sf):
    """Segments asked for as themes: all unknown, and the error names them."""
    asked = [r[0] for r in table(spark, sf, "customer").select(F.lower("c_mktsegment")).distinct().collect()]  # a few segments
    try:
        themes.choose(asked, list(themes.THEMES), "themes")
    except ValueError as e:
        return spark.createDataFrame([(x,) for x in str(e).partition(": ")[2].split(", ")], "name string")
    raise AssertionError("no segment is a theme")
