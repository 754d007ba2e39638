"""Feature lines and region collections in GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.functions import geometry as G
from terrella.functions.tags import tag_map
from terrella.functions.text import iso_prefix

LINE_SCHEMA = "type string, id string, properties string, geometry string"


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Newline-delimited features with an explicit schema; a path that isn't there or is empty gives no rows."""
    from terrella.operators.snapshots import Store

    there = []
    for p in paths:
        folder, _, name = p.rstrip("/").rpartition("/")
        if any(c in name for c in "*?[{") or Store(spark, folder or ".").exists(name):
            there.append(p)
    if not there:
        return spark.createDataFrame([], LINE_SCHEMA)
    return spark.read.schema(LINE_SCHEMA).json(list(there))


def features(lines: DataFrame) -> DataFrame:
    """(osm_id, osm_type, tags, geometry, extent, geometry_kind) of the lines that have a geometry.

    osm_id is the line's id where it is a whole number, osm_type the line's type, as the format has them.
    """
    got = lines.filter(F.col("geometry").isNotNull()).select(F.col("id").try_cast("bigint").alias("osm_id"), F.col("type").alias("osm_type"), tag_map("properties").alias("tags"), G.wkb_from_geojson("geometry").alias("geometry"))
    got = got.filter(F.col("geometry").isNotNull())
    return got.withColumn("extent", G.extent_of("geometry")).withColumn("geometry_kind", G.kind_of("geometry"))


def regions(spark: SparkSession, path: str) -> DataFrame:
    """(iso, name, country, region_geometry, region_extent) from a FeatureCollection.

    Features without a code or a name are left out; none usable, a repeated code or another type raises.
    """
    schema = "type string, features array<struct<properties:map<string,string>,geometry:string>>"
    whole = spark.read.schema(schema).option("multiLine", True).json(path)
    kinds = [r["type"] for r in whole.select("type").limit(2).collect()]
    if kinds != ["FeatureCollection"]:
        raise ValueError(f"{path} is no FeatureCollection")
    each = whole.select(F.explode("features").alias("f")).select(F.col("f.properties")["ISO3166-2"].alias("iso"), F.col("f.properties")["name"].alias("name"), F.col("f.geometry").alias("g"))
    usable = each.filter((F.length("iso") > 0) & (F.length("name") > 0))
    counts = usable.agg(F.count("*").alias("n"), F.count_distinct("iso").alias("d")).first()
    if not counts["n"]:
        raise ValueError(f"{path} has no usable region")
    if counts["d"] < counts["n"]:
        raise ValueError(f"{path} repeats a region code")
    return usable.select("iso", "name", iso_prefix(F.col("iso")).alias("country"), G.wkb_from_geojson("g").alias("region_geometry")).withColumn("region_extent", G.extent_of("region_geometry"))
