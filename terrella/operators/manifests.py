"""Region manifests, and the checks of a built tree against them."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.functions.text import iso_prefix, tenths
from terrella.operators.themes import BASE_FIRST, BASE_LAST, THEMES

#: Fixed values.
SCHEMA_VERSION, GEO_VERSION = "0.2.0", "2.0.0"
COUNTRIES, EXCLUDED = ("US", "CA", "MX"), ("US-AS", "US-GU", "US-MP", "US-UM")


def manifests(counts: DataFrame, source: str, duration: Column | None = None) -> DataFrame:
    """counts: (state_iso, state_name, theme, n), n -1 for a failed theme. A row for each region with its JSON."""
    positive = F.sum(F.when(F.col("n") > 0, F.col("n")).otherwise(0))
    seconds = duration if duration is not None else F.lit(0.0)
    rows = counts.groupBy("state_iso", "state_name").agg(positive.alias("total_features"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("theme", "n")))).alias("themes"))
    whole = F.struct(F.lit(SCHEMA_VERSION).alias("schema_version"), iso_prefix(F.col("state_iso")).alias("country"), "state_iso", "state_name", F.lit(source).alias("source_pbf"), tenths(seconds).alias("duration_s"), "total_features", "themes")
    return rows.select("state_iso", "state_name", "total_features", "themes", F.to_json(whole).alias("manifest"))


def expected_regions(regions: DataFrame, countries: tuple[str, ...] = COUNTRIES, excluded: tuple[str, ...] = EXCLUDED, iso: str = "iso") -> DataFrame:
    """Distinct codes of the countries that are built, without the excluded."""
    return regions.filter((F.col(iso) != "") & iso_prefix(F.col(iso)).isin(*countries) & ~F.col(iso).isin(*excluded)).select(F.col(iso).alias("iso")).distinct()


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """(iso, themes, manifest) of the tree below root. Spark's readers skip names with an underscore, so the
    driver reads these small files, one a region."""
    from terrella.operators.snapshots import Store

    store = Store(spark, root)
    rows = []
    for key, *_ in store.files():
        parts = key.split("/")
        if parts[-1] == "_manifest.json" and len(parts) == 3 and parts[0].startswith("country=") and parts[1].startswith("state="):
            text = store.read_text(key)
            rows.append((parts[1].replace("state=", ""), {k: int(v) for k, v in (json.loads(text).get("themes") or {}).items()}, text))
    return spark.createDataFrame(rows, "iso string, themes map<string,long>, manifest string")


def footers(files: DataFrame, path: str = "path") -> DataFrame:
    """files: rows with a path. (path, rows, columns, geo_version, error) from each Parquet file's footer."""

    def run(batches):
        import pyarrow.parquet as pq

        for b in batches:
            out = []
            for p in b.column(0).to_pylist():
                try:
                    f = pq.ParquetFile(p)
                    geo = (f.metadata.metadata or {}).get(b"geo")
                    out.append((p, f.metadata.num_rows, f.schema_arrow.names, json.loads(geo).get("version") if geo else None, None))
                except Exception as e:  # noqa: BLE001  a file that can't be read is a finding
                    out.append((p, None, [], None, str(e)))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.string())), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())], ["path", "rows", "columns", "geo_version", "error"])

    return files.select(path).mapInArrow(run, "path string, rows long, columns array<string>, geo_version string, error string")


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def is_subset(part: Column, whole: Column) -> Column:
    return F.size(F.array_except(part, whole)) == 0


def check_tree(spark: SparkSession, root: str, expected: DataFrame, themes: list[str] | None = None) -> DataFrame:
    """(check, passed, failures, detail): manifests of all regions, their themes, files, row counts and schemas.

    Themes that failed to build (-1) have a check of their own. detail names the first five.
    """
    from terrella.operators.snapshots import Store

    wanted = themes or list(THEMES)
    got = read_manifests(spark, root)
    listed = Store(spark, root).objects().select("key", "size")
    claims = got.join(expected, "iso", "left_semi").select("iso", F.explode("themes").alias("theme", "claimed"))
    claims = claims.withColumn("key", F.concat(F.lit("country="), iso_prefix(F.col("iso")), F.lit("/state="), "iso", F.lit("/"), "theme", F.lit(".parquet")))
    positive = claims.filter("claimed > 0").join(listed, "key", "left")
    there = positive.filter("size > 0").withColumn("path", F.concat(F.lit(root.rstrip("/") + "/"), "key"))
    feet = there.join(footers(there), "path")
    base = F.array(*[F.lit(c) for c in (*BASE_FIRST, *BASE_LAST)])
    where = F.concat_ws("/", "iso", "theme")

    def check(name: str, bad: DataFrame, what: Column) -> DataFrame:
        first = F.array_join(F.slice(F.array_sort(F.collect_list("w")), 1, 5), ", ")
        return bad.select(what.alias("w")).agg(F.count("*").alias("failures"), first.alias("detail")).select(F.lit(name).alias("check"), (F.col("failures") == 0).alias("passed"), "failures", "detail")

    parts = [
        check("every region has a manifest", expected.join(got, "iso", "left_anti"), F.col("iso")),
        check("every manifest lists the themes", got.join(expected, "iso", "left_semi").filter(~same_set(F.map_keys("themes"), F.array(*[F.lit(t) for t in wanted]))), F.col("iso")),
        check("every theme was built", claims.filter("claimed < 0"), where),
        check("every listed file is there", positive.filter("size is null or size = 0"), where),
        check("row counts match", feet.filter("error is null and rows <> claimed"), where),
        check("base columns and metadata are there", feet.filter(F.col("error").isNotNull() | ~is_subset(base, F.col("columns")) | (F.coalesce("geo_version", F.lit("")) != GEO_VERSION)), where),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def totals(checks: DataFrame) -> DataFrame:
    return checks.agg(F.sum(F.col("passed").cast("long")).alias("passed"), F.sum((~F.col("passed")).cast("long")).alias("failed"))


def header_policy(headers: DataFrame) -> DataFrame:
    """headers: (object, cache_control, want, forbid). Adds passed: the wanted word is there, the forbidden isn't."""
    cc = F.coalesce("cache_control", F.lit(""))
    return headers.withColumn("passed", cc.contains(F.col("want")) & (F.col("forbid").isNull() | ~cc.contains(F.col("forbid"))))
