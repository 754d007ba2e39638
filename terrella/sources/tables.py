"""Theme tables on disk: country=<C>/state=<ISO>/<theme>.parquet, read and written.

The column state holds a region's name while the folder state= holds its code, so the tree is never read by
partition discovery, which would put the code into the column: readers name paths and the schema.
"""

from __future__ import annotations

import json
import logging
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrella.functions.text import iso_prefix
from terrella.operators.snapshots import Store
from terrella.operators.spatial import with_hilbert_key
from terrella.operators.themes import THEMES, Theme

#: Fixed value: rows of a row group.
GROUP_ROWS = 50_000


def url(root: str, region: str, theme: str) -> str:
    """The path of a region's theme."""
    return f"{root.rstrip('/')}/country={region.split('-')[0]}/state={region}/{theme}.parquet"


def register_url(spark: SparkSession, root: str) -> None:
    """The same as a SQL function url(state, theme)."""
    base = root.rstrip("/").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION url(state STRING, theme STRING) RETURNS STRING RETURN concat('{base}/country=', split_part(state, '-', 1), '/state=', state, '/', theme, '.parquet')")


def read_theme(spark: SparkSession, root: str, theme: str, regions: list[str] | None = None) -> DataFrame:
    """A theme of the regions named, or of all; regions without a file are absent."""
    schema = THEMES[theme].schema
    if regions is None:
        paths = [f"{root.rstrip('/')}/country=*/state=*/{theme}.parquet"]
        found = any(k.endswith(f"/{theme}.parquet") or f"/{theme}.parquet/" in k for k, *_ in Store(spark, root).files())
        paths = paths if found else []
    else:
        store = Store(spark, root)
        paths = [url(root, r, theme) for r in regions if store.exists(url("", r, theme).lstrip("/"))]
    if not paths:
        return spark.createDataFrame([], T.StructType.fromDDL(schema))
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)


def ordered(rows: DataFrame) -> DataFrame:
    """rows of theme_rows(): along each region's Hilbert curve, inside partitions; one region may fill several."""
    keyed = with_hilbert_key(rows, ["state_iso"])
    return keyed.repartitionByRange("state_iso", "hilbert").sortWithinPartitions("state_iso", "hilbert")


def write_native(rows: DataFrame, theme: Theme, root: str) -> None:
    """Spark's own writer: one folder a region, 50,000-row groups, bloom filters on the admin, the typed (but doubles) and the tag columns."""
    out = ordered(rows).drop("extent", "hilbert")
    writer = out.withColumn("__country", iso_prefix(F.col("state_iso"))).withColumn("__region", F.col("state_iso")).write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", str(GROUP_ROWS))
    admin = ("country", "state", "state_iso")
    for c in [*admin, *(c.name for c in theme.columns if c.kind != "double"), "tags.key_value.key", "tags.key_value.value"]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.partitionBy("__country", "__region").parquet(f"{root.rstrip('/')}/theme={theme.name}")


class _Wkb(pa.ExtensionType):
    """Bytes that Parquet shall know as geometry."""

    def __init__(self):
        super().__init__(pa.binary(), "geoarrow.wkb")

    def __arrow_ext_serialize__(self) -> bytes:
        return b"{}"

    @classmethod
    def __arrow_ext_deserialize__(cls, storage_type, serialized):
        return cls()


def _register() -> None:
    try:
        pa.register_extension_type(_Wkb())
    except pa.ArrowKeyError:
        pass


def _geo_metadata(kinds: list[str], box: list[float]) -> bytes:
    column = {"encoding": "WKB", "geometry_types": sorted(kinds), "bbox": box}
    return json.dumps({"version": "2.0.0", "primary_column": "geometry", "columns": {"geometry": column}}).encode()


def write_tree(rows: DataFrame, theme: Theme, root: str) -> DataFrame:
    """One GeoParquet 2.0 file for each region, in Hilbert order, with streamed row groups. (state_iso, n).

    Regions are whole in a task, but rows pass through a row group at a time. A file appears by a rename, so a
    task that runs twice does no harm. root is a folder that all executors see.
    """
    from terrella.functions.geometry import NAMES

    _register()
    names = [f.name for f in T.StructType.fromDDL(theme.schema)]

    def run(batches):
        import pyarrow.parquet as pq

        _register()
        writer = at = None
        buffered: list[pa.RecordBatch] = []
        held = n = 0
        kinds: set[str] = set()
        box = np.array([np.inf, np.inf, -np.inf, -np.inf])

        def flush(more: int):
            nonlocal buffered, held, writer
            while held and (held >= GROUP_ROWS or not more):
                t = pa.Table.from_batches(buffered)
                part, rest = t.slice(0, GROUP_ROWS), t.slice(GROUP_ROWS)
                g = part.column("geometry").combine_chunks()
                g = g if isinstance(g, pa.Array) else g.chunk(0)
                part = part.set_column(names.index("geometry"), "geometry", pa.ExtensionArray.from_storage(_Wkb(), g.cast(pa.binary())))
                if writer is None:
                    writer = pq.ParquetWriter(f"{at[1]}.{at[2]}", part.schema, compression="zstd", store_schema=False)  # else readers see that schema's metadata in place of the file's
                writer.write_table(part, row_group_size=GROUP_ROWS)
                buffered, held = rest.to_batches(), rest.num_rows

        def close():
            nonlocal writer, kinds, box, n
            flush(0)
            writer.add_key_value_metadata({"geo": _geo_metadata(sorted(kinds), box.tolist()).decode()})
            writer.close()
            os.replace(f"{at[1]}.{at[2]}", at[1])
            done = (at[0], n)
            writer, kinds, box, n = None, set(), np.array([np.inf, np.inf, -np.inf, -np.inf]), 0
            return done

        def report(done):
            return pa.RecordBatch.from_arrays([pa.array([done[0]], pa.string()), pa.array([done[1]], pa.int64())], ["state_iso", "n"])

        for batch in batches:
            iso = batch.column(batch.schema.get_field_index("state_iso")).to_pylist()
            cuts = [0, *[i for i in range(1, len(iso)) if iso[i] != iso[i - 1]], len(iso)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if at is None or at[0] != iso[a]:
                    if at:
                        yield report(close())
                    path = url(root, iso[a], theme.name)
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    at = (iso[a], path, uuid.uuid4().hex)
                part = batch.slice(a, b - a)
                e = part.column(part.schema.get_field_index("extent"))
                lo = [np.nanmin(e.field(k).to_numpy(zero_copy_only=False)) for k in (0, 1)]
                hi = [np.nanmax(e.field(k).to_numpy(zero_copy_only=False)) for k in (2, 3)]
                box = np.array([min(box[0], lo[0]), min(box[1], lo[1]), max(box[2], hi[0]), max(box[3], hi[1])])
                kinds |= {NAMES[g[1] & 0xFF] for g in part.column(part.schema.get_field_index("geometry")).to_pylist()}
                buffered.append(part.select(names))
                held += b - a
                n += b - a
                flush(1)
        if at:
            yield report(close())

    keyed = with_hilbert_key(rows, ["state_iso"])
    placed = keyed.repartition("state_iso").sortWithinPartitions("state_iso", "hilbert").drop("hilbert")
    return placed.mapInArrow(run, "state_iso string, n long")


def build(features: DataFrame, root: str, themes: list[str] | None = None, source: str = "", kind: str | None = None) -> DataFrame:
    """Write the themes of located features and a manifest for each region. (state_iso, state_name, theme, n).

    features: (osm_id, osm_type, country, state, state_iso, tags, geometry, extent, geometry_kind). A theme that is
    empty in a region leaves no file, an older one goes; a theme that fails counts -1 and the others go on.
    """
    from terrella.operators.manifests import manifests
    from terrella.operators.themes import choose, theme_rows

    spark, store = features.sparkSession, Store(features.sparkSession, root)
    places = features.select("state_iso", F.col("state").alias("state_name")).distinct().collect()
    counts = []
    for name in choose(themes, list(THEMES), "themes"):
        theme = THEMES[name]
        try:
            got = {r["state_iso"]: r["n"] for r in write_tree(theme_rows(features, theme, kind, "geometry_kind"), theme, root).collect()}
        except Exception as e:  # noqa: BLE001  the manifest says which theme failed, the log why
            logging.getLogger(__name__).error("theme %s failed: %s", name, e)
            got = None
        for p in places:
            n = -1 if got is None else got.get(p["state_iso"], 0)
            if n <= 0:
                store.delete(url("", p["state_iso"], name).lstrip("/"))
            counts.append((p["state_iso"], p["state_name"], name, n))
    table = spark.createDataFrame(counts, "state_iso string, state_name string, theme string, n long")
    for r in manifests(table, source).collect():
        store.write_text(f"country={r['state_iso'].split('-')[0]}/state={r['state_iso']}/_manifest.json", json.dumps(json.loads(r["manifest"]), indent=2))
    return table
