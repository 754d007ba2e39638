"""Feature lines that arrive as files, as a stream of theme rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.operators.themes import THEMES, theme_rows
from terrella.sources.geojson import LINE_SCHEMA, features


def theme_stream(spark: SparkSession, folder: str, theme: str, state_iso: str, state: str) -> DataFrame:
    """Rows of a theme from lines that are put into a folder, for one region. The transform is the batch one."""
    lines = spark.readStream.schema(LINE_SCHEMA).json(folder)
    named = features(lines).withColumns({"country": F.lit(state_iso.split("-")[0]), "state": F.lit(state), "state_iso": F.lit(state_iso)})
    return theme_rows(named, THEMES[theme], geometry_kind="geometry_kind").drop("extent")


def append(stream: DataFrame, out: str, checkpoint: str):
    """Appends each batch to a Parquet table, exactly once."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
