"""What the operators of this subpackage share: inputs, staged tables and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every operator: space, tab, line feed, vertical tab, form feed, carriage return.
SEPARATORS = "\\x20\\x09-\\x0D"

#: A table is broadcast only if its counted rows, and the bytes that these take in memory, are at most so many.
BROADCAST_ROWS, BROADCAST_BYTES = 400_000, 32_000_000

#: Rows of a bucket, about, and the most buckets of a table.
BUCKET_ROWS, MOST_BUCKETS = 20_000, 100_000

#: Bytes in memory for a byte of a staged file, about; types whose values all take the same room.
EXPANSION, _FIXED = 4, ("boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; one of our own only in local mode, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="terrella-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it back.

    The files outlive any executor, so later stages are recomputed from them and not from the source.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_at = path
    return back


def bucketed(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Cut lineage like staged(), dealt to buckets by key; and the number of buckets. A join by key with a table that is
    repartitioned by key into as many moves the other side only."""
    spark = df.sparkSession
    name = f"terrella_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    n = min(MOST_BUCKETS, max(2 * spark.sparkContext.defaultParallelism, df.count() // BUCKET_ROWS + 1))
    df.repartition(n, key).write.bucketBy(n, key).option("compression", "zstd").option("path", path).saveAsTable(name)
    back = spark.table(name)
    # The files stay, as the table is external; only its name goes.
    spark.sql(f"DROP TABLE {name}")
    back._staged_at = path
    return back, n


def _folder(df: DataFrame):
    """(file system, path) of a staged table; None for others."""
    path = getattr(df, "_staged_at", None)
    if path is None:
        return None
    where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()), where


def release(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        if at := _folder(df):
            at[0].delete(at[1], True)


def _in_memory(df: DataFrame, rows: int) -> float:
    """Bytes that a broadcast of df takes, about; no bound for columns of any length of a table that isn't staged."""
    fixed = rows * (24 + 16 * len(df.columns))
    if all(f.dataType.typeName() in _FIXED for f in df.schema.fields):
        return fixed
    at = _folder(df)
    return fixed + EXPANSION * at[0].getContentSummary(at[1]).getLength() if at else float("inf")


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a table for broadcast if it is small, as counted now; else leave the join to shuffle."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS and _in_memory(df, n) <= BROADCAST_BYTES else df


def identity(*columns: str | Column) -> Column:
    """128 bits that tell rows with other values in these columns apart."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in (F.col(c) if isinstance(c, str) else c for c in columns)]
    return F.unhex(F.md5(F.concat(*parts)))


def bare(text: str | Column) -> Column:
    """A text without separators at its ends."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def n_words(text: str) -> Column:
    """Runs of characters other than separators; a null text has none."""
    t = bare(text)
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(t, f"[{SEPARATORS}]+"))).cast("long")
