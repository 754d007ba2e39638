"""Dated snapshots: retention, the index, publication and pruning on any Hadoop file system."""

from __future__ import annotations

import json
import re
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.functions.text import DATED

#: Days that all snapshots stay, and days that first-of-month ones stay.
RECENT, YEAR = 14, 365

#: What a copy of the data has to carry.
ATTRIBUTION = """Map data: (c) OpenStreetMap contributors, https://www.openstreetmap.org/copyright
Licence: Open Database License (ODbL) 1.0, https://opendatacommons.org/licenses/odbl/1-0/
Keep this notice with any copy or work made from these files.
"""


def verdict(day: Column, now: Column) -> Column:
    """keep or delete: recent ones, the last day of each year, and within a year the first of each month stay."""
    age = F.datediff(now, day)
    kept = (age <= RECENT) | ((F.month(day) == 12) & (F.dayofmonth(day) == 31)) | ((age <= YEAR) & (F.dayofmonth(day) == 1))
    return F.when(kept, "keep").otherwise("delete")


def retention(names: DataFrame, now: Column, name: str = "name") -> DataFrame:
    """names: folder names. (name, day, verdict): dated ones; a name that is no real date is invalid, never deleted."""
    day = F.try_to_date(F.col(name), "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.col(name).try_cast("date")
    got = names.filter(F.col(name).rlike(DATED)).select(F.col(name).alias("name"), day.alias("day"))
    return got.withColumn("verdict", F.when(F.col("day").isNull(), "invalid").otherwise(verdict(F.col("day"), now)))


def rollup(objects: DataFrame) -> DataFrame:
    """objects: (key, size). (date, path, objects, bytes) of each dated folder."""
    top = F.substring_index("key", "/", 1)
    dated = objects.filter(F.col("key").contains("/")).withColumn("date", top).filter(F.col("date").rlike(DATED))
    return dated.groupBy("date").agg(F.count("*").alias("objects"), F.sum("size").alias("bytes")).select("date", F.concat("date", F.lit("/")).alias("path"), "objects", "bytes")


def index(objects: DataFrame, now: datetime | None = None) -> str:
    """The snapshot index as JSON, newest first. A snapshot is a day, so their number is small."""
    rows = [r.asDict() for r in rollup(objects).orderBy(F.desc("date")).collect()]
    at = (now or datetime.now(UTC)).astimezone(UTC).isoformat(timespec="seconds")
    return json.dumps({"manifest_version": "1", "generated_at": at, "snapshots": rows}, indent=2)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(date, path, objects, bytes) of the snapshots that an index lists."""
    schema = "manifest_version string, generated_at string, snapshots array<struct<date:string,path:string,objects:bigint,bytes:bigint>>"
    whole = spark.read.schema(schema).option("multiLine", True).json(path)
    return whole.select(F.explode("snapshots").alias("s")).select("s.*")


class Store:
    """Files below a root, by way of Spark's own file system classes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self.path(name))

    def folders(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path()) if s.isDirectory()) if self.exists() else []

    def files(self, name: str = "") -> list[tuple[str, int, int, str]]:
        """(key, size, modified ms, etag), all files below, hidden ones too."""
        if not self.exists(name):
            return []
        top = self._fs.getFileStatus(self.path()).getPath().toString().rstrip("/") + "/"
        out, walk = [], self._fs.listFiles(self.path(name), True)
        while walk.hasNext():
            s = walk.next()
            key = s.getPath().toString()[len(top) :]
            if not key.rsplit("/", 1)[-1].endswith(".crc"):
                out.append((key, s.getLen(), s.getModificationTime(), f'"{s.getModificationTime():x}-{s.getLen():x}"'))
        return sorted(out)

    def objects(self, name: str = "") -> DataFrame:
        """(key, size, uploaded, etag)."""
        rows = self.spark.createDataFrame(self.files(name), "key string, size long, ms long, etag string")
        return rows.select("key", "size", F.timestamp_millis("ms").alias("uploaded"), "etag")

    def bytes(self, exclude: tuple[str, ...] = ("_work",)) -> int:
        """Of all files without an excluded name anywhere on their path."""
        return sum(size for key, size, _, _ in self.files() if not set(key.split("/")) & set(exclude))

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        """Replaces the file, changed or not."""
        out = self._fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def rename(self, name: str, to: str) -> None:
        self._fs.rename(self.path(name), self.path(to))

    def copy(self, source: str, to: str, exclude: tuple[str, ...] = ()) -> int:
        """Copies files of a folder (any URI); the number copied."""
        util = self.spark._jvm.org.apache.hadoop.fs.FileUtil
        other = Store(self.spark, source)
        n = 0
        for key, *_ in other.files():
            if not set(key.split("/")) & set(exclude):
                self._fs.mkdirs(self.path(f"{to}/{key}").getParent())
                util.copy(other._fs, other.path(key), self._fs, self.path(f"{to}/{key}"), False, True, self.spark._jsc.hadoopConfiguration())
                n += 1
        return n


def publish(spark: SparkSession, built: str, root: str, day: str, now: datetime | None = None, dry_run: bool = False) -> list[str]:
    """Copy a build to its dated folder, mirror it to latest/, and renew the notice and the index. What was done."""
    source, store = Store(spark, built), Store(spark, root)
    if not source.exists():
        raise ValueError(f"no such folder: {built}")
    if not any(k.endswith(".parquet") and "_work" not in k.split("/") for k, *_ in source.files()):
        raise ValueError(f"no Parquet files in {built}")
    if not re.fullmatch(DATED.strip("^$"), day):
        raise ValueError(f"not a date: {day}")
    steps = [f"{built} -> {day}/", f"{day}/ -> latest/", "ATTRIBUTION.txt", "snapshots.json"]
    if dry_run:
        return steps
    store.copy(built, day, exclude=("_work",))
    # The mirror is made beside the old one and takes its place by a rename, so no file of the old one stays.
    store.delete("latest.new")
    store.copy(f"{store.root}/{day}", "latest.new")
    # Between the two renames latest/ is away for a moment; the old one goes after that.
    store.delete("latest.old")
    if store.exists("latest"):
        store.rename("latest", "latest.old")
    store.rename("latest.new", "latest")
    store.delete("latest.old")
    store.write_text("ATTRIBUTION.txt", ATTRIBUTION)
    store.write_text("snapshots.json", index(store.objects(), now))
    return steps


def cleanup(spark: SparkSession, built: str) -> None:
    """Removes the intermediate folder of a build."""
    Store(spark, built).delete("_work")


def prune(spark: SparkSession, root: str, now: date, execute: bool = False) -> DataFrame:
    """(name, day, verdict) of all dated folders; with execute those to delete go, and the index is renewed."""
    store = Store(spark, root)
    names = spark.createDataFrame([(x,) for x in store.folders()], "name string")
    plan = retention(names, F.lit(now))
    if execute:
        for r in plan.filter("verdict = 'delete'").collect():
            store.delete(r["name"])
        store.write_text("snapshots.json", index(store.objects()))
    return plan
