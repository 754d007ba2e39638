"""Listings of object keys: pages, common prefixes, orders, and the text of a page. Keys: (key, size, uploaded, etag)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.functions import text as X

#: Keys of a page and pages of a walk, at most.
PAGE, PAGES = 1000, 50


def under(objects: DataFrame, prefix: str) -> DataFrame:
    """Objects whose key starts with a prefix, with what follows it."""
    return objects.filter(F.col("key").startswith(prefix)).withColumn("rest", F.substring(F.col("key"), len(prefix) + 1, 2**31 - 1))


def common_prefixes(objects: DataFrame, prefix: str = "", delimiter: str = "/") -> DataFrame:
    """(prefix): each distinct next step below a prefix."""
    rest = under(objects, prefix).filter(F.col("rest").contains(delimiter))
    return rest.select(F.concat(F.lit(prefix), F.substring_index("rest", delimiter, 1), F.lit(delimiter)).alias("prefix")).distinct()


def entries(objects: DataFrame, prefix: str = "", delimiter: str | None = None) -> DataFrame:
    """What a listing walks, by name: (name, is_prefix, size, uploaded, etag)."""
    got = under(objects, prefix)
    none = [F.lit(None).cast(objects.schema[c].dataType).alias(c) for c in ("size", "uploaded", "etag")]
    if not delimiter:
        return got.select(F.col("key").alias("name"), F.lit(False).alias("is_prefix"), "size", "uploaded", "etag")
    files = got.filter(~F.col("rest").contains(delimiter)).select(F.col("key").alias("name"), F.lit(False).alias("is_prefix"), "size", "uploaded", "etag")
    return files.unionByName(common_prefixes(objects, prefix, delimiter).select(F.col("prefix").alias("name"), F.lit(True).alias("is_prefix"), *none))


@dataclass
class Page:
    """rows: the page by name; truncated: there is more; next: where to go on."""

    rows: DataFrame
    truncated: bool
    next: str | None


def list_objects(objects: DataFrame, prefix: str = "", delimiter: str | None = None, token: str | None = None, start_after: str | None = None, max_keys: int = PAGE) -> Page:
    """One page of a listing. start_after counts only without a token; more than PAGE keys aren't given."""
    if not isinstance(max_keys, int) or max_keys < 0:
        raise ValueError("max_keys is a whole number, 0 or more")
    n = min(max_keys, PAGE)
    after = token or start_after
    found = entries(objects, prefix, delimiter)
    if after:
        found = found.filter(F.col("name") > after)
    # One row more than asked for tells whether there is more; a page is at most PAGE rows.
    names = [r["name"] for r in found.select("name").orderBy("name").limit(n + 1).collect()]
    more = len(names) > n
    rows = found.orderBy("name").limit(n)
    return Page(rows, more and n > 0, names[n - 1] if more and n else None)


def page_counts(page: Page) -> DataFrame:
    """(objects, prefixes, key_count)."""
    n = F.sum(F.when(F.col("is_prefix"), 0).otherwise(1))
    return page.rows.agg(F.coalesce(n, F.lit(0)).alias("objects"), F.coalesce(F.sum(F.col("is_prefix").cast("long")), F.lit(0)).alias("prefixes"), F.count("*").alias("key_count"))


def folder_order(name: Column) -> list[Column]:
    """latest/ first, dated folders newest first, others from A to Z (by code point)."""
    dated = name.rlike(r"^\d{4}-\d{2}-\d{2}/$")
    rank = F.when(name == "latest/", 0).when(dated, 1).otherwise(2)
    return [rank.asc(), F.when(dated, name).desc_nulls_last(), name.asc()]


def walk(objects: DataFrame, prefix: str = "", page: int = PAGE, pages: int = PAGES) -> tuple[DataFrame, bool]:
    """All that up to so many pages hold, and whether that was cut: one scan, as the cap is a count of rows."""
    found = entries(objects, prefix, "/")
    cap = page * pages
    return found.orderBy("name").limit(cap), found.limit(cap + 1).count() > cap


def list_xml(page: Page, bucket: str, prefix: str = "", delimiter: str | None = None, token: str | None = None, start_after: str | None = None, max_keys: int = PAGE) -> str:
    """The page as the XML that object stores give; the page is bounded, so the driver builds the text."""

    def element(name: str, value) -> str:
        return f"<{name}>{value}</{name}>"

    escaped = page.rows.select("is_prefix", X.escape_xml(F.col("name")).alias("name"), "size", X.escape_xml(F.col("etag")).alias("etag"), F.date_format("uploaded", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("at"), F.col("name").alias("raw")).orderBy("raw").collect()
    said = dict(zip(("prefix", "delimiter", "token", "next", "after"), page.rows.sparkSession.range(1).select(*[X.escape_xml(F.lit(v)) for v in (prefix, delimiter, token, page.next, start_after)]).first()))
    head = [("Name", bucket), ("Prefix", said["prefix"]), ("Delimiter", said["delimiter"]), ("MaxKeys", min(max_keys, PAGE)), ("KeyCount", len(escaped)), ("IsTruncated", str(page.truncated).lower()), ("ContinuationToken", said["token"]), ("NextContinuationToken", said["next"]), ("StartAfter", said["after"])]
    body = [element(k, v) for k, v in head if k == "Prefix" or v not in (None, "")]
    body += [element("Contents", element("Key", r["name"]) + element("LastModified", r["at"]) + element("ETag", r["etag"]) + element("Size", r["size"]) + element("StorageClass", "STANDARD")) for r in escaped if not r["is_prefix"]]
    body += [element("CommonPrefixes", element("Prefix", r["name"])) for r in escaped if r["is_prefix"]]
    return '<?xml version="1.0" encoding="UTF-8"?><ListBucketResult xmlns="http://s3.amazonaws.com/doc/2006-03-01/">' + "".join(body) + "</ListBucketResult>"


def read_status(objects: DataFrame, requests: DataFrame) -> DataFrame:
    """requests: (key, range, if_none_match). The answer to each: status, offset and length of the body."""
    joined = requests.join(objects, "key", "left")
    bounds = X.range_bounds(X.parse_range(F.col("range")), F.col("size"))
    status = F.when(F.col("etag").isNull(), 404).when(F.col("if_none_match") == F.col("etag"), 304).when(bounds.isNull(), 200).when((bounds["length"] < 1) | (bounds["offset"] >= F.col("size")), 416).otherwise(206)
    found = joined.withColumn("status", status)
    return found.select("key", "range", "status", F.when(F.col("status") == 206, bounds["offset"]).when(F.col("status") == 200, 0).alias("offset"), F.when(F.col("status") == 206, F.least(bounds["length"], F.col("size") - bounds["offset"])).when(F.col("status") == 200, F.col("size")).alias("length"))
