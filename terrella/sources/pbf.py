"""Map elements from the protocol-buffer format, as a Spark data source: spark.read.format("osm_pbf").load(path).

A file is a run of blobs that decode alone. A pass over their headers finds where they are, and each partition
reads some of them. Rows: (kind, id, lon, lat, refs, members, tags).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "kind string, id bigint, lon double, lat double, refs array<bigint>, members array<struct<type:string,ref:bigint,role:string>>, tags map<string,string>"

#: Blobs of a partition.
BLOBS = 16


def _varint(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = data[at]
        at += 1
        out |= (b & 0x7F) << shift
        if b < 0x80:
            return out, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields: numbers or bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        yield key >> 3, value


def _zigzag(x: int) -> int:
    return (x >> 1) ^ -(x & 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _packed(data: bytes, zigzag: bool = False, delta: bool = False) -> list[int]:
    out, at, total = [], 0, 0
    while at < len(data):
        x, at = _varint(data, at)
        x = _zigzag(x) if zigzag else x
        total = total + x if delta else x
        out.append(total)
    return out


def blob_index(path: str) -> list[tuple[int, int]]:
    """(place, size) of each data blob."""
    out = []
    with open(path, "rb") as f:
        while head := f.read(4):
            header = dict(fields(f.read(struct.unpack(">I", head)[0])))
            size = header[3]
            if header[1] == b"OSMData":
                out.append((f.tell(), size))
            f.seek(size, 1)
    return out


def _content(blob: bytes) -> bytes:
    got = dict(fields(blob))
    if 1 in got:
        return got[1]
    if 3 in got:
        return zlib.decompress(got[3])
    raise ValueError("only plain and zlib blobs are read")


def decode(blob: bytes) -> Iterator[tuple]:
    """The elements of a blob."""
    strings, groups = [], []
    granularity, lat0, lon0 = 100, 0, 0
    for k, v in fields(_content(blob)):
        if k == 1:
            strings = [s.decode("utf-8", "replace") for _, s in fields(v)]
        elif k == 2:
            groups.append(v)
        elif k == 17:
            granularity = v
        elif k == 19:
            lat0 = _signed(v)
        elif k == 20:
            lon0 = _signed(v)

    def place(lon: int, lat: int) -> tuple[float, float]:
        return round((lon0 + granularity * lon) * 1e-9, 9), round((lat0 + granularity * lat) * 1e-9, 9)

    for group in groups:
        for k, v in fields(group):
            if k == 2:
                got = dict(fields(v))
                ids, lats, lons = (_packed(got.get(n, b""), True, True) for n in (1, 8, 9))
                keys, at = _packed(got.get(10, b"")), 0
                for i, lat, lon in zip(ids, lats, lons):
                    tags = {}
                    while at < len(keys) and keys[at]:
                        tags[strings[keys[at]]] = strings[keys[at + 1]]
                        at += 2
                    at += 1
                    yield ("node", i, *place(lon, lat), None, None, tags)
                continue
            got = dict(fields(v))
            tags = dict(zip([strings[x] for x in _packed(got.get(2, b""))], [strings[x] for x in _packed(got.get(3, b""))]))
            if k == 1:
                yield ("node", _zigzag(got[1]), *place(_zigzag(got[9]), _zigzag(got[8])), None, None, tags)
            elif k == 3:
                yield ("way", got[1], None, None, _packed(got.get(8, b""), True, True), None, tags)
            elif k == 4:
                kinds = ("node", "way", "relation")
                members = [(kinds[t], r, strings[s]) for s, r, t in zip(_packed(got.get(8, b"")), _packed(got.get(9, b""), True, True), _packed(got.get(10, b"")))]
                yield ("relation", got[1], None, None, None, members, tags)


class _Blobs(InputPartition):
    def __init__(self, path: str, blobs: list[tuple[int, int]]):
        self.path, self.blobs = path, blobs


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        found = blob_index(self.path)
        return [_Blobs(self.path, found[i : i + BLOBS]) for i in range(0, len(found), BLOBS)] or [_Blobs(self.path, [])]

    def read(self, partition):
        with open(partition.path, "rb") as f:
            for at, size in partition.blobs:
                f.seek(at)
                yield from decode(f.read(size))


class PbfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def read_elements(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """nodes, ways and relations of a file that every executor sees at path."""
    spark.dataSource.register(PbfSource)
    rows = spark.read.format("osm_pbf").load(path)
    return {
        "nodes": rows.filter("kind = 'node'").select("id", "lon", "lat", "tags"),
        "ways": rows.filter("kind = 'way'").select("id", "refs", "tags"),
        "relations": rows.filter(F.col("kind") == "relation").select("id", "members", "tags"),
    }
