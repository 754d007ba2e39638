"""Column functions: tags, text, geometry."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrella.functions import geometry as G
from terrella.functions import tags as T
from terrella.functions import text as X


def column(spark, values, f, kind="string"):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in d.select("i", f(F.col("v"))).orderBy("i").collect()]


def test_numbers(spark):
    ints = {"3": 3, "3.5": 4, "2.5": 3, "-3.5": -4, " 3 ": 3, "3;4": None, "1e3": 1000, "": None, "+5": 5, "0x10": 16, "3,000": None, "12 m": None, "inf": None, "99999999999": None, "1_000": 1000, ".5": 1, "5.": 5, "3f": None, "true": None, None: None, "_1": None, "1__0": None, "-0x10": None, "0X1F": 31, "2147483647.4": 2147483647, "2147483647.5": None, "1e40": None, "0xFFFFFFFFFF": None}
    assert column(spark, list(ints), T.to_int) == list(ints.values())
    doubles = {"3": 3.0, "1_000": 1000.0, "3f": None, "3d": None, "0x10": None, "1e400": math.inf, "inf": math.inf, "x": None, "-0.4": -0.4, " 3 ": 3.0}
    assert column(spark, list(doubles), T.to_double) == list(doubles.values())


def test_tag_map(spark):
    got = column(spark, ['{"a":"x","b":1,"c":{"d":2},"e":null,"f":true}', "{}", None, "[1]", '{"a":"1","a":"2"}'], T.tag_map)
    assert got == [{"a": "x", "b": "1", "c": '{"d":2}', "e": None, "f": "true"}, {}, None, None, {"a": "2"}]


def test_sizes(spark):
    assert column(spark, ["1.5 GiB", "10 B", "5 kB", "3 iB", "2 MB", "junk", None, "1.2.3 MB"], X.parse_size) == [1610612736, 10, 0, 3, 2000000, 0, 0, 0]
    assert column(spark, ["3 KiB / 1 MiB, 2%", "x"], X.parse_progress) == [(3072, 1048576), None]
    assert column(spark, [0, 1023, 1024, 1280, 1048576, 1073741824], X.format_bytes, "long") == ["0 B", "1023 B", "1.0 KiB", "1.3 KiB", "1.0 MiB", "1.00 GiB"]



def test_escapes_and_codec(spark):
    assert column(spark, ["a&b<c>\"d'"], X.escape_xml) == ["a&amp;b&lt;c&gt;&quot;d&apos;"]
    assert column(spark, ["'&amp;"], X.escape_html) == ["&#39;&amp;amp;"]
    assert column(spark, ["a b+c/é!~'()*"], X.encode_component) == ["a%20b%2Bc%2F%C3%A9!~'()*"]
    assert column(spark, ["a%20b+c"], X.decode_component) == ["a b+c"]


def test_ranges(spark):
    got = column(spark, ["bytes=0-9", "bytes=5-", "bytes=-7", "bytes=-", "bytes=9-5", "bytes=0-1,3-4", "junk", None, " bytes=1-2 ", "bytes=-500"], lambda c: X.range_bounds(X.parse_range(c), F.lit(100)))
    assert got == [(0, 10), (5, 95), (93, 7), None, (9, -3), None, None, None, (1, 2), (0, 100)]


def test_paths(spark):
    assert column(spark, ["US-NY", "MX", ""], X.iso_prefix) == ["US", "MX", ""]
    assert column(spark, ["a/b/c.parquet", "a/", "a", ""], X.parent_of) == ["a/b/", "", "", ""]
    assert column(spark, ["a//b/"], X.parts_of) == [["a", "b"]]
    assert column(spark, ["2024-01-02", "2024-1-2", "2024-13-99", "latest"], X.is_dated) == [True, False, True, False]


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
HOLE = [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]


def test_wkb_round_trip():
    for kind, coords in (("Point", (1.5, -2)), ("LineString", SQUARE[:3]), ("Polygon", [SQUARE, HOLE]), ("MultiPoint", [(1, 2), (3, 4)]), ("MultiLineString", [SQUARE[:2], HOLE[:3]]), ("MultiPolygon", [[SQUARE, HOLE], [SQUARE]])):
        data = G.geojson_wkb(json.dumps({"type": kind, "coordinates": coords}))
        back = G.from_wkb(data)
        assert back[0] == kind
        flat = np.array([p for p in np.array(G.flat(data))])
        assert G.bounds(data) == (*flat.min(axis=0), *flat.max(axis=0))
    for bad in (None, "", "null", "{}", '{"type":"Point"}', '{"type":"Point","coordinates":[]}', "x"):
        assert G.geojson_wkb(bad) is None


def test_contains_excludes_boundary():
    g = G.to_wkb("Polygon", [SQUARE, HOLE])
    x = np.array([1, 0, 10, 5, 4, 11, 5, 0])
    y = np.array([1, 5, 10, 5, 5, 5, 0, 0])
    assert G.contains_points(g, x, y).tolist() == [True, False, False, False, False, False, False, False]


def test_intersects_box():
    g = G.to_wkb("Polygon", [SQUARE, HOLE])
    assert G.intersects_box(g, 10, 10, 12, 12) and G.intersects_box(g, 1, 1, 2, 2) and G.intersects_box(g, -5, -5, 20, 20)
    assert not G.intersects_box(g, 4.5, 4.5, 5.5, 5.5) and not G.intersects_box(g, 11, 0, 12, 1)
    line = G.to_wkb("LineString", [(0, 0), (10, 10)])
    assert G.intersects_box(line, 4, 4, 5, 5) and G.intersects_box(line, 2, 3, 4, 3.5) and not G.intersects_box(line, 6, 0, 9, 3)
    assert G.intersects_box(G.to_wkb("Point", (1, 1)), 1, 1, 2, 2)


def test_distance():
    assert G.distance(G.to_wkb("Point", (3, 4)), 0, 0) == 5
    assert G.distance(G.to_wkb("LineString", [(0, 1), (10, 1)]), 5, 0) == 1
    assert G.distance(G.to_wkb("Polygon", [SQUARE]), 5, 5) == 0 and G.distance(G.to_wkb("Polygon", [SQUARE]), 13, 14) == 5


def test_outward_box_holds_geometry(spark):
    v = [0.0, 180.0, -180.0, 90.0, -90.0, 1e-12, -73.9857, 40.7484, 0.1, -0.3]
    d = spark.createDataFrame([(a, b) for a in v for b in v], "x double, y double")
    e = F.struct(F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax"))
    for r in d.select("x", "y", G.outward_box(e).alias("b")).collect():
        assert r.b.xmin <= r.x <= r.b.xmax and r.b.ymin <= r.y <= r.b.ymax
        assert r.b.xmax - r.b.xmin < 1e-3


def test_hilbert_is_a_walk():
    n = 32
    x, y = (a.ravel() for a in np.meshgrid(np.arange(n), np.arange(n)))
    at = G.hilbert_index(x, y, 5)
    order = np.argsort(at)
    assert sorted(at.tolist()) == list(range(n * n))
    assert (np.abs(np.diff(x[order])) + np.abs(np.diff(y[order])) == 1).all()
