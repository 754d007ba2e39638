"""Sources and sinks: feature lines, regions, theme trees, the element format, a stream."""

import json
import struct
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terrella.operators import manifests, spatial, themes
from terrella.sources import geojson, pbf, tables
from terrella.streaming import ingest


def line(i, kind, coords, **tags):
    return json.dumps({"type": "Feature", "id": i, "properties": tags, "geometry": kind and {"type": kind, "coordinates": coords}})


@pytest.fixture
def lines(tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    rows = [line(1, "Polygon", [ring], building="house", name="A", height="3.5", **{"building:levels": "2"}), line("x", "Polygon", [[[c[0] + 5, c[1]] for c in ring]], building="hut"), line(3, None, None, building="gone"), line(4, "Point", [2, 3], amenity="cafe", cuisine={"a": 1}), line(5, "MultiPolygon", [[ring]], building="yes")]
    p = tmp_path / "f.jsonl"
    p.write_text("\n".join(rows))
    return str(p)


def test_lines(spark, lines, tmp_path):
    got = {r.osm_id: r for r in geojson.features(geojson.read_lines(spark, lines)).collect()}
    assert set(got) == {1, None, 4, 5} and got[4].tags == {"amenity": "cafe", "cuisine": '{"a":1}'}
    assert got[1].osm_type == "Feature" and got[5].geometry_kind == "MultiPolygon" and got[1].extent.xmax == 1.0
    (tmp_path / "empty.jsonl").write_text("")
    assert geojson.read_lines(spark, str(tmp_path / "empty.jsonl"), str(tmp_path / "none.jsonl")).count() == 0
    assert geojson.read_lines(spark, str(tmp_path / "none.jsonl")).count() == 0


def collection(tmp_path, features, kind="FeatureCollection"):
    p = tmp_path / "regions.json"
    p.write_text(json.dumps({"type": kind, "features": features}))
    return str(p)


def region(iso, name, x=0):
    return {"type": "Feature", "properties": {"ISO3166-2": iso, "name": name}, "geometry": {"type": "Polygon", "coordinates": [[[x, 0], [x + 4, 0], [x + 4, 4], [x, 4], [x, 0]]]}}


def test_regions(spark, tmp_path):
    good = [region("US-NY", "New York"), region("CA-ON", "Ontario", 4), region(None, "x"), region("US-XX", ""), {"type": "Feature", "properties": None, "geometry": None}]
    got = geojson.regions(spark, collection(tmp_path, good)).collect()
    assert sorted((r.iso, r["name"], r.country) for r in got) == [("CA-ON", "Ontario", "CA"), ("US-NY", "New York", "US")]
    for bad, kind in (([region("A-1", "a"), region("A-1", "b")], "FeatureCollection"), ([region("", "a")], "FeatureCollection"), (good, "Feature")):
        with pytest.raises(ValueError):
            geojson.regions(spark, collection(tmp_path, bad, kind)).collect()


def located(spark, lines):
    f = geojson.features(geojson.read_lines(spark, lines))
    return f.withColumns({"country": F.lit("US"), "state": F.when(F.coalesce("osm_id", F.lit(0)) < 4, "New York").otherwise("Ohio"), "state_iso": F.when(F.coalesce("osm_id", F.lit(0)) < 4, "US-NY").otherwise("US-OH")})


def test_tree(spark, lines, tmp_path):
    root = str(tmp_path / "tree")
    counts = {(r.state_iso, r.theme): r.n for r in tables.build(located(spark, lines).withColumn("kind", F.when(F.col("geometry_kind") == "Point", "node").otherwise("way")), root, ["buildings", "pois", "roads"], "x.pbf", "kind").collect()}
    assert counts == {("US-NY", "buildings"): 2, ("US-OH", "buildings"): 1, ("US-NY", "pois"): 0, ("US-OH", "pois"): 1, ("US-NY", "roads"): 0, ("US-OH", "roads"): 0}
    b = tables.read_theme(spark, root, "buildings")
    assert sorted((r.state, r.state_iso, r.building, r.levels, r.height) for r in b.collect()) == [("New York", "US-NY", "house", 2, 3.5), ("New York", "US-NY", "hut", None, None), ("Ohio", "US-OH", "yes", None, None)]
    assert tables.read_theme(spark, root, "buildings", ["US-OH", "US-ZZ"]).count() == 1 and tables.read_theme(spark, root, "water").count() == 0
    path = tables.url(root, "US-NY", "buildings")
    f = pq.ParquetFile(path)
    assert json.loads(f.schema_arrow.metadata[b"geo"])["version"] == "2.0.0" and "Geometry" in str(f.schema)
    assert spatial.within_envelope(b, 4.9, 0, 5.5, 0.5).count() == 1
    expected = spark.createDataFrame([("US-NY",), ("US-OH",)], "iso string")
    checks = {r.check: r for r in manifests.check_tree(spark, root, expected, ["buildings", "pois", "roads"]).collect()}
    assert all(r.passed for r in checks.values()), checks
    more = spark.createDataFrame([("US-NY",), ("US-OH",), ("US-TX",)], "iso string")
    found = {r.check: r.detail for r in manifests.check_tree(spark, root, more).collect() if not r.passed}
    assert found == {"every region has a manifest": "US-TX", "every manifest lists the themes": "US-NY, US-OH"}
    from terrella.operators.snapshots import Store

    store, name = Store(spark, root), "country=US/state=US-NY/_manifest.json"
    store.write_text(name, store.read_text(name).replace('"buildings": 2', '"buildings": 3').replace('"pois": 0', '"pois": 9').replace('"roads": 0', '"roads": -1'))
    failed = manifests.check_tree(spark, root, expected, ["buildings", "pois", "roads"])
    assert {r.check: r.detail for r in failed.collect() if not r.passed} == {"every theme was built": "US-NY/roads", "every listed file is there": "US-NY/pois", "row counts match": "US-NY/buildings"}
    assert tuple(manifests.totals(failed).first()) == (3, 3)
    # A theme that is empty now leaves no older file.
    tables.build(located(spark, lines).filter("osm_id = 4"), root, ["buildings"], "x.pbf")
    assert tables.read_theme(spark, root, "buildings", ["US-OH"]).count() == 0


def test_row_groups_and_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "GROUP_ROWS", 50_000)
    n = 60_000
    d = spark.range(n).select(F.col("id").alias("osm_id"), F.lit("node").alias("osm_type"), F.lit("US").alias("country"), F.lit("Here").alias("state"), F.lit("US-HE").alias("state_iso"), F.create_map(F.lit("place"), F.lit("x")).alias("tags"), (F.rand(1) * 10).alias("x"), (F.rand(2) * 10).alias("y"))
    from terrella.functions import geometry as G

    d = d.withColumn("geometry", G.wkb_point("x", "y")).withColumn("extent", F.struct(F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax")))
    rows = themes.theme_rows(d, themes.THEMES["places"])
    assert tables.write_tree(rows, themes.THEMES["places"], str(tmp_path / "t")).first().n == n
    f = pq.ParquetFile(tables.url(str(tmp_path / "t"), "US-HE", "places"))
    assert [f.metadata.row_group(i).num_rows for i in range(f.num_row_groups)] == [50_000, 10_000]
    tables.write_native(rows, themes.THEMES["places"], str(tmp_path / "n"))
    back = spark.read.schema(themes.THEMES["places"].schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "n"))
    assert back.count() == n and back.filter(spatial.box_overlaps(F.col("bbox"), 0, 0, 1, 1)).count() > 0
    plan = back.filter(spatial.box_overlaps(F.col("bbox"), 0, 0, 1, 1)).select("osm_id")._jdf.queryExecution().executedPlan().toString()
    assert "bbox.xmin" in plan and "PushedFilters: [" in plan


def test_url_function(spark):
    tables.register_url(spark, "/data/")
    assert spark.sql("SELECT url('US-NY', 'pois')").first()[0] == tables.url("/data", "US-NY", "pois") == "/data/country=US/state=US-NY/pois.parquet"


# ---- The element format, written by hand -----------------------------------------------------------------------------


def varint(x):
    out = b""
    while True:
        b, x = x & 0x7F, x >> 7
        out += bytes([b | (0x80 if x else 0)])
        if not x:
            return out


def field(n, value):
    return varint(n << 3) + varint(value) if isinstance(value, int) else varint(n << 3 | 2) + varint(len(value)) + value


def packed(xs, zigzag=False, delta=False):
    out, last = b"", 0
    for x in xs:
        v, last = (x - last if delta else x), x
        out += varint((v << 1) ^ (v >> 63) if zigzag else v)
    return out


def blob(kind, content, compress=True):
    body = field(2, len(content)) + field(3, zlib.compress(content)) if compress else field(1, content)
    head = field(1, kind) + field(3, len(body))
    return struct.pack(">I", len(head)) + head + body


def sample():
    strings = b"".join(field(1, s.encode()) for s in ["", "natural", "tree", "highway", "é", "outer", "type", "multipolygon"])
    dense = field(1, packed([10, 11, 9], True, True)) + field(8, packed([407484000, 0, -5], True, True)) + field(9, packed([-739857000, 5, 6], True, True)) + field(10, packed([1, 2, 0, 0, 0]))
    way = field(1, 7) + field(2, packed([3])) + field(3, packed([4])) + field(8, packed([10, 11, 9], True, True))
    relation = field(1, 8) + field(2, packed([6])) + field(3, packed([7])) + field(8, packed([5])) + field(9, packed([7], True, True)) + field(10, packed([1]))
    one = field(1, strings) + field(2, field(2, dense)) + field(2, field(3, way) + field(4, relation))
    node = field(1, 40) + field(2, packed([1])) + field(3, packed([2])) + field(8, 200) + field(9, 401)
    two = field(1, strings) + field(2, field(1, node)) + field(17, 1000)
    return blob(b"OSMHeader", b"") + blob(b"OSMData", one) + blob(b"OSMData", two, compress=False)


def test_pbf(spark, tmp_path):
    p = tmp_path / "x.osm.pbf"
    p.write_bytes(sample())
    e = pbf.read_elements(spark, str(p))
    nodes = {r.id: (r.lon, r.lat, r.tags) for r in e["nodes"].collect()}
    assert nodes[10] == (-73.9857, 40.7484, {"natural": "tree"}) and nodes[9] == (6e-7, -5e-7, {}) and nodes[20] == (-0.000201, 0.0001, {"natural": "tree"})
    w, r = e["ways"].first(), e["relations"].first()
    assert (w.id, w.refs, w.tags) == (7, [10, 11, 9], {"highway": "é"})
    assert (r.id, [tuple(m) for m in r.members], r.tags) == (8, [("way", 7, "outer")], {"type": "multipolygon"})
    assert len(pbf.blob_index(str(p))) == 2


def test_stream(spark, lines, tmp_path):
    import shutil

    folder = tmp_path / "in"
    folder.mkdir()
    shutil.copy(lines, folder / "a.json")
    run = lambda: ingest.append(ingest.theme_stream(spark, str(folder), "buildings", "US-NY", "New York"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    run()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.building for r in back.collect()) == ["house", "hut", "yes"] and back.columns[:5] == list(themes.BASE_FIRST)
