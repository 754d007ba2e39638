"""Themes, joins, element assembly, listings, snapshots."""

import json
import random
from datetime import date, datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrella.functions import geometry as G
from terrella.operators import elements as E
from terrella.operators import listing, manifests, snapshots, spatial, themes


def test_catalogue():
    t = themes.THEMES
    assert len(t) == 16 and sum(len(x.columns) for x in t.values()) == 115
    kinds = [c.kind for x in t.values() for c in x.columns]
    assert (kinds.count("string"), kinds.count("int"), kinds.count("double")) == (101, 8, 6)


def test_filter_language():
    assert themes.parse_filter("wr/natural=water n/railway=a,b") == [(("way", "relation"), "natural", ("water",)), (("node",), "railway", ("a", "b"))]


def test_choose():
    assert themes.choose(["power", "roads"], list(themes.THEMES), "themes") == ["roads", "power"]
    with pytest.raises(ValueError, match="nowhere"):
        themes.choose(["nowhere"], list(themes.THEMES), "themes")


def test_registered_theme(spark):
    themes.register_theme(themes.Theme("trees", "n/natural=tree", ("point",), (themes.TypedColumn("species", "species"),)))
    try:
        assert "species" in themes.THEMES["trees"].schema
    finally:
        del themes.THEMES["trees"]


def test_post_filter_reads_the_map(spark):
    d = spark.createDataFrame([({"natural": "water"},), ({"natural": "wood"},), ({},), ({"natural": None},)], "tags map<string,string>")
    assert [r[0] for r in d.select(themes.post_filter("natural_areas", F.col("tags"))).collect()] == [False, True, True, True]
    assert all(r[0] for r in d.select(themes.post_filter("roads", F.col("tags"))).collect())


def test_grid_join_equals_nested_loop(spark):
    r = random.Random(4)
    shapes = []
    for i in range(60):
        x, y, w = r.uniform(-170, 170), r.uniform(-80, 80), 10 ** r.uniform(-4, 2)
        ring = [(x + w * np.cos(a), y + w * np.sin(a)) for a in np.linspace(0, 2 * np.pi, 7)]
        shapes.append((i, G.to_wkb("Polygon", [[*ring[:-1], ring[0]]])))
    points = [(i, r.uniform(-180, 180), r.uniform(-90, 90)) for i in range(300)]
    p = spark.createDataFrame(shapes, "poly int, geometry binary").withColumn("extent", G.extent_of("geometry"))
    q = spark.createDataFrame(points, "pt int, x double, y double")
    got = {(r.poly, r.pt) for r in spatial.join_containing(p, q).collect()}
    want = {(i, k) for i, g in shapes for k, x, y in points if G.contains_points(g, np.array([x]), np.array([y]))[0]}
    assert got == want and want


def test_envelope_and_distance(spark):
    rows = [(i, G.to_wkb("LineString", [(i, 0), (i + 2, 2)])) for i in range(10)]
    d = spark.createDataFrame(rows, "i int, geometry binary").withColumn("extent", G.extent_of("geometry")).withColumn("bbox", G.outward_box(F.col("extent")))
    assert sorted(r.i for r in spatial.within_envelope(d, 3, 0, 4, 0.5).collect()) == [3, 4]
    assert sorted(r.i for r in spatial.near_point(d, 0, 0, 1.5).collect()) == [0, 1]


def some_elements(spark):
    nodes = [(i, float(i % 10), float(i // 10), {"natural": "tree"} if i == 77 else {}) for i in range(100)]
    ways = [(1, [11, 12, 13], {"highway": "primary"}), (2, [11, 13, 33, 31, 11], {"building": "yes"}), (3, [0, 9, 99], {}), (4, [99, 90, 0], {}), (5, [44, 45, 55, 54, 44], {}), (6, [11, 999, 13], {"highway": "x"}), (7, [22, 23, 33, 32, 22], {"highway": "y", "area": "no"})]
    relations = [(1, [("way", 3, "outer"), ("way", 4, "outer"), ("way", 5, "inner")], {"type": "multipolygon", "landuse": "forest"}), (2, [("way", 3, "outer")], {"type": "multipolygon", "landuse": "open"}), (3, [("way", 1, "")], {"type": "route"})]
    return {
        "nodes": spark.createDataFrame(nodes, "id long, lon double, lat double, tags map<string,string>"),
        "ways": spark.createDataFrame(ways, "id long, refs array<long>, tags map<string,string>"),
        "relations": spark.createDataFrame(relations, "id long, members array<struct<type:string,ref:long,role:string>>, tags map<string,string>"),
    }


def test_features(spark):
    got = {(r.osm_type, r.osm_id, r.geometry_kind): r.geometry for r in E.features(some_elements(spark)).collect()}
    assert set(got) == {("node", 77, "point"), ("way", 1, "linestring"), ("way", 2, "linestring"), ("way", 2, "polygon"), ("way", 6, "linestring"), ("way", 7, "linestring"), ("relation", 1, "polygon")}
    kind, rings = G.from_wkb(bytes(got["relation", 1, "polygon"]))
    assert kind == "Polygon" and len(rings) == 2 and len(rings[0]) == 5
    assert len(G.from_wkb(bytes(got["way", 6, "linestring"]))[1]) == 2


def test_theme_features(spark):
    e = some_elements(spark)
    assert [(r.osm_type, r.osm_id) for r in E.theme_features(e, themes.THEMES["landuse"]).collect()] == [("relation", 1)]
    assert [r.osm_id for r in E.theme_features(e, themes.THEMES["buildings"]).collect()] == [2]
    kept = E.matching(e, themes.THEMES["landuse"], include_referenced=True)
    assert {r.id for r in kept["ways"].collect()} == {3, 4, 5} and kept["nodes"].count() == 8


def test_stitch():
    rings, left = E.stitch([[(0, 0), (1, 0)], [(1, 1), (1, 0)], [(1, 1), (0, 0)], [(5, 5), (6, 5), (6, 6), (5, 5)]])
    assert left == 0 and len(rings) == 2 and all(r[0] == r[-1] for r in rings)
    assert E.stitch([[(0, 0), (1, 0)], [(1, 0), (2, 2)]])[1] == 2
    assert G.from_wkb(E.multipolygon([("", [(0, 0), (9, 0), (9, 9), (0, 0)]), ("", [(6, 1), (7, 1), (7, 2), (6, 1)]), ("outer", [(20, 0), (29, 0), (29, 9), (20, 0)])]))[0] == "MultiPolygon"


def test_extract(spark):
    e = some_elements(spark)
    box = G.to_wkb("Polygon", [[(0.5, 0.5), (2.5, 0.5), (2.5, 9.5), (0.5, 9.5), (0.5, 0.5)]])
    regions = spark.createDataFrame([("XX-1", box)], "iso string, region_geometry binary").withColumn("region_extent", G.extent_of("region_geometry"))
    simple = E.extract(e["nodes"], e["ways"], e["relations"], regions)
    assert {r.id for r in simple["ways"].collect()} == {1, 2, 6, 7} and simple["nodes"].count() == 18
    assert {r.id for r in simple["relations"].collect()} == {3}
    full = E.extract(e["nodes"], e["ways"], e["relations"], regions, "complete_ways")
    assert {r.id for r in full["nodes"].collect()} >= {13, 33, 23}
    runs = E.clipped_runs(e["ways"].filter("id in (1, 2)"), simple["nodes"]).collect()
    assert {(r.way, len(r.line)) for r in runs} == {(1, 2), (2, 2)}
    with pytest.raises(ValueError):
        E.extract(e["nodes"], e["ways"], e["relations"], regions, "smart")


def objects(spark):
    keys = ["a/x", "a/y/z", "b.txt", "c&d/1", "latest/q", "2024-01-02/r", "2024-03-04/s"]
    return spark.createDataFrame([(k, 10 * i, datetime(2024, 1, 1, 0, 0, i, tzinfo=timezone.utc), f'"{i}"') for i, k in enumerate(keys)], "key string, size long, uploaded timestamp, etag string")


def test_listing_pages(spark):
    o = objects(spark)
    names, token, pages = [], None, 0
    while True:
        page = listing.list_objects(o, delimiter="/", token=token, start_after="zzz" if token else None, max_keys=2)
        names += [r["name"] for r in page.rows.collect()]
        pages, token = pages + 1, page.next
        if not page.truncated:
            break
    assert names == ["2024-01-02/", "2024-03-04/", "a/", "b.txt", "c&d/", "latest/"] and pages == 3
    assert [r["name"] for r in listing.list_objects(o, prefix="a/", delimiter="/").rows.collect()] == ["a/x", "a/y/"]
    assert listing.list_objects(o, max_keys=5000).truncated is False
    for bad in (-1, "7"):
        with pytest.raises(ValueError):
            listing.list_objects(o, max_keys=bad)
    rows, cut = listing.walk(o, page=2, pages=2)
    assert cut and rows.count() == 4


def test_folder_order(spark):
    d = spark.createDataFrame([("b/",), ("2024-01-02/",), ("latest/",), ("a/",), ("2024-03-04/",)], "n string")
    assert [r.n for r in d.orderBy(*listing.folder_order(F.col("n"))).collect()] == ["latest/", "2024-03-04/", "2024-01-02/", "a/", "b/"]


def test_list_xml(spark):
    page = listing.list_objects(objects(spark), prefix="c&", delimiter="/")
    xml = listing.list_xml(page, "bucket", prefix="c&", delimiter="/")
    assert "<Prefix>c&amp;</Prefix><Delimiter>/</Delimiter><MaxKeys>1000</MaxKeys><KeyCount>1</KeyCount><IsTruncated>false</IsTruncated><CommonPrefixes><Prefix>c&amp;d/</Prefix></CommonPrefixes></ListBucketResult>" in xml
    one = listing.list_xml(listing.list_objects(objects(spark), prefix="b"), "bucket", prefix="b")
    assert "<Contents><Key>b.txt</Key><LastModified>2024-01-01T00:00:02.000Z</LastModified><ETag>&quot;2&quot;</ETag><Size>20</Size><StorageClass>STANDARD</StorageClass></Contents>" in one


def test_read_status(spark):
    asked = spark.createDataFrame([("b.txt", "bytes=5-9", None), ("b.txt", "bytes=-500", None), ("b.txt", None, '"2"'), ("no", None, None), ("b.txt", "bytes=9-5", None), ("b.txt", "junk", None)], "key string, range string, if_none_match string")
    got = {(r["range"], r.status): (r.offset, r.length) for r in listing.read_status(objects(spark), asked).collect()}
    assert got == {("bytes=5-9", 206): (5, 5), ("bytes=-500", 206): (0, 20), (None, 304): (None, None), (None, 404): (None, None), ("bytes=9-5", 416): (None, None), ("junk", 200): (0, 20)}


def test_retention(spark):
    now = date(2024, 6, 20)
    days = {"2024-06-21": "keep", "2024-06-06": "keep", "2024-06-05": "delete", "2023-07-01": "keep", "2023-06-01": "delete", "2022-12-31": "keep", "2000-12-31": "keep", "2024-13-01": "invalid", "2024-06-01": "keep"}
    got = snapshots.retention(spark.createDataFrame([(d,) for d in [*days, "latest", "2024-6-1"]], "name string"), F.lit(now))
    assert {r["name"]: r.verdict for r in got.collect()} == days


def test_publish_and_prune(spark, tmp_path):
    built, root = tmp_path / "built", tmp_path / "store"
    with pytest.raises(ValueError, match="no such"):
        snapshots.publish(spark, str(built), str(root), "2024-01-01")
    (built / "country=US/_work").mkdir(parents=True)
    (built / "country=US/_work/x.parquet").write_bytes(b"123")
    with pytest.raises(ValueError, match="no Parquet"):
        snapshots.publish(spark, str(built), str(root), "2024-01-01")
    (built / "country=US/roads.parquet").write_bytes(b"12345")
    (built / "country=US/_manifest.json").write_text("{}")
    with pytest.raises(ValueError, match="date"):
        snapshots.publish(spark, str(built), str(root), "2024-1-1")
    assert snapshots.publish(spark, str(built), str(root), "2024-01-05", dry_run=True) and not root.exists()
    at = datetime(2024, 1, 5, tzinfo=timezone.utc)
    snapshots.publish(spark, str(built), str(root), "2024-01-05", at)
    (built / "country=US/roads.parquet").unlink()
    (built / "country=US/water.parquet").write_bytes(b"1")
    snapshots.publish(spark, str(built), str(root), "2024-03-01", at)
    assert not (root / "latest/country=US/roads.parquet").exists() and (root / "latest/country=US/water.parquet").exists()
    assert "Open Database License" in (root / "ATTRIBUTION.txt").read_text()
    index = json.loads((root / "snapshots.json").read_text())
    assert index["generated_at"] == "2024-01-05T00:00:00+00:00"
    assert index["snapshots"] == [{"date": "2024-03-01", "path": "2024-03-01/", "objects": 2, "bytes": 3}, {"date": "2024-01-05", "path": "2024-01-05/", "objects": 2, "bytes": 7}]
    assert snapshots.Store(spark, str(built)).bytes() == 3
    plan = snapshots.prune(spark, str(root), date(2024, 4, 1))
    assert {r["name"]: r.verdict for r in plan.collect()} == {"2024-01-05": "delete", "2024-03-01": "keep"} and (root / "2024-01-05").exists()
    snapshots.prune(spark, str(root), date(2024, 4, 1), execute=True)
    assert not (root / "2024-01-05").exists() and len(json.loads((root / "snapshots.json").read_text())["snapshots"]) == 1


def test_manifest_values(spark):
    c = spark.createDataFrame([("US-NY", "New York", "roads", 5), ("US-NY", "New York", "water", -1), ("US-NY", "New York", "power", 0)], "state_iso string, state_name string, theme string, n long")
    r = manifests.manifests(c, "x.pbf", F.lit(2.25)).first()
    assert json.loads(r.manifest) == {"schema_version": "0.2.0", "country": "US", "state_iso": "US-NY", "state_name": "New York", "source_pbf": "x.pbf", "duration_s": 2.2, "total_features": 5, "themes": {"roads": 5, "water": -1, "power": 0}}


def test_expected_regions(spark):
    d = spark.createDataFrame([("US-NY",), ("US-GU",), ("CA-ON",), ("FR-A",), ("US-NY",), ("",), (None,), ("MX",)], "iso string")
    assert sorted(r.iso for r in manifests.expected_regions(d).collect()) == ["CA-ON", "MX", "US-NY"]


def test_header_policy(spark):
    d = spark.createDataFrame([("a", "public, immutable", "immutable", None), ("b", "max-age=300, immutable", "max-age", "immutable"), ("c", None, "x", None)], "object string, cache_control string, want string, forbid string")
    assert [r.passed for r in manifests.header_policy(d).orderBy("object").collect()] == [True, False, False]


def test_wide_polygons_by_cells_equal_the_whole_test(spark):
    """A star with a hole, two parts and a small square: each point by cells and by all rings."""
    import math
    import random

    from terrella.functions import geometry as G
    from terrella.operators import spatial

    r = random.Random(7)

    def star(cx, cy, size, n):
        ring = [(cx + size * (1 + 0.6 * (k % 2)) * math.cos(2 * math.pi * k / n), cy + size * (1 + 0.6 * (k % 2)) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        return [*ring, ring[0]]

    shapes = {1: G.to_wkb("Polygon", [star(0, 0, 5, 300), star(0.5, 0.2, 2, 40)]), 2: G.to_wkb("MultiPolygon", [[star(12, 3, 2, 12)], [star(-9, -4, 1, 7)]]), 3: G.to_wkb("Polygon", [[(1, 1), (1.25, 1), (1.25, 1.25), (1, 1.25), (1, 1)]]), 4: G.to_wkb("Polygon", [[(-8, -8), (8, -8), (8, 8), (-8, 8), (-8, -8)]])}
    points = [(i, r.uniform(-13, 16), r.uniform(-9, 9)) for i in range(3000)] + [(5000 + i, x, y) for i, (x, y) in enumerate([(-8.0, 0.0), (8.0, 8.0), (0.0, 0.0), (1.0, 1.1), (1.125, 1.125), (4.0, 4.0), (-8.0, -8.0), (0.0, -8.0)])]
    p = spark.createDataFrame([(k, bytearray(g), G.bounds(g)) for k, g in shapes.items()], "box_id int, geometry binary, extent struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    q = spark.createDataFrame(points, "point_id int, x double, y double")
    got = sorted((a.box_id, a.point_id) for a in spatial.join_containing(p, q).collect())
    x, y = np.array([a[1] for a in points]), np.array([a[2] for a in points])
    want = sorted((k, points[i][0]) for k, g in shapes.items() for i in np.flatnonzero(G.contains_points(g, x, y)))
    assert got == want and len({k for k, _ in want}) == 4
    plan = spatial.join_containing(p, q)._jdf.queryExecution().optimizedPlan().toString()
    assert "geometry" not in plan[: plan.index("Join")]
    cx, cy, edges = G.cover(shapes[4], 1.0, True)
    assert sum(e is None for e in edges) == 14 * 14 and max(len(e) for e in edges if e) <= 4 * 32


def test_boxes_join_without_edges_or_python_cells(spark):
    ring = [(0.0, 0.0), (6.0, 0.0), (6.0, 4.0), (0.0, 4.0)]
    turned = [[*r[k:], *r[:k], r[k]] for r in (ring, ring[::-1]) for k in range(4)]
    nan, inf = float("nan"), float("inf")
    others = [[(0, 0), (6, 0), (0, 4), (6, 4), (0, 0)], [(0, 0), (6, 0), (6, 4), (0, 0), (0, 0)], [(nan, 0), (6, 0), (6, 4), (nan, 4), (nan, 0)], [(0, 0), (inf, 0), (inf, 4), (0, 4), (0, 0)]]
    shapes = [G.to_wkb("Polygon", [r]) for r in [*turned, *others]]
    rows = [(k, bytearray(g), (0.0, 0.0, 6.0, 4.0)) for k, g in enumerate(shapes)] + [(50, None, (0.0, 0.0, 6.0, 4.0)), (51, bytearray(shapes[0]), (0.0, 0.0, 7.0, 4.0)), (52, bytearray(shapes[0]), None)]
    p = spark.createDataFrame(rows, "box_id int, geometry binary, extent struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    points = [(0, 1.0, 1.0), (1, 0.0, 2.0), (2, 6.0, 4.0), (3, 5.5, 3.9), (4, 3.0, 0.5), (5, nan, 1.0), (6, inf, 1.0), (7, None, 1.0), (8, -1.0, 1.0)]
    q = spark.createDataFrame(points, "point_id int, x double, y double")
    boxed = p.select("box_id", G.is_box("geometry", *[f"extent.{c}" for c in ("xmin", "ymin", "xmax", "ymax")]).alias("is"))
    assert sorted(r.box_id for r in boxed.filter("is").collect()) == list(range(8))
    got = sorted((a.box_id, a.point_id) for a in spatial.join_containing(p, q).collect())
    x, y = np.array([a[1] if a[1] is not None else nan for a in points]), np.array([a[2] for a in points])
    finite = [(k, g) for k, g in enumerate(shapes) if k < 10] + [(51, shapes[0])]
    assert got == sorted((k, i) for k, g in finite for i in np.flatnonzero(G.contains_points(g, x, y)))


def test_cells_of_polygons_are_never_broadcast(spark, tmp_path):
    """A few bytes of polygons may have any number of cells, salted at that: 500 boxes have over 20,000 here."""
    x, y = (F.randn(k) * w for k, w in ((1, 20), (2, 10)))
    spark.range(500).select("id", x.alias("x"), y.alias("y")).write.parquet(f"{tmp_path}/points")
    q = spark.read.parquet(f"{tmp_path}/points")
    corners = ("xmin", "ymin", "xmax", "ymax")
    p = q.select(F.col("id").alias("box_id"), F.struct(*[(F.col(c[0]) + (3 if "max" in c else -3)).alias(c) for c in corners]).alias("extent"))
    p = p.withColumn("geometry", G.wkb_box(*[f"extent.{c}" for c in corners]))
    pairs = spatial.join_containing(p, q).select("box_id", "id")
    plan = pairs._jdf.queryExecution()
    assert "BroadcastHashJoin" not in plan.executedPlan().toString()
    got = sorted(map(tuple, pairs.collect()))
    assert "BroadcastHashJoin" not in plan.executedPlan().toString()  # nor by the sizes found on the way
    at = [tuple(r) for r in q.collect()]
    assert got == sorted((b, i) for b, u, v in at for i, x, y in at if u - 3 < x < u + 3 and v - 3 < y < v + 3) and len(got) > 1000


def test_cells_leave_the_worker_in_bounded_batches(spark):
    ring = [(8 * np.cos(a), 8 * np.sin(a)) for a in np.linspace(0, 2 * np.pi, 200)]
    g = G.to_wkb("Polygon", [[*ring[:-1], ring[0]]])
    d = spark.createDataFrame([(k, bytearray(g), 0, True) for k in range(20)], "i int, geometry binary, level int, fine boolean").coalesce(1)
    cx, cy, edges = G.cover(g, 1.0, True)
    got = G.with_cells(d, "geometry", "level", "fine", ["cx", "cy", "edges"], 20_000).groupBy("cx", "cy", "edges").count().collect()
    key = lambda r: (r[0], r[1])
    assert sorted(((r.cx, r.cy, r.edges and bytes(r.edges), r["count"]) for r in got), key=key) == sorted(((a, b, e, 20) for a, b, e in zip(cx, cy, edges)), key=key)
    batches = list(G.cell_batches(iter(d.toArrow().to_batches()), "geometry", "level", "fine", ["cx", "cy", "edges"], 20_000))
    assert sum(b.num_rows for b in batches) == 20 * len(cx) and len(batches) > 20
    assert max(b.nbytes for b in batches) < 20_000 + 200 * 32 + 1_000
