"""From map elements to features: region extracts, tag filters and geometry assembly, as joins and groups.

nodes (id, lon, lat, tags), ways (id, refs, tags), relations (id, members(type, ref, role), tags).
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrella.functions import geometry as G
from terrella.operators.spatial import clip_to_regions
from terrella.operators.themes import Theme, geometry_filter, tag_filter


def refs_of(ways: DataFrame) -> DataFrame:
    return ways.select(F.col("id").alias("way"), F.posexplode("refs").alias("pos", "ref"))


def located(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(way, pos, lon, lat): each reference that has a node; those without one are absent."""
    return refs_of(ways).join(nodes.select(F.col("id").alias("ref"), "lon", "lat"), "ref").select("way", "pos", "ref", "lon", "lat")


def way_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(way, refs, line): references and places of a way's nodes in order."""
    pts = F.array_sort(F.collect_list(F.struct("pos", "ref", "lon", "lat")))
    got = located(ways, nodes).groupBy("way").agg(pts.alias("p"))
    return got.select("way", F.transform("p", lambda p: p["ref"]).alias("refs"), F.transform("p", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("line"))


def extract(nodes: DataFrame, ways: DataFrame, relations: DataFrame, regions: DataFrame, strategy: str = "simple") -> dict[str, DataFrame]:
    """Elements by region, for all regions in one pass; regions: (iso, region_geometry, region_extent).

    simple: nodes inside, ways with a node inside, of which only the nodes inside; relations with such a member.
    complete_ways: the same ways, with all their nodes. The nodes inside are kept on the executors' disks, as each
    output reads them; what an executor takes with it is worked out again.
    """
    if strategy not in ("simple", "complete_ways"):
        raise ValueError(f"unknown strategy: {strategy}")
    inside = clip_to_regions(nodes, regions.select("iso", "region_geometry", "region_extent"), x="lon", y="lat").select("iso", *nodes.columns).persist(StorageLevel.DISK_ONLY)
    touching = refs_of(ways).join(inside.select("iso", F.col("id").alias("ref")), "ref").select("iso", F.col("way").alias("id")).distinct()
    kept_ways = touching.join(ways, "id").select("iso", *ways.columns)
    kept_nodes = inside
    if strategy == "complete_ways":
        wanted = kept_ways.select("iso", F.explode("refs").alias("id")).distinct()
        kept_nodes = inside.select("iso", "id").unionByName(wanted).distinct().join(nodes, "id").select("iso", *nodes.columns)
    members = relations.select(F.col("id").alias("relation"), F.explode("members").alias("m")).select("relation", F.col("m.type").alias("type"), F.col("m.ref").alias("id"))
    of = kept_ways.select("iso", F.lit("way").alias("type"), "id").unionByName(kept_nodes.select("iso", F.lit("node").alias("type"), "id"))
    kept_relations = members.join(of, ["type", "id"]).select("iso", F.col("relation").alias("id")).distinct().join(relations, "id").select("iso", *relations.columns)
    return {"nodes": kept_nodes, "ways": kept_ways, "relations": kept_relations}


def clipped_runs(ways: DataFrame, inside: DataFrame) -> DataFrame:
    """(iso, way, run, line): a way cut at the region's edge into runs of nodes inside; runs of one node drop.

    inside: (iso, id, lon, lat), the nodes of each region.
    """
    at = refs_of(ways).join(inside.select("iso", F.col("id").alias("ref"), "lon", "lat"), "ref")
    grouped = at.groupBy("iso", "way").agg(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("p"))
    # Neighbours in a run have positions that differ from their ranks by the same number.
    numbered = grouped.select("iso", "way", F.posexplode("p").alias("k", "q")).select("iso", "way", (F.col("q.pos") - F.col("k")).alias("run"), F.col("q.pos").alias("pos"), F.col("q.lon").alias("lon"), F.col("q.lat").alias("lat"))
    runs = numbered.groupBy("iso", "way", "run").agg(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("p"))
    return runs.filter(F.size("p") >= 2).select("iso", "way", "run", F.transform("p", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("line"))


def matching(elements: dict[str, DataFrame], theme: Theme, include_referenced: bool = False) -> dict[str, DataFrame]:
    """Elements that meet the theme's filter; if asked for, also those that they refer to."""
    kinds = {"nodes": "node", "ways": "way", "relations": "relation"}
    out = {n: df.filter(tag_filter(theme.filter, F.lit(kinds[n]), F.col("tags"))) for n, df in elements.items()}
    if include_referenced:
        members = out["relations"].select(F.explode("members").alias("m")).select("m.type", F.col("m.ref").alias("id"))
        ways = out["ways"].select("id").union(members.filter("type = 'way'").select("id")).distinct()
        out["ways"] = elements["ways"].join(ways, "id", "left_semi")
        nodes = out["nodes"].select("id").union(out["ways"].select(F.explode("refs"))).union(members.filter("type = 'node'").select("id")).distinct()
        out["nodes"] = elements["nodes"].join(nodes.toDF("id"), "id", "left_semi")
    return out


def stitch(lines: list[list[tuple[float, float]]]) -> tuple[list[list[tuple[float, float]]], int]:
    """(closed rings, lines left over) from lines that share end points, in any order and direction."""
    rings, open_lines = [], []
    for line in lines:
        (rings if len(line) > 3 and line[0] == line[-1] else open_lines).append(list(line))
    while open_lines:
        line = open_lines.pop()
        grown = True
        while grown and line[0] != line[-1]:
            grown = False
            for k, other in enumerate(open_lines):
                if other[0] == line[-1] or other[-1] == line[-1]:
                    line += other[1:] if other[0] == line[-1] else other[-2::-1]
                    del open_lines[k]
                    grown = True
                    break
        if len(line) > 3 and line[0] == line[-1]:
            rings.append(line)
        else:
            return rings, len(open_lines) + 1
    return rings, 0


def _area(ring) -> float:
    p = np.asarray(ring)
    return float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum() / 2)


def multipolygon(rings: list[tuple[str, list]]) -> bytes | None:
    """WKB from rings with roles: inner rings go to the smallest outer ring around them; without a role, nesting decides."""
    if not rings:
        return None
    sized = sorted(((abs(_area(r)), role, r) for role, r in rings), key=lambda x: -x[0])
    outers: list[list] = []
    for k, (_, role, ring) in enumerate(sized):
        around = [o for o in outers if G._side([np.asarray(o[0])], *np.asarray(ring[:1]).T)[0] >= 0]
        if (role == "inner" or (role == "" and around)) and around:
            around[-1].append(ring)
        elif role != "inner":
            outers.append([ring])
    if not outers:
        return None
    return G.to_wkb("Polygon", outers[0]) if len(outers) == 1 else G.to_wkb("MultiPolygon", outers)


def features(elements: dict[str, DataFrame]) -> DataFrame:
    """(osm_id, osm_type, tags, geometry_kind, geometry) of all tagged elements.

    A closed way is an area unless area=no, and a line too unless area=yes; a multipolygon or boundary relation
    is an area of its rings, and dropped if a ring doesn't close.
    """
    tagged = lambda df: df.filter(F.size("tags") > 0)
    nodes, ways, relations = elements["nodes"], elements["ways"], elements["relations"]
    points = tagged(nodes).select(F.col("id").alias("osm_id"), F.lit("node").alias("osm_type"), "tags", F.lit("point").alias("geometry_kind"), G.wkb_point("lon", "lat").alias("geometry"))

    @F.pandas_udf(T.BinaryType())
    def line(points: pd.Series) -> pd.Series:
        return points.map(lambda p: G.to_wkb("LineString", [(q["lon"], q["lat"]) for q in p]))

    @F.pandas_udf(T.BinaryType())
    def ring(points: pd.Series) -> pd.Series:
        return points.map(lambda p: G.to_wkb("Polygon", [[(q["lon"], q["lat"]) for q in p]]))

    lines = way_lines(ways, nodes).filter(F.size("line") >= 2)
    placed = tagged(ways).select(F.col("id").alias("way"), "tags").join(lines, "way")
    closed = (F.size("refs") > 3) & (F.element_at("refs", 1) == F.element_at("refs", -1))
    area = F.coalesce(F.col("tags")["area"], F.lit(""))
    open_ways = placed.filter(~(closed & (area == "yes"))).select(F.col("way").alias("osm_id"), F.lit("way").alias("osm_type"), "tags", F.lit("linestring").alias("geometry_kind"), line("line").alias("geometry"))
    areas = placed.filter(closed & (area != "no")).select(F.col("way").alias("osm_id"), F.lit("way").alias("osm_type"), "tags", F.lit("polygon").alias("geometry_kind"), ring("line").alias("geometry"))

    kinds = tagged(relations).filter(F.col("tags")["type"].isin("multipolygon", "boundary"))
    members = kinds.select(F.col("id").alias("relation"), F.posexplode("members").alias("k", "m")).filter("m.type = 'way'").select("relation", "k", F.col("m.ref").alias("way"), F.col("m.role").alias("role"))
    with_lines = members.join(lines.select("way", "line"), "way", "left").groupBy("relation").agg(F.array_sort(F.collect_list(F.struct("k", "role", "line"))).alias("parts"))

    @F.pandas_udf(T.BinaryType())
    def assembled(parts: pd.Series) -> pd.Series:
        def one(ps):
            rings = []
            by_role: dict[str, list] = {}
            for p in ps:
                if p["line"] is None:
                    return None
                by_role.setdefault(p["role"] if p["role"] in ("outer", "inner") else "", []).append([(q["lon"], q["lat"]) for q in p["line"]])
            for role, got in by_role.items():
                closed_rings, left = stitch(got)
                if left:
                    return None
                rings += [(role, r) for r in closed_rings]
            return multipolygon(rings)

        return parts.map(one)

    whole = kinds.select(F.col("id").alias("relation"), "tags").join(with_lines, "relation").select(F.col("relation").alias("osm_id"), F.lit("relation").alias("osm_type"), "tags", F.lit("polygon").alias("geometry_kind"), assembled("parts").alias("geometry"))
    return points.unionByName(open_ways).unionByName(areas).unionByName(whole.filter("geometry is not null"))


def theme_features(elements: dict[str, DataFrame], theme: Theme, include_referenced: bool = False) -> DataFrame:
    """Features of a theme, of the geometry kinds that it wants. Elements are assembled in full before the filter,
    as ways of a relation need no tags of their own."""
    found = features(elements).filter(geometry_filter(theme, F.col("geometry_kind")))
    if include_referenced:
        kept = matching(elements, theme, True)
        ids = None
        for name, df in kept.items():
            part = df.select(F.col("id").alias("osm_id"), F.lit(name[:-1]).alias("osm_type"))
            ids = part if ids is None else ids.unionByName(part)
        return found.join(ids, ["osm_id", "osm_type"], "left_semi")
    return found.filter(tag_filter(theme.filter, F.col("osm_type"), F.col("tags")))


__all__ = ["clipped_runs", "extract", "features", "located", "matching", "multipolygon", "stitch", "theme_features", "way_lines"]
