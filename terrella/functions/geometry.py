"""Planar geometry on WKB: construction, bounds and predicates, as Arrow-fed functions.

A geometry is little-endian WKB of a point, line string, polygon or a collection of one of them. A point on a
polygon's boundary isn't contained; a touch counts as intersection.
"""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: WKB type numbers.
KINDS = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}
NAMES = {v: k for k, v in KINDS.items()}


def _points(coords) -> bytes:
    return b"".join(struct.pack("<2d", float(p[0]), float(p[1])) for p in coords)


def to_wkb(kind: str, coords) -> bytes:
    head = struct.pack("<BI", 1, KINDS[kind])
    if kind == "Point":
        return head + _points([coords])
    if kind == "LineString":
        return head + struct.pack("<I", len(coords)) + _points(coords)
    if kind == "Polygon":
        return head + struct.pack("<I", len(coords)) + b"".join(struct.pack("<I", len(r)) + _points(r) for r in coords)
    return head + struct.pack("<I", len(coords)) + b"".join(to_wkb(kind[5:], c) for c in coords)


def from_wkb(data: bytes) -> tuple[str, object]:
    """(kind, coordinates): rings and lines as n x 2 arrays."""

    def read(at: int):
        if data[at] != 1:
            raise ValueError("big-endian WKB isn't read")
        kind = NAMES[struct.unpack_from("<I", data, at + 1)[0] & 0xFF]
        at += 5

        def line(at: int):
            (n,) = struct.unpack_from("<I", data, at)
            return np.frombuffer(data, "<f8", 2 * n, at + 4).reshape(n, 2), at + 4 + 16 * n

        if kind == "Point":
            return kind, np.frombuffer(data, "<f8", 2, at), at + 16
        if kind == "LineString":
            x, at = line(at)
            return kind, x, at
        (n,) = struct.unpack_from("<I", data, at)
        at, parts = at + 4, []
        for _ in range(n):
            if kind == "Polygon":
                x, at = line(at)
            else:
                _, x, at = read(at)
            parts.append(x)
        return kind, parts, at

    return read(0)[:2]


def geojson_wkb(text: str | None) -> bytes | None:
    """WKB of a GeoJSON geometry; null for null, unreadable or empty ones."""
    try:
        g = json.loads(text) if text else None
        return to_wkb(g["type"], g["coordinates"]) if g and g.get("coordinates") else None
    except (KeyError, TypeError, ValueError, IndexError, struct.error):
        return None


def flat(data: bytes) -> np.ndarray:
    """All points of a geometry."""
    kind, x = from_wkb(data)

    def go(x):
        return [x.reshape(-1, 2)] if isinstance(x, np.ndarray) else [y for p in x for y in go(p)]

    return np.concatenate(go(x)) if len(x) else np.zeros((0, 2))


def bounds(data: bytes) -> tuple[float, float, float, float]:
    p = flat(data)
    return (*p.min(axis=0).tolist(), *p.max(axis=0).tolist())


def _polygons(data: bytes) -> list[list[np.ndarray]]:
    kind, x = from_wkb(data)
    return [x] if kind == "Polygon" else x if kind == "MultiPolygon" else []


def _segments(data: bytes) -> np.ndarray:
    """n x 4: the straight pieces of lines and rings."""
    kind, x = from_wkb(data)
    lines = {"LineString": lambda: [x], "MultiLineString": lambda: x, "Polygon": lambda: x, "MultiPolygon": lambda: [r for p in x for r in p]}.get(kind, lambda: [])()
    pieces = [np.hstack((r[:-1], r[1:])) for r in lines if len(r) > 1]
    return np.concatenate(pieces) if pieces else np.zeros((0, 4))


def _side(rings: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """1 inside, 0 on the boundary, -1 outside, by the even-odd rule over all rings."""
    inside, edge = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r[:-1], r[1:]):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            edge |= (cross == 0) & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))
            if y1 != y2:
                over = (y1 > y) != (y2 > y)
                inside ^= over & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return np.where(edge, 0, np.where(inside, 1, -1))


def side_of_edges(edges: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same for n x 4 edges at once; edges that end left of a point or miss its y may be left out."""
    out = np.empty(len(x), np.int64)
    x1, y1, x2, y2 = (edges[:, k][None, :] for k in range(4))
    for at in range(0, len(x), max(1, 1_000_000 // max(1, len(edges)))):
        to = at + max(1, 1_000_000 // max(1, len(edges)))
        px, py = x[at:to, None], y[at:to, None]
        on = ((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) == 0) & (np.minimum(x1, x2) <= px) & (px <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= py) & (py <= np.maximum(y1, y2))
        with np.errstate(divide="ignore", invalid="ignore"):
            over = ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)
        out[at:to] = np.where(on.any(axis=1), 0, np.where(over.sum(axis=1) % 2 == 1, 1, -1))
    return out


def cells(data: bytes, step: float, fine: bool) -> Iterator[tuple[int, int, bytes | None]]:
    """Cells of a grid that a polygon has points in, each with what decides there: null in cells that lie inside, else
    the edges at the cell's height and not left of it. Without fine, all cells of the polygon's box, with all edges. A
    polygon with a coordinate that is no finite number has no points."""
    e = _segments(data)
    if not len(e) or not np.isfinite(e).all():
        return
    low_x, high_x, low_y, high_y = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2]), np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    columns, rows = (range(math.floor(a.min() / step), math.floor(b.max() / step) + 1) for a, b in ((low_x, high_x), (low_y, high_y)))
    for r in rows:
        here = slice(None) if not fine else np.flatnonzero((high_y >= r * step) & (low_y <= (r + 1) * step))
        band = e[here]
        for c in columns:
            if fine and not _touches(band, c * step, r * step, (c + 1) * step, (r + 1) * step):
                if side_of_edges(band, np.array([(c + 0.5) * step]), np.array([(r + 0.5) * step]))[0] >= 0:
                    yield c, r, None
            else:
                yield c, r, (band[high_x[here] >= c * step] if fine else band).tobytes()


def cover(data: bytes, step: float, fine: bool) -> tuple[list[int], list[int], list[bytes | None]]:
    """cells() as three lists."""
    cx, cy, edges = zip(*found) if (found := list(cells(data, step, fine))) else ((), (), ())
    return list(cx), list(cy), list(edges)


def contains_points(data: bytes, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), bool)
    for p in _polygons(data):
        out |= _side(p, x, y) > 0
    return out


def _touches(s: np.ndarray, x1: float, y1: float, x2: float, y2: float) -> bool:
    """Whether an n x 4 piece shares a point with a box: each is clipped to it (Liang and Barsky)."""
    if not len(s):
        return False
    d = s[:, 2:] - s[:, :2]
    low, high = np.zeros(len(s)), np.ones(len(s))
    for axis, a, b in ((0, x1, x2), (1, y1, y2)):
        with np.errstate(divide="ignore", invalid="ignore"):
            t1, t2 = (a - s[:, axis]) / d[:, axis], (b - s[:, axis]) / d[:, axis]
        still = d[:, axis] == 0
        within = (s[:, axis] >= a) & (s[:, axis] <= b)
        low = np.where(still, np.where(within, low, 2.0), np.maximum(low, np.minimum(t1, t2)))
        high = np.where(still, high, np.minimum(high, np.maximum(t1, t2)))
    return bool((low <= high).any())


def intersects_box(data: bytes, x1: float, y1: float, x2: float, y2: float) -> bool:
    """Whether a geometry and a box share a point."""
    p = flat(data)
    if len(p) and ((p[:, 0] >= x1) & (p[:, 0] <= x2) & (p[:, 1] >= y1) & (p[:, 1] <= y2)).any():
        return True
    if _touches(_segments(data), x1, y1, x2, y2):
        return True
    return any(_side(g, np.array([x1]), np.array([y1]))[0] >= 0 for g in _polygons(data))


def distance(data: bytes, x: float, y: float) -> float:
    """The planar distance of a geometry to a point; 0 inside a polygon."""
    if any(_side(g, np.array([x]), np.array([y]))[0] >= 0 for g in _polygons(data)):
        return 0.0
    p = flat(data)
    best = np.hypot(p[:, 0] - x, p[:, 1] - y).min() if len(p) else math.inf
    s = _segments(data)
    if len(s):
        d = s[:, 2:] - s[:, :2]
        size = (d * d).sum(axis=1)
        t = np.clip(((x - s[:, 0]) * d[:, 0] + (y - s[:, 1]) * d[:, 1]) / np.where(size == 0, 1, size), 0, 1)
        best = min(best, np.hypot(s[:, 0] + t * d[:, 0] - x, s[:, 1] + t * d[:, 1] - y).min())
    return float(best)


#: Types are objects here, as workers import this module without a session that could parse their names.
_EXTENT = T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")])


@F.pandas_udf(T.BinaryType())
def wkb_from_geojson(text: pd.Series) -> pd.Series:
    return text.map(geojson_wkb)


@F.pandas_udf(T.BinaryType())
def wkb_point(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) else to_wkb("Point", (a, b)) for a, b in zip(x, y)], dtype=object)


@F.pandas_udf(T.BinaryType())
def wkb_box(x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
    return pd.Series([to_wkb("Polygon", [[(a, b), (c, b), (c, d), (a, d), (a, b)]]) for a, b, c, d in zip(x1, y1, x2, y2)], dtype=object)


@F.pandas_udf(T.StringType())
def kind_of(geometry: pd.Series) -> pd.Series:
    return geometry.map(lambda g: None if g is None else NAMES[g[1] & 0xFF])


@F.pandas_udf(_EXTENT)
def extent_of(geometry: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None,) * 4 if g is None else bounds(g) for g in geometry], columns=["xmin", "ymin", "xmax", "ymax"], dtype="float64")


@F.pandas_udf(T.BooleanType())
def st_contains(geometry: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
    """Rows of one geometry are tested together."""
    out = np.zeros(len(geometry), bool)
    for g, at in pd.Series(np.arange(len(geometry))).groupby(geometry.to_numpy(), sort=False):
        k = at.to_numpy()
        out[k] = contains_points(g, x.to_numpy()[k], y.to_numpy()[k])
    return pd.Series(out)


def with_cells(df: DataFrame, geometry: str, level: str, fine: str, names: list[str], most: int = 2_000_000) -> DataFrame:
    """Each row once for each of its polygon's cells() on the grid whose cells are 2**level wide, as three columns names
    in place of the geometry. Rows go out when their edges come to most bytes, so the memory is bounded by it and one row."""
    keep = [f for f in df.schema.fields if f.name != geometry]
    schema = T.StructType([*keep, *[T.StructField(n, t()) for n, t in zip(names, (T.LongType, T.LongType, T.BinaryType))]])

    return df.mapInArrow(lambda batches: cell_batches(batches, geometry, level, fine, names, most), schema)


def cell_batches(batches: Iterator[pa.RecordBatch], geometry: str, level: str, fine: str, names: list[str], most: int) -> Iterator[pa.RecordBatch]:
    """What with_cells() does, in a worker."""
    for batch in batches:
        rest = batch.select([n for n in batch.schema.names if n != geometry])
        row, steps, fines = rest.nbytes // max(1, rest.num_rows) + 24, batch.column(level), batch.column(fine)
        at, found, size = [], [], 0
        for i, g in enumerate(batch.column(geometry)):
            for cell in cells(g.as_py(), 2.0 ** steps[i].as_py(), fines[i].as_py()) if g.is_valid else ():
                at.append(i)
                found.append(cell)
                size += row + len(cell[2] or b"")
                if size >= most:
                    yield _rows(rest, at, found, names)
                    at, found, size = [], [], 0
        if at:
            yield _rows(rest, at, found, names)


def _rows(rest: pa.RecordBatch, at: list[int], found: list[tuple], names: list[str]) -> pa.RecordBatch:
    taken = rest.take(pa.array(at, pa.int64()))
    added = [pa.array(list(x), t) for x, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays([*taken.columns, *added], [*taken.schema.names, *names])


@F.pandas_udf(T.BooleanType())
def is_box(geometry: pd.Series, x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
    """Whether a geometry is just this box: one ring round four finite corners, either way and from any of them."""

    def one(g, a, b, c, d) -> bool:
        if g is None or len(g) != 93 or g[1] & 0xFF != KINDS["Polygon"] or not all(map(math.isfinite, (a, b, c, d))):
            return False
        ring = [tuple(p) for p in from_wkb(g)[1][0].tolist()]
        corners = [(a, b), (c, b), (c, d), (a, d)]
        if ring[0] != ring[-1] or ring[0] not in corners:
            return False
        k = corners.index(ring[0])
        turned = [*corners[k:], *corners[:k]]
        return ring[1:4] in (turned[1:], turned[:0:-1])

    return pd.Series([one(*v) for v in zip(geometry, x1, y1, x2, y2)], dtype=bool)


@F.pandas_udf(T.BooleanType())
def st_within_edges(edges: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
    """Whether points are inside, by their cell's edges from cover(); rows of the same edges are tested together."""
    out = edges.isna().to_numpy()
    for e, at in pd.Series(np.arange(len(edges))).groupby(edges.to_numpy(), sort=False):
        k = at.to_numpy()
        out[k] = side_of_edges(np.frombuffer(e, "<f8").reshape(-1, 4), x.to_numpy()[k], y.to_numpy()[k]) > 0
    return pd.Series(out)


@F.pandas_udf(T.BooleanType())
def st_intersects_box(geometry: pd.Series, x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
    return pd.Series([g is not None and intersects_box(g, *b) for g, *b in zip(geometry, x1, y1, x2, y2)])


@F.pandas_udf(T.DoubleType())
def st_distance(geometry: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([distance(g, a, b) for g, a, b in zip(geometry, x, y)], dtype="float64")


def outward_box(extent: Column) -> Column:
    """The extent as 32-bit floats, widened so that it holds the geometry for certain."""

    def moved(v: Column, sign: int) -> Column:
        return (v + sign * F.abs(v) * F.lit(1e-6) + sign * F.lit(1e-9)).cast("float")

    return F.struct(*[moved(extent[c], -1 if c.endswith("min") else 1).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


def hilbert_index(x: np.ndarray, y: np.ndarray, bits: int = 16) -> np.ndarray:
    """The place of grid cells on a Hilbert curve over 2**bits by 2**bits cells."""
    x, y = x.astype(np.int64), y.astype(np.int64)
    out = np.zeros(len(x), np.int64)
    s = 1 << (bits - 1)
    while s:
        rx, ry = (x & s > 0).astype(np.int64), (y & s > 0).astype(np.int64)
        out += s * s * ((3 * rx) ^ ry)
        flip = (ry == 0) & (rx == 1)
        x, y = np.where(flip, (1 << bits) - 1 - x, x), np.where(flip, (1 << bits) - 1 - y, y)
        x, y = np.where(ry == 0, y, x), np.where(ry == 0, x, y)
        s >>= 1
    return out


@F.pandas_udf(T.LongType())
def hilbert_key(x: pd.Series, y: pd.Series, x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
    """The Hilbert place of a centre within an extent; an axis without width counts as 0."""

    def cell(v, a, b):
        width = (b - a).to_numpy()
        return np.clip(np.where(width > 0, (v - a).to_numpy() / np.where(width > 0, width, 1) * 65535, 0), 0, 65535).astype(np.int64)

    return pd.Series(hilbert_index(cell(x, x1, x2), cell(y, y1, y2)))
