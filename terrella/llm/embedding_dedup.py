"""Embedding near-dedup with randomised-rotation binary codes.

Random rotations turn each unit vector; the signs of the turned coordinates are its code, and the inner product
of the vector with its code's unit vector is the stored correction factor. The inner product of one vector's
code with another turned vector, over that factor, is an unbiased estimate of the vectors' inner product, with
an error that the factor bounds. Pairs whose upper bound is below the threshold are dropped; the rest is
computed exactly, in double precision.

Pairs come from tables: each takes its own run of code signs as a key, and vectors of one key are compared.
Keys are longer and tables more as the vectors grow in number, so that a key is shared by chance by few, and
a pair at the threshold shares no key with probability MISS. Equal vectors form a class of which one goes on.
A pair counts in the first table only in which it meets, so tables give counts and the links that join, never
all pairs. Keys with more than BLOCK members are compared by pairs of blocks, each a group of its own. What goes
to a key is the vector as the input has it, its code and factor; other tables' keys are worked out again for
those that link.

Rules for odd rows: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths don't link; rows that repeat an id and its vector are one vector; an id on several
vectors joins what these link to, and each of its rows has the links of its own vector; a row with a null id links
with nothing; labels and other columns aren't read; an empty table gives no rows. Very long vectors need no care
beyond the room for a rotation, the square of their length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrella.llm.common import small, staged
from terrella.llm.components import components
from terrella.llm.near_dedup import _bounds, _groups
from terrella.llm.shingles import mix

THRESHOLD, MISS, BLOCK = 0.95, 1e-6, 4096

#: Steps of a unit in which keys are worked out; sums of products stay far below 2**53.
WHOLE = 2.0**20

#: Rotations whose signs the estimates use, and standard deviations of the bounds.
ROTATIONS, DEVIATIONS = 6, 5.0


def plan(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Signs of a key and tables for n vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = min(30, max(8, math.ceil(math.log2(max(n, 2))) + 5))
    return bits, math.ceil(math.log(miss) / math.log(1 - agree**bits))


_turns: dict[tuple[int, int], np.ndarray] = {}


def rotations(size: int, rows: int) -> np.ndarray:
    """At least so many rows of random rotations, one rotation after the other; the same on every worker."""
    if (size, rows) not in _turns:
        random = np.random.default_rng(20240517 + size)
        _turns[size, rows] = np.vstack([np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(-(-rows // size))])
    return _turns[size, rows]


def _read(vector: list | None) -> np.ndarray | None:
    if not vector or None in vector:
        return None
    x = np.array(vector, np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    return x + 0.0  # -0.0 becomes 0.0


def _classes(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (id, size, one, two, vector): size 0 for vectors that link with nothing; one and two identify the vector,
    whose bytes are those of 32-bit numbers if the input's are, else of 64-bit ones."""
    kind = _number(df.schema[vector].dataType)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, size, one, two, raw = batch.column(0).to_pylist(), [], [], [], []
            for v, i in zip(batch.column(1).to_pylist(), ids):
                x = _read(v) if i is not None else None
                size.append(0 if x is None else len(x))
                raw.append(b"" if x is None else x.astype(kind).tobytes())
                words = np.zeros(0, np.uint64) if x is None else x.view(np.uint64)
                place = np.arange(len(words), dtype=np.uint64)
                for to, salt in ((one, 0x9E3779B97F4A7C15), (two, 0xC2B2AE3D27D4EB4F)):
                    to.append(int(mix(words + mix(place * np.uint64(salt) + np.uint64(1))).sum().view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(x, pa.int64()) for x in (size, one, two)], pa.array(raw, pa.binary())], ["id", "size", "one", "two", "vector"])

    return df.select(F.col(key).cast("long"), F.col(vector)).mapInArrow(run, "id long, size long, one long, two long, vector binary")


def _number(kind: T.DataType) -> str:
    return "float32" if isinstance(getattr(kind, "elementType", None), T.FloatType) else "float64"


def _matrix(raw: list[bytes], size: int, kind: str) -> np.ndarray:
    """Vectors as rows, scaled to a largest component of 1."""
    x = np.frombuffer(b"".join(raw), kind).reshape(-1, size).astype(np.float64)
    return x / np.abs(x).max(axis=1, keepdims=True)


def _units(scaled: np.ndarray) -> np.ndarray:
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _keys(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The vectors' key in each table: the same wherever it is worked out, as whole numbers add up alike in any order."""
    size = units.shape[1]
    turned = rotations(size, max(bits * tables, ROTATIONS * size))[: bits * tables]
    plus = np.rint(units * WHOLE) @ np.rint(turned * WHOLE).T > 0
    return (plus.reshape(len(units), tables, bits) @ (1 << np.arange(bits))).astype(np.int32)


def _coded(reps: DataFrame, bits: int, tables: int, kind: str) -> DataFrame:
    """Adds keys (array<int>, one for each table), signs (packed) and factor."""

    def run(batches):
        for batch in batches:
            sizes, raw = batch.column(1).to_numpy(), batch.column(5).to_pylist()
            keys, signs, factors = np.zeros((len(raw), tables), np.int32), [b""] * len(raw), np.zeros(len(raw))
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                units = _units(_matrix([raw[i] for i in at], size, kind))
                keys[at] = _keys(units, bits, tables)
                used = ROTATIONS * size
                turned = units @ rotations(size, used)[:used].T
                factors[at] = np.abs(turned).sum(axis=1) / (ROTATIONS * math.sqrt(size))
                for i, s in zip(at.tolist(), np.packbits(turned > 0, axis=1)):
                    signs[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(6)], pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * tables, pa.int32()), pa.array(keys.ravel())), pa.array(signs, pa.binary()), pa.array(factors)],
                ["id", "size", "one", "two", "n", "vector", "keys", "signs", "factor"],
            )

    return reps.select("id", "size", "one", "two", "n", "vector").mapInArrow(run, "id long, size long, one long, two long, n long, vector binary, keys array<int>, signs binary, factor double")


def estimates(signs: np.ndarray, factor: np.ndarray, turned: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased inner products of coded vectors (rows) with turned ones (columns), and each row's bound on the error."""
    used = ROTATIONS * size
    plus = np.unpackbits(signs, axis=1, count=used).astype(np.float32) * 2 - 1
    f = np.minimum(factor, 1.0)[:, None]
    bound = DEVIATIONS * np.sqrt((1 - f * f) / (f * f) / (max(size - 1, 1) * ROTATIONS))
    return plus @ turned[:, :used].astype(np.float32).T / (ROTATIONS * math.sqrt(size) * f), bound


def _linked(threshold: float, bits: int, tables: int, kind: str):
    """From rows (table, key, left, right, size, block, id, one, two, n, vector, signs, factor), sorted by the first five:
    (id, one, two, links): links that are first met here, and (..., other, other1, other2): a link of those that joins."""

    def pairs(table: pa.Table):
        at, left, right, size = (table.column(k)[0].as_py() for k in (0, 2, 3, 4))
        block, n = table.column(5).to_numpy(), table.column(9).to_numpy()
        names = list(zip(*(table.column(k).to_pylist() for k in (6, 7, 8))))
        scaled = _matrix(table.column(10).to_pylist(), size, kind)
        norm = np.sqrt((scaled * scaled).sum(axis=1))
        units = _units(scaled)
        turned = units @ rotations(size, ROTATIONS * size)[: ROTATIONS * size].T
        signs = np.frombuffer(b"".join(table.column(11).to_pylist()), np.uint8).reshape(len(names), -1)
        factor = table.column(12).to_numpy()
        links, own, joins = np.zeros(len(names)), np.arange(len(names)), []
        keys, known = np.zeros((len(names), at), np.int32), np.zeros(len(names), bool)
        for start in range(0, len(names), 512):
            rows = np.arange(start, min(start + 512, len(names)))
            near, bound = estimates(signs[rows], factor[rows], turned, size)
            i, j = np.nonzero(near + bound + 1e-4 >= threshold)
            i = rows[i]
            real = (i < j) & ((block[i] != block[j]) | (left == right))
            i, j = i[real], j[real]
            for k in range(0, len(i), 16384):
                x, y = i[k : k + 16384], j[k : k + 16384]
                exact = (scaled[x] * scaled[y]).sum(axis=1) / (norm[x] * norm[y]) >= threshold
                x, y = x[exact], y[exact]
                if at and len(x):  # those that have met in an earlier table were done there
                    fresh = np.unique(np.concatenate((x, y)))
                    fresh = fresh[~known[fresh]]
                    if len(fresh):
                        keys[fresh] = _keys(units[fresh], bits, tables)[:, :at]
                        known[fresh] = True
                    new = ~(keys[x] == keys[y]).any(axis=1)
                    x, y = x[new], y[new]
                links += np.bincount(x, weights=n[y], minlength=len(names)) + np.bincount(y, weights=n[x], minlength=len(names))
                apart = own[x] != own[y]
                for p, q in zip(x[apart].tolist(), y[apart].tolist()):
                    if own[p] != own[q]:
                        joins.append((*names[p], *names[q], 0))
                        own[own == own[q]] = own[p]
        return [(*names[k], None, None, None, int(links[k])) for k in np.flatnonzero(links)] + joins

    def run(batches):
        for table in _groups(batches, 5):
            out = [x for p, q in _bounds(table, 5) for x in pairs(table.slice(p, q - p))]
            cols = list(zip(*out)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["id", "one", "two", "other", "other1", "other2", "links"])

    return run


def linked_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (key, n_links, component_id, kept) for each vector, whatever its label."""
    kind = _number(df.schema[vector].dataType)
    rows = staged(_classes(df, key, vector))
    same, name = ["size", "one", "two"], ["id", "one", "two"]
    classes = staged(rows.filter("size > 0").groupBy(*same).agg(F.min("id").alias("rep"), F.count_distinct("id").alias("n")))
    n = classes.count()
    reps = rows.join(small(classes, n), same).filter("id = rep").dropDuplicates(name)
    bits, tables = plan(n, threshold)
    coded = staged(_coded(reps, bits, tables, kind))
    dealt = coded.select(*name, "size", F.posexplode("keys").alias("table", "key"))
    mark = F.sum(F.shiftright(F.xxhash64(*name), 20))
    shared = dealt.groupBy("size", "table", "key").agg(F.count("*").alias("m"), F.min("id").alias("low"), mark.alias("mark")).filter("m > 1")
    # Of tables in which the same vectors meet, the first.
    shared = staged(shared.groupBy("size", "m", "low", "mark").agg(F.min(F.struct("table", "key")).alias("x")).select("size", "m", "x.*"))
    met = staged(dealt.join(small(shared), ["size", "table", "key"]))
    blocks = F.ceil(F.col("m") / BLOCK)
    spread = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(*name), F.col("blocks")))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = spread.select(*name, "table", "key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block")
    full = spread.join(coded.drop("keys"), name).select("table", "key", "left", "right", "size", "block", *name, "n", "vector", "signs", "factor")
    by = ["table", "key", "left", "right", "size"]
    told = "id long, one long, two long, other long, other1 long, other2 long, links long"
    found = staged(full.repartition(*by).sortWithinPartitions(*by).mapInArrow(_linked(threshold, bits, tables, kind), told))
    links = found.filter("other is null").groupBy(*name).agg(F.sum("links").alias("links")).withColumnRenamed("id", "rep")
    node = lambda *c: F.struct(*[F.col(x).alias(y) for x, y in zip(c, name)])
    joined = components(found.filter("other is not null").select(node(*name).alias("a"), node("other", "other1", "other2").alias("b")))
    joined = joined.select(F.col("node.id").alias("rep"), "node.one", "node.two", F.col("component.id").alias("component"))
    own = ["rep", "one", "two"]
    named = classes.join(links, own, "left").join(small(joined), own, "left")
    named = named.select(*same, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = rows.select("id", *same).join(named, same, "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
