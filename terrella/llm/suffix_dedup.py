"""Removal of byte strings that repeat, by merging Burrows-Wheeler transforms of shards.

A string is LENGTH bytes; each byte under a string that starts anywhere else too is removed.

Anchors: among the GRAM-byte windows of a string, the one with the least hash (leftmost if equal) is its
anchor. Equal strings have equal anchors at equal places. Starts in a row with one anchor make a stretch, and
only stretches whose anchors' contents occur again can hold repeats; no string is lost. Stretches that are
equal as a whole are taken together and counted. Of what differs around the same anchor, starts go on in runs
at whole multiples of CORE from the anchor: the strings of a run share their middle, and where that is alone
none of them repeats.

Shards: the stretches that are left are cut into shards. A suffix is read in symbols of STRIDE bytes, so the
transform of a shard has, for each suffix in order, the symbol that stands before it. The merge holds which
shard each merged suffix is of. It starts with shard after shard, and each round deals the suffixes out anew,
stably, by the symbol before them: after round d suffixes stand in order of their first d symbols, and no
suffix is sorted again by itself. A round also marks where neighbours begin to differ, which is their common
prefix. After LENGTH / STRIDE rounds the intervals without a mark are the repeated strings.

Anchors with more than HOT different stretches go another way with the same result: their strings are hashed one
by one, to 128 bits, and counted over all tasks, first by aligned cores, so no task gathers such an anchor.
Stretches, strings and rows are told apart by 128 bits everywhere, core hashes only let more through.

Rules for odd rows: a null text counts as empty; a text shorter than LENGTH keeps all; rows that repeat are
copies of each other and both lose what they share; an empty table gives no rows. A text may be as long as a
string in Spark can be; a task holds it, and some 60 bytes for each of its bytes, at a time. Only the two named
columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import bucketed, identity, release, small, staged
from terrella.llm.near_dedup import _bounds, _groups
from terrella.llm.shingles import mix, slices

LENGTH, GRAM, STRIDE = 400, 32, 100

#: Different pieces of an anchor beyond which its strings are hashed; bytes of a merge and of a shard.
HOT, MERGE, SHARD = 1000, 600_000, 100_000

#: Starts whose strings share a core, in the filter before the merge and for hot anchors.
CORE, HOT_CORE = 64, 16

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Of equal hashes the leftmost is the least: their place, below any text's length in bytes, takes the low bits.
_PLACE = np.uint64((1 << 32) - 1)


class _Prefix:
    """Hashes of any substrings of some bytes."""

    def __init__(self, data: np.ndarray, base: int):
        n = len(data)
        power = np.ones(n + 1, np.uint64)
        power[1:] = base
        np.cumprod(power, out=power)
        self.inverse = np.ones(n + 1, np.uint64)
        self.inverse[1:] = pow(base, -1, 1 << 64)
        np.cumprod(self.inverse, out=self.inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, size: int) -> np.ndarray:
        return mix((self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[: n - width + 1], upto[width - 1 : n])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, first start, last start, anchor's place, anchor, hash 1, hash 2) of each stretch; starts are within the row."""
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(3))
    one, two = _Prefix(data, _BASES[0]), _Prefix(data, _BASES[1])
    grams = one.grams(gram)
    keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_least(keys, length - gram + 1) & _PLACE).astype(np.int64)
    edge = np.zeros(len(at) + 1, np.int64)
    has = np.diff(offsets) >= length
    np.add.at(edge, offsets[:-1][has], 1)
    np.add.at(edge, offsets[1:][has] - length + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    new = valid.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    end = valid.copy()
    end[:-1] &= (at[1:] != at[:-1]) | ~valid[1:]
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    anchor = at[first]
    place = mix(((last - first) * 4096 + anchor - first).astype(np.uint64))
    row = np.searchsorted(offsets, first, "right") - 1
    return row, first - offsets[row], last - offsets[row], anchor - first, grams[anchor], mix(one(first, last + length) + place), mix(two(first, last + length) + place)


def _radix(x: np.ndarray) -> np.ndarray:
    """A stable argsort of 32-bit numbers."""
    low = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    return low[np.argsort((x >> 16).astype(np.uint16)[low], kind="stable")] if len(x) and x.max() > 0xFFFF else low


def _numbered(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A number for each different pair, in an order of the pairs."""
    _, first, number = np.unique(one, return_index=True, return_inverse=True)
    if (two == two[first[number]]).all():
        return number
    return np.unique(np.stack((one, two), axis=1), axis=0, return_inverse=True)[1].ravel()


def _shard_order(symbol: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The suffixes of one shard in order: by symbols; last ones (symbol 0) by place."""
    n = len(symbol)
    ends = symbol == 0
    n_ends = int(ends.sum())
    rank = np.where(ends, np.cumsum(ends) - 1, symbol.astype(np.int64) + n_ends)
    nearest = after
    while True:
        key = rank * np.int64(n + int(rank.max()) + 2) + np.where(nearest >= 0, rank[np.maximum(nearest, 0)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        nearest = np.where(nearest >= 0, nearest[np.maximum(nearest, 0)], -1)


def repeated_starts(segments: list[bytes], weights: np.ndarray, length: int = LENGTH, stride: int = STRIDE, shard: int = SHARD) -> list[np.ndarray]:
    """For each segment, the starts of strings that weigh 2 or more in all segments together."""
    # A byte after each segment is the place where its last suffixes end.
    sizes = np.array([len(s) + 1 for s in segments])
    data = np.frombuffer(b"\0".join([*segments, b""]), np.uint8)
    ends = np.cumsum(sizes)
    n = len(data)
    of = np.repeat(np.arange(len(segments)), sizes)
    place = np.arange(n)
    whole = place + stride < ends[of]
    symbol = np.zeros(n, np.int64)
    grams = _Prefix(data, _BASES[0])(place[whole], place[whole] + stride)
    symbol[whole] = _numbered(grams, _Prefix(data, _BASES[1])(place[whole], place[whole] + stride)) + 1
    after = np.where(whole, place + stride, -1)
    before = np.where(place - stride >= ends[of] - sizes[of], symbol[np.maximum(place - stride, 0)], 0)
    # Whole segments to shards of about equal size.
    of_shard = ((ends - sizes) // shard)[of]
    cuts = np.flatnonzero(np.concatenate(([True], of_shard[1:] != of_shard[:-1], [True])))
    orders, transforms, from_shard, lasts = [], [], [], []
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        order = _shard_order(symbol[a:b], np.where(after[a:b] >= 0, after[a:b] - a, -1)) + a
        orders.append(order)
        transforms.append(before[order])
        from_shard.append(np.full(b - a, k, np.int32))
        lasts.append(int((~whole[a:b]).sum()))
    order, transform = np.concatenate(orders), np.concatenate(transforms)
    interleave = np.concatenate(from_shard)
    fixed = np.repeat(np.arange(len(lasts), dtype=np.int32), lasts)
    n_fixed = len(fixed)
    block = np.zeros(n, np.int64)
    for _ in range(length // stride):
        merged = np.empty(n, np.int64)
        merged[_radix(interleave)] = transform
        inner = np.flatnonzero(merged)
        perm = inner[_radix(merged[inner])]
        s, b = merged[perm], block[perm]
        marks = np.ones(n, np.int64)
        if len(perm):
            marks[n_fixed + 1 :] = (s[1:] != s[:-1]) | (b[1:] != b[:-1])
        block = np.cumsum(marks) - 1
        interleave = np.concatenate((fixed, interleave[perm]))
    suffix = np.empty(n, np.int64)
    suffix[_radix(interleave)] = order
    weight = np.bincount(block, weights=weights[of[suffix]], minlength=n)
    found = np.zeros(n, bool)
    found[suffix] = weight[block] >= 2
    found &= place + length < ends[of]
    return [np.flatnonzero(x) for x in np.split(found, ends[:-1])]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(), starts[np.concatenate((cut, [len(starts) - 1]))].tolist()))


def _anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for first, n, data, offsets in slices(batch, 1):
                row, a, b, place, anchor, one, two = stretches(data, offsets, length, gram)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n).take(pa.array(row)), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(place, pa.int32()), *[pa.array(x.view(np.int64)) for x in (anchor, one, two)]], ["row", "a", "b", "p", "anchor", "one", "two"])

    return docs.mapInArrow(run, "row binary, a int, b int, p int, anchor long, one long, two long")


def _lists(rows: DataFrame, buckets: int, listed: Column) -> DataFrame:
    """rows by row, as lists: the side of a join with texts that moves, to the texts' buckets, and is hashed there."""
    return rows.repartition(buckets, "row").groupBy("row").agg(listed.alias("list")).hint("shuffle_hash")


def _cores(docs: DataFrame, wanted: DataFrame, length: int, core: int) -> DataFrame:
    """wanted: (row, list of (anchor, one, two, n, a, b, p)). The runs of each stretch, with the hash of their core."""

    def run(batches):
        for batch in batches:
            for first, n, data, offsets in slices(batch, 0):
                listed = batch.column(1).slice(first, n)
                at = np.repeat(offsets[:-1], pa.compute.list_value_length(listed).to_numpy())
                x = {f: c.to_numpy() for f, c in zip(("anchor", "one", "two", "n", "a", "b", "p"), listed.flatten().flatten())}
                if not len(at):
                    continue
                # Runs of a stretch: starts a..b, of which start s stands (a + p - s) // core runs from the anchor.
                c0, c1 = x["p"] // core, (x["p"] - (x["b"] - x["a"])) // core
                count = c0 - c1 + 1
                of = np.repeat(np.arange(len(at)), count)
                c = np.repeat(c0, count) - (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))
                place = x["p"][of]
                lo, hi = np.maximum(0, place - (c + 1) * core + 1), np.minimum((x["b"] - x["a"])[of], place - c * core)
                anchor = (at + x["a"] + x["p"])[of]
                salt = mix(c.astype(np.uint64) + x["anchor"].view(np.uint64)[of])
                one = _Prefix(data, _BASES[1])
                shared = mix(one(anchor - c * core, anchor - (c + 1) * core + 1 + length) + salt)
                yield pa.RecordBatch.from_arrays([*[pa.array(x[f][of]) for f in ("anchor", "one", "two", "n")], pa.array(lo.astype(np.int64)), pa.array(hi.astype(np.int64)), pa.array(shared.view(np.int64))], ["anchor", "one", "two", "n", "lo", "hi", "core"])

    return docs.join(wanted, "row").select("text", "list").mapInArrow(run, "anchor long, one long, two long, n long, lo long, hi long, core long")


def _segments(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """wanted: (row, list of (anchor, one, two, n, a, p, runs)). The bytes under each unbroken run of starts."""

    def run(batches):
        for batch in batches:
            for first, n, data, offsets in slices(batch, 0):
                raw = data.tobytes()
                out = []
                for i, listed in enumerate(batch.column(1).slice(first, n).to_pylist()):
                    for x in listed:
                        at = int(offsets[i]) + x["a"]
                        runs = sorted((r["lo"], r["hi"]) for r in x["runs"])
                        joined = [list(runs[0])]
                        for lo, hi in runs[1:]:
                            if lo <= joined[-1][1] + 1:
                                joined[-1][1] = hi
                            else:
                                joined.append([lo, hi])
                        out += [(x["anchor"], x["one"], x["two"], x["n"], x["p"] - lo, lo, raw[at + lo : at + hi + length]) for lo, hi in joined]
                cols = list(zip(*out)) if out else [[]] * 7
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:6]], pa.array(cols[6], pa.binary())], ["anchor", "one", "two", "n", "p", "base", "bytes"])

    return docs.join(wanted, "row").select("text", "list").mapInArrow(run, "anchor long, one long, two long, n long, p long, base long, bytes binary")


def _merge(length: int, stride: int):
    """From rows (anchor, one, two, n, base, bytes) sorted by anchor: runs of repeated starts, as (one, two, lo, hi)."""

    def found(table: pa.Table):
        pieces, base = table.column(5).to_pylist(), table.column(4).to_pylist()
        starts = repeated_starts(pieces, np.minimum(table.column(3).to_numpy(), 2), length, stride)
        one, two = table.column(1).to_pylist(), table.column(2).to_pylist()
        out = [(one[i], two[i], base[i] + lo, base[i] + hi) for i, x in enumerate(starts) for lo, hi in _runs(x)]
        cols = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["one", "two", "lo", "hi"])

    def run(batches):
        for table in _groups(batches, 1):
            sizes = np.cumsum(pa.compute.binary_length(table.column(5)).to_numpy())
            at = 0
            for a, b in _bounds(table, 1):
                if sizes[b - 1] - (sizes[at - 1] if at else 0) >= MERGE or b == table.num_rows:
                    yield found(table.slice(at, b - at))
                    at = b

    return run


def _hashed(length: int, core: int):
    """From segments: a row for each run of starts with the same whole multiple of core from the anchor.

    All strings of a run hold the run's core, so where that is alone none of them repeats.
    """

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                anchor, first, second, weight, place, base = (batch.column(k)[i].as_py() for k in range(6))
                data = np.frombuffer(batch.column(6)[i].as_buffer(), np.uint8)
                one, two = _Prefix(data, _BASES[0]), _Prefix(data, _BASES[1])
                starts = np.arange(len(data) - length + 1)
                of = (place - starts) // core
                lo = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                hi = np.concatenate((lo[1:], [len(starts)])) - 1
                c = of[lo]
                salt = mix(c.astype(np.uint64) + np.uint64(anchor & (2**64 - 1)))
                shared = mix(one(place - c * core, place - (c + 1) * core + 1 + length) + salt)
                at_run = mix(salt + ((place - lo) * 4096 + hi - lo).astype(np.uint64))
                at_start = mix((place - starts).astype(np.uint64) + np.uint64(anchor & (2**64 - 1)))
                whole = [pa.array(mix(h(lo, hi + length) + at_run).view(np.int64)) for h in (one, two)]
                bounds = pa.array(np.concatenate((lo, [len(starts)])), pa.int32())
                strings = [pa.ListArray.from_arrays(bounds, pa.array(mix(h(starts, starts + length) + at_start).view(np.int64))) for h in (one, two)]
                same = lambda x: pa.array(np.full(len(lo), x, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [same(first), same(second), same(weight), pa.array(lo + base), pa.array(hi + base), pa.array(shared.view(np.int64)), *whole, *strings],
                    ["one", "two", "n", "lo", "hi", "core", "whole1", "whole2", "strings1", "strings2"],
                )

    return run


def _hot(segments: DataFrame, length: int, core: int) -> DataFrame:
    """Runs of repeated starts (one, two, lo, hi) of anchors with very many stretches, by counts alone."""
    whole, string = ["whole1", "whole2"], ["string1", "string2"]
    rows = staged(segments.mapInArrow(_hashed(length, core), "one long, two long, n long, lo long, hi long, core long, whole1 long, whole2 long, strings1 array<long>, strings2 array<long>"))
    differ = (F.min("whole1") != F.max("whole1")) | (F.min("whole2") != F.max("whole2"))
    cores = rows.groupBy("core").agg(F.sum("n").alias("m"), differ.alias("mixed")).filter("m > 1")
    again = staged(rows.join(small(staged(cores)).select("core", "mixed"), "core"))
    alike = staged(again.filter("mixed").groupBy(*whole).agg(F.sum("n").alias("w")))
    parted = again.join(small(alike), whole, "left")
    runs = parted.filter("not mixed or w > 1").select("one", "two", "lo", "hi")
    # What is left of a run is taken string by string; strings in runs that repeat count too.
    each = again.filter("mixed").select("one", "two", "n", "lo", F.posexplode(F.arrays_zip("strings1", "strings2")).alias("k", "s"))
    each = each.select("one", "two", "n", (F.col("lo") + F.col("k")).alias("lo"), F.col("s.strings1").alias("string1"), F.col("s.strings2").alias("string2"))
    counted = staged(each.groupBy(*string).agg(F.sum("n").alias("w")).filter("w > 1"))
    single = each.join(small(counted).select(*string), string).select("one", "two", "lo", F.col("lo").alias("hi"))
    return runs.union(single)


def repeats(docs: DataFrame, buckets: int, length: int = LENGTH, gram: int = GRAM, stride: int = STRIDE) -> DataFrame:
    """docs: (row, text) with text not null, in so many buckets by row. Rows (row, a, b): runs of starts whose strings repeat."""
    anchors = staged(_anchors(docs, length, gram))
    twice = anchors.groupBy("anchor").agg(F.count("*").alias("m"), ((F.min("one") != F.max("one")) | (F.min("two") != F.max("two"))).alias("mixed")).filter("m > 1")
    again = staged(anchors.join(small(staged(twice)).select("anchor", "mixed"), "anchor"))
    release(anchors)
    # Stretches that are equal as a whole: one of them stands for all.
    alike = again.filter("mixed").groupBy("anchor", "one", "two").agg(F.count("*").alias("n"), F.min(F.struct("row", "a", "b", "p")).alias("x"))
    alike = staged(alike.select("anchor", "one", "two", "n", "x.*"))
    stretch = ["anchor", "one", "two", "n", "a", "b", "p"]
    runs = staged(_cores(docs, _lists(alike, buckets, F.collect_list(F.struct(*stretch))), length, CORE).dropDuplicates(["one", "two", "lo"]))
    shared = staged(runs.groupBy("core").agg(F.sum("n").alias("m")).filter("m > 1").select("core"))
    kept = staged(runs.join(small(shared), "core").groupBy("one", "two").agg(F.collect_list(F.struct("lo", "hi")).alias("runs")))
    release(runs, shared)
    wanted = _lists(alike.join(small(kept), ["one", "two"]), buckets, F.collect_list(F.struct("anchor", "one", "two", "n", "a", "p", "runs")))
    segments = staged(_segments(docs, wanted, length).dropDuplicates(["one", "two", "base"]))
    many = staged(segments.groupBy("anchor").agg(F.count("*").alias("d")).filter(F.col("d") > HOT).select("anchor"))
    n_many = many.count()
    cold = segments.join(small(many, n_many), "anchor", "left_anti")
    sorted_rows = cold.select("anchor", "one", "two", "n", "base", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    runs = staged(sorted_rows.mapInArrow(_merge(length, stride), "one long, two long, lo long, hi long"))
    if n_many:
        hot = segments.join(small(many, n_many), "anchor").select("anchor", "one", "two", "n", "p", "base", "bytes")
        runs = staged(runs.union(_hot(hot, length, HOT_CORE)))
    in_mixed = again.filter("mixed").select("row", "a", "one", "two").join(small(runs), ["one", "two"]).select("row", (F.col("a") + F.col("lo")).alias("a"), (F.col("a") + F.col("hi")).alias("b"))
    return again.filter("not mixed").select("row", F.col("a").cast("long"), F.col("b").cast("long")).union(in_mixed)


def _removed(length: int, key: str, with_text: bool):
    def run(batches):
        for batch in batches:
            for first, n, data, offsets in slices(batch, 1):
                raw = data.tobytes()
                listed = batch.column(2).slice(first, n).to_pylist()
                out = []
                for i in range(n):
                    text = raw[offsets[i] : offsets[i + 1]]
                    kept, at, spans = [], 0, 0
                    for x in sorted((x["a"], x["b"]) for x in listed[i] or ()):
                        if x[0] > at or not spans:
                            kept.append(text[at : x[0]])
                            spans += 1
                            at = x[0]
                        at = max(at, x[1] + length)
                    kept = b"".join([*kept, text[at:]])
                    out.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
                cols = list(zip(*out))
                arrays = [batch.column(0).slice(first, n), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(cols[4], pa.binary())] if with_text else arrays, [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text])

    return run


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, stride: int = STRIDE, with_text: bool = False) -> DataFrame:
    """Rows (key, n_bytes, n_removed, n_spans, kept_sha256), and with_text the kept bytes."""
    docs = df.select(F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("row", identity("__key", "text"))
    docs, buckets = bucketed(docs, "row")  # the only time that texts move
    found = repeats(docs.select("row", "text"), buckets, length, gram, stride)
    lists = _lists(found, buckets, F.collect_set(F.struct("a", "b")))
    kind = df.schema[key].dataType.simpleString()
    return docs.join(lists, "row", "left").select("__key", "text", "list").mapInArrow(_removed(length, key, with_text), f"{key} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
