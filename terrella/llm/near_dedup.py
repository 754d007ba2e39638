"""MinHash near-dedup, with odd sketches to verify the candidates of banded buckets.

A document's set is its distinct 2-word shingles. Documents with equal sets form a class, and only one of each
class goes on. Its MinHash samples are cut into bands; the odd sketch folds the same samples into a parity
bitmap. Two sketches' XOR has a population count from which the similarity follows, so within a bucket pairs
whose estimate is five standard deviations below the threshold are dropped without their sets. What remains
joins documents into clusters, and inside a cluster links are confirmed on the full sets, pair by pair, where
the two aren't yet in one component.

No pair of all members is written out: a bucket or cluster gives the links that join its components. Buckets
over BUCKET members skip the sketch and join all of them to one cluster. Clusters over CLUSTER members are cut
into parts that are compared inside, and with a few leaders. What is then outside of a cluster's main component
is cut into blocks, and each block meets each block of the cluster: by sketches first, and of those documents
that have a partner there the sets. So every pair of documents of different components has been compared in the
end, and no task holds more than two blocks.

A pair of similarity 0.8 shares no band with probability (1 - 0.8^5)^36 = 6e-7.

Rules for odd rows: a null or empty text has an empty set and is linked with nothing; rows that repeat an id
count as the one document, whose sketch is the least of theirs if their texts differ; a row with a null id is its
own component, named null. A very long text is handled alone. Only the two columns named are read. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.llm.components import components
from terrella.llm.common import release, small, staged
from terrella.llm.shingles import mix, shingle_sets, slices
from terrella.llm.workers import giving_back

BANDS, ROWS, BITS = 36, 5, 512
BUCKET, CLUSTER, LEADERS, BLOCKED = 512, 256, 8, 1024

_RANDOM = np.random.default_rng(20240229)
_MULTIPLY = _RANDOM.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RANDOM.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_BAND = _RANDOM.integers(0, 2**63, (1, BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SAMPLE = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))


def minhash(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a non-empty set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = None
    for at in range(0, len(x), 2048):
        y = _MULTIPLY[:, None] * x[None, at : at + 2048]
        y += _ADD[:, None]
        low = y.min(axis=1)
        out = low if out is None else np.minimum(out, low)
    return out


def odd_sketches(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """For each row of samples the parities, packed, of how many of them fall on each bit."""
    place = (mix(samples.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _SAMPLE[None, :]) % np.uint64(bits)).astype(np.int64)
    counts = np.bincount((place + np.arange(len(samples))[:, None] * bits).ravel(), minlength=len(samples) * bits)
    return np.packbits((counts & 1).astype(np.uint8).reshape(len(samples), bits), axis=1)


def most_odd(threshold: float, bits: int = BITS, samples: int = BANDS * ROWS, deviations: float = 5.0) -> int:
    """The largest XOR count at which a pair may still have the threshold similarity."""
    differ = samples * (1 - threshold)
    differ += deviations * np.sqrt(samples * threshold * (1 - threshold))
    expected = bits / 2 * (1 - np.exp(-4 * differ / bits))
    return int(np.ceil(expected + 2 * np.sqrt(bits) / 4))


def similarity(odd: np.ndarray, bits: int = BITS, samples: int = BANDS * ROWS) -> np.ndarray:
    """The similarity that an XOR count stands for."""
    return 1 + bits / (4 * samples) * np.log(np.maximum(1 - 2 * odd / bits, 1e-9))


def signatures(df: DataFrame, key: str, text: str, width: int = 2) -> DataFrame:
    """Rows (doc, n_shingles, set1, set2, bands, sketch); set1 and set2 identify the set."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for first, n, data, offsets in slices(batch, 1):
                hashes, bounds = shingle_sets(data, offsets, width)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                samples = np.zeros((n, BANDS * ROWS), np.uint32)
                for i in full.tolist():
                    samples[i] = minhash(hashes[bounds[i] : bounds[i + 1]])
                sums = np.zeros((2, n), np.uint64)
                if len(full):
                    for k in range(2):
                        sums[k, full] = np.add.reduceat(mix(hashes + np.uint64(k * 0x51ED27)), bounds[:-1][full])
                bands = mix((samples.reshape(n, BANDS, ROWS).astype(np.uint64) * _BAND).sum(axis=2) + np.arange(BANDS, dtype=np.uint64)[None, :])
                none = np.where(size == 0)[0]
                lengths = np.full(n, BANDS)
                lengths[none] = 0
                values = bands[full].ravel().view(np.int64)
                sketch = odd_sketches(samples)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(size, pa.int64()),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(values)),
                        pa.array([x.tobytes() for x in sketch], pa.binary()),
                    ],
                    ["doc", "n_shingles", "set1", "set2", "bands", "sketch"],
                )

    return df.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "doc long, n_shingles long, set1 long, set2 long, bands array<long>, sketch binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Whole groups of rows that agree in the first columns, from sorted rows; several groups at a time."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = np.zeros(batch.num_rows, bool)
        for k in range(keys):
            x = batch.column(k).to_numpy(zero_copy_only=False)
            last[1:] |= x[1:] != x[:-1]
        cut = np.flatnonzero(last)
        first = [batch.column(k)[0].as_py() for k in range(keys)]
        if rest and first != [rest[-1].column(k)[rest[-1].num_rows - 1].as_py() for k in range(keys)]:
            yield pa.Table.from_batches(rest)
            rest = []
        if len(cut):
            yield pa.Table.from_batches([*rest, batch.slice(0, cut[-1])])
            rest = [batch.slice(cut[-1])]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def _bounds(table: pa.Table, keys: int) -> list[tuple[int, int]]:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in range(keys):
        x = table.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    starts = np.flatnonzero(new).tolist()
    return list(zip(starts, [*starts[1:], table.num_rows]))


def _sketch_links(limit: int):
    """From rows (bucket, doc, sketch) sorted by bucket: links that join the members which the sketches let pass."""

    @giving_back
    def run(batches):
        for table in _groups(batches, 1):
            docs = table.column(1).to_numpy()
            sketches = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint64).reshape(len(docs), -1)
            a, b = [], []
            for x, y in _bounds(table, 1):
                own = np.arange(y - x)
                for i in range(y - x - 1):
                    odd = np.bitwise_count(sketches[x + i] ^ sketches[x + i + 1 : y]).sum(axis=1)
                    for j in (i + 1 + np.flatnonzero(odd <= limit)).tolist():
                        if own[j] != own[i]:
                            a.append(docs[x + i])
                            b.append(docs[x + j])
                            own[own == own[j]] = own[i]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _set_links(per_cent: int, limit: int):
    """From rows (cluster, part, doc, known, sketch, shingles) sorted by part: confirmed links between components."""

    @giving_back
    def run(batches):
        for table in _groups(batches, 2):
            docs, known = table.column(2).to_numpy(), table.column(3).to_numpy()
            sketches = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint64).reshape(len(docs), -1)
            a, b = [], []
            for x, y in _bounds(table, 2):
                sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column(5).slice(x, y - x)]
                size = np.array([len(s) for s in sets])
                own = np.unique(known[x:y], return_inverse=True)[1]
                for i in range(y - x - 1):
                    j = i + 1 + np.flatnonzero(own[i + 1 :] != own[i])
                    j = j[100 * np.minimum(size[j], size[i]) >= per_cent * np.maximum(size[j], size[i])]
                    if len(j):
                        odd = np.bitwise_count(sketches[x + i] ^ sketches[x + j]).sum(axis=1)
                        order = np.argsort(odd, kind="stable")
                        for k in j[order[odd[order] <= limit]].tolist():
                            if own[k] != own[i]:
                                both = np.concatenate((sets[i], sets[k]))
                                both.sort(kind="stable")
                                common = int((both[1:] == both[:-1]).sum())
                                if 100 * common >= per_cent * (size[i] + size[k] - common):
                                    a.append(docs[x + i])
                                    b.append(docs[x + k])
                                    own[own == own[k]] = own[i]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _partnered(per_cent: int, limit: int):
    """From rows (cluster, part, doc, known, sketch, n) sorted by part: those that the sketches let pair with another component's."""

    @giving_back
    def run(batches):
        for table in _groups(batches, 2):
            known, size = table.column(3).to_numpy(), table.column(5).to_numpy()
            sketches = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint64).reshape(len(known), -1)
            paired = np.zeros(len(known), bool)
            for x, y in _bounds(table, 2):
                if (known[x:y] == known[x]).all():
                    continue
                for i in range(x, y - 1):
                    j = i + 1 + np.flatnonzero(known[i + 1 : y] != known[i])
                    j = j[100 * np.minimum(size[j], size[i]) >= per_cent * np.maximum(size[j], size[i])]
                    j = j[np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1) <= limit]
                    paired[j] = True
                    paired[i] |= len(j) > 0
            yield from table.filter(pa.array(paired)).select(range(5)).to_batches()

    return run


def _with_sets(df: DataFrame, key: str, text: str, wanted: DataFrame, width: int) -> DataFrame:
    """wanted: (doc, ...). Adds the sorted shingles of each document."""
    names = [c for c in wanted.columns if c != "doc"]

    @giving_back
    def run(batches):
        for batch in batches:
            for first, n, data, offsets in slices(batch, 0):
                hashes, bounds = shingle_sets(data, offsets, width)
                got = [hashes[bounds[i] : bounds[i + 1]].tobytes() for i in range(n)]
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(first, n) for k in range(1, batch.num_columns)], pa.array(got, pa.binary())], ["doc", *names, "shingles"])

    joined = df.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("__text")).join(wanted, "doc")
    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema}
    return joined.select("__text", "doc", *names).mapInArrow(run, ", ".join([f"doc {kinds['doc']}", *[f"{c} {kinds[c]}" for c in names], "shingles binary"]))


def _confirmed(df, key, text, members, width, per_cent, limit, shuffle_by=("cluster", "part")) -> DataFrame:
    """members: staged (doc, cluster, part, known, sketch); one row for each part that a document goes to."""
    docs = members.groupBy("doc").agg(F.min_by(F.struct("sketch"), "part").alias("x"), F.collect_set(F.struct("cluster", "part", "known")).alias("to"))
    docs = staged(docs.select("doc", "x.sketch", "to"))
    sets = _with_sets(df, key, text, small(docs), width).select(F.explode("to").alias("to"), "doc", "sketch", "shingles")
    rows = sets.select("to.cluster", "to.part", "doc", "to.known", "sketch", "shingles").repartition("cluster", "part").sortWithinPartitions("cluster", "part", "doc")
    out = staged(rows.mapInArrow(_set_links(per_cent, limit), "a long, b long"))
    release(docs)
    return out


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", per_cent: int = 80, width: int = 2) -> DataFrame:
    """Rows (key, n_shingles, component_id, kept): the least id that links reach, and whether that is its own."""
    limit = most_odd(per_cent / 100)
    all_rows = staged(signatures(df, key, text, width))
    some = all_rows.filter("n_shingles > 0 and doc is not null")
    same = ["n_shingles", "set1", "set2"]
    classes = staged(some.groupBy(*same).agg(F.min("doc").alias("rep")))
    n_classes = classes.count()
    reps = some.join(small(classes, n_classes), same).filter("doc = rep")
    # Buckets with more than one member; of those with the same members, one.
    dealt = reps.select("doc", F.explode("bands").alias("bucket")).distinct()
    buckets = dealt.groupBy("bucket").agg(F.count("*").alias("m"), F.min("doc").alias("low"), F.sum(F.shiftright(F.xxhash64("doc"), 20)).alias("mark")).filter("m > 1")
    buckets = staged(buckets.groupBy("m", "low", "mark").agg(F.min("bucket").alias("bucket")))
    members = staged(reps.select("doc", F.explode("bands").alias("bucket")).distinct().join(small(buckets).select("bucket", "m", "low"), "bucket"))
    large = members.filter(F.col("m") > BUCKET).select(F.col("low").alias("a"), F.col("doc").alias("b"))
    in_buckets = members.filter(F.col("m") <= BUCKET).select("bucket", "doc")
    first_of = F.min(F.struct("sketch", "n_shingles")).alias("x")
    sketched = reps.join(small(staged(members.select("doc").distinct())), "doc").groupBy("doc").agg(first_of)
    sketched = staged(sketched.select("doc", "x.sketch", F.col("x.n_shingles").alias("n")))
    n_sketched = sketched.count()
    sorted_rows = in_buckets.join(small(sketched, n_sketched), "doc").select("bucket", "doc", "sketch").repartition("bucket").sortWithinPartitions("bucket", "doc")
    near = sorted_rows.mapInArrow(_sketch_links(limit), "a long, b long").union(large)
    clusters = components(near)
    sizes = staged(clusters.groupBy("component").agg(F.count("*").alias("m")))
    parted = clusters.join(small(sizes), "component").withColumn("parts", F.ceil(F.col("m") / CLUSTER))
    parted = parted.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).join(small(sketched, n_sketched).select(F.col("doc").alias("node"), "sketch", "n"), "node")
    parted = staged(parted.select(F.col("node").alias("doc"), F.col("component").alias("cluster"), "m", "part", "parts", "sketch", "n"))
    # A few leaders go to all parts of a large cluster.
    order = F.xxhash64("doc", F.lit(7))
    lead = parted.filter("parts > 1").groupBy("cluster").agg(F.slice(F.array_sort(F.collect_list(F.when(F.abs(order) < F.lit(2**63 - 1) / F.col("parts") / CLUSTER * LEADERS, F.col("doc")))), 1, 4 * LEADERS).alias("lead"))
    leaders = parted.join(small(staged(lead.select(F.explode("lead").alias("doc")))), "doc").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    first = staged(parted.unionByName(leaders).distinct().select("doc", "cluster", "part", F.col("doc").alias("known"), "sketch"))
    links = _confirmed(df, key, text, first, width, per_cent, limit)
    if parted.filter("parts > 1").limit(1).count():
        found = components(links)
        now = staged(parted.filter("parts > 1").join(small(found).select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn("known", F.coalesce("component", "doc")).drop("component"))
        count = now.groupBy("cluster", "known").agg(F.count("*").alias("n"))
        main = staged(count.groupBy("cluster").agg(F.max_by("known", "n").alias("main")))
        now = now.join(small(main), "cluster")
        outside = now.filter("known <> main")
        left_out = staged(outside.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCKED).alias("others")))
        if left_out.limit(1).count():
            upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
            dealt = now.join(small(left_out), "cluster").withColumn("blocks", F.ceil(F.col("m") / BLOCKED))
            in_block = dealt.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks"))).withColumn("other", upto("others"))
            against = dealt.filter("known <> main").withColumn("other", F.pmod(F.xxhash64("doc", F.lit(3)), F.col("others"))).withColumn("block", upto("blocks"))
            met = in_block.unionByName(against).select("cluster", (F.col("block") * F.col("others") + F.col("other")).alias("part"), "doc", "known", "sketch", "n").distinct()
            met = met.repartition("cluster", "part").sortWithinPartitions("cluster", "part", "doc")
            second = staged(met.mapInArrow(_partnered(per_cent, limit), "cluster long, part long, doc long, known long, sketch binary"))
            links = links.union(_confirmed(df, key, text, second, width, per_cent, limit))
    found = components(links)
    named = classes.join(small(found).select(F.col("node").alias("rep"), "component"), "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    out = all_rows.select("doc", *same).join(small(named, n_classes), same, "left")
    alone = F.col("n_shingles") == 0
    component = F.when(alone | F.col("doc").isNull(), F.col("doc")).otherwise(F.col("component"))
    return out.select(F.col("doc").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))
