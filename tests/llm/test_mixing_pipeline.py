"""The mix and the pipeline."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terrella.llm import mixing


def filled(sizes):
    """Targets by sharing again and again."""
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        gift = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, g in gift.items():
            target[s] += g
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("block", [7, 1024])
def test_taken(spark, sf, block):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = mixing.taken(docs, block=block).collect()
    of = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        sizes[of[r.doc_id]] += r.size
        taken[of[r.doc_id]] += r.taken
        target[of[r.doc_id]] = r.target
    want = filled(dict(sizes))
    assert all(abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.taken(docs.repartition(5), block=block).collect()))


def test_schedule_is_even(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs, block=64).select("__name", "rank", "slot").distinct().collect()
    n, at = defaultdict(int), defaultdict(list)
    for r in rows:
        n[r["__name"]] += 1
        at[r["__name"]].append((r["slot"], r["rank"]))
    total = sum(n.values())
    for s, found in at.items():
        ranks = [k for _, k in sorted(found)]
        assert ranks == list(range(n[s]))
        early = sum(slot < total / 2 for slot, _ in found)
        assert abs(early - n[s] / 2) <= 0.1 * n[s] + 3


def test_odd_rows(spark):
    d = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (None, None, "x"), (2, "", "x"), (3, "c", "x"), (4, " \n", "y")], "doc_id long, text string, source string").withColumn("size", F.lit(1))
    got = mixing.taken(d).collect()
    assert sorted((r.doc_id or 0, r["size"], r.taken) for r in got) == [(0, 0, 0), (1, 2, 2), (1, 2, 3), (2, 0, 0), (3, 1, 2), (4, 0, 0)]
    assert mixing.taken(d.limit(0)).collect() == []
    assert mixing.taken(d.filter("doc_id = 4")).first().target == 0.0


ENDS = ["f", "f f f", "if x f", "foo bar of", "\x0cabc d", "f\x0c", "\x0b\x0cf\x0c\x0b", "fff\n\x0cfff\nf", "\x1cf", "\x85 f"]


def test_words_are_what_the_contract_says(spark):
    d = spark.createDataFrame([(i, t, "s") for i, t in enumerate(ENDS)], "doc_id long, text string, source string")
    got = {r.doc_id: r["size"] for r in mixing.taken(d).collect()}
    assert got == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in enumerate(ENDS)}
    words = Counter(w for r in mixing.mixed_documents(d, block=3).collect() for w in re.findall(r"[^\x20\x09-\x0D]+", r.text))
    once = Counter(w for t in ENDS for w in re.findall(r"[^\x20\x09-\x0D]+", t))
    total = sum(once.values())
    assert sum(words.values()) == total * 3 // 2 and all(once[w] <= words[w] <= 2 * once[w] for w in once)


def test_mixed_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = out.select(F.sum(mixing.n_words("text"))).first()[0]
    assert words == mixing.taken(docs).agg(F.sum("taken")).first()[0]


def test_mixed_documents_stand_in_slot_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = defaultdict(list)
    for r in mixing.mix(docs, block=64).select("doc_id", "epoch", "rank", "slot").collect():
        first[r.doc_id].append((r.epoch, r.rank, r.slot))
    slots = {i: [min(x for x in found if x[0] == e)[2] for e in sorted({x[0] for x in found})] for i, found in first.items()}
    seen, at = Counter(), defaultdict(list)
    for r in mixing.mixed_documents(docs, block=64).withColumn("part", F.spark_partition_id()).collect():
        at[r.part].append(sorted(slots[r.doc_id]))
        seen[r.doc_id] += 1
    assert all(seen[i] == len(x) for i, x in slots.items())
    # Each row stands at one of its document's slots, and these rise in each partition.
    for rows in at.values():
        low = -1
        for x in rows:
            low = min(k for k in x if k >= low)


def test_slots_come_from_the_points(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    real = {r.doc_id: (r.taken, r.first_slot) for r in mixing.taken(docs, block=64).collect()}
    monkeypatch.setattr(mixing, "GOLDEN", 0.5)
    other = {r.doc_id: (r.taken, r.first_slot) for r in mixing.taken(docs, block=64).collect()}
    assert {i: t for i, (t, _) in real.items()} == {i: t for i, (t, _) in other.items()}
    assert sum(real[i][1] != other[i][1] for i in real) > len(real) / 2


def test_streams_are_laid_out_by_groups_of_buckets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = {r.doc_id: r.start for r in mixing.layout(docs).collect()}
    assert one == {r.doc_id: r.start for r in mixing.layout(docs, bucket=0.001).collect()}


def test_pipeline(spark, sf):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = C.quality_rules(spark, docs, sf)
    assert kept.columns == docs.columns
    kept = spark.createDataFrame(kept.collect(), docs.schema)
    from terrella.llm import quality

    verdict = {r.doc_id: r.quality.kept for r in quality.assess(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, k in verdict.items() if k}
    alone = C.minhash_near_dedup(spark, kept, sf)
    from tests.llm.test_near_dedup import plain

    want = {i for i, (_, c) in plain([(r.doc_id, r.text) for r in kept.collect()], C.SHINGLE_WORDS).items() if c == i}
    assert alone.columns == docs.columns and {r.doc_id for r in alone.collect()} == want
    last = C.run(spark, sf).collect()
    assert {r.doc_id for r in last} <= want and all(r.n_tokens > 0 for r in last)


def test_stages_on_odd_rows(spark, sf):
    """Nulls everywhere, repeated rows, clashing names, empty tables: each stage against what its docstring says."""
    import hashlib

    import corpus_pipeline as C

    body = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, body(1), "en", "a", 1), (1, body(1), "en", "a", 1), (2, body(1) + " f", None, "a", None), (3, None, None, None, None), (4, "", "en", None, 0), (None, body(5), "en", None, 3), (6, f"{body(6)} token=abcdefgh12 f", "en", "b", 3), (7, " ".join(f"v{i}" for i in range(60_000)), "en", "b", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row string, size int, slot long"
    docs = spark.createDataFrame([(*r, None, "x", 1, 2) for r in rows], schema)
    ids = lambda df: sorted(r.doc_id or 0 for r in df.collect())
    good = C.quality_rules(spark, docs, sf)
    assert ids(good) == [0, 1, 1, 2, 6, 7] and good.columns == docs.columns
    good = spark.createDataFrame(good.collect(), docs.schema)
    alone = C.minhash_near_dedup(spark, good, sf)
    assert ids(alone) == [0, 1, 1, 6, 7] and alone.columns == docs.columns
    assert ids(C.minhash_near_dedup(spark, docs, sf)) == [0, 1, 1, 3, 4, 6, 7]
    clean = C.secret_scan(spark, docs, sf)
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got[6] == f"{body(6)} [SECRET] f" and got[3] is None and got[4] == "" and got[7] == rows[-1][1] and clean.columns == docs.columns
    mixed = C.source_mix(spark, docs, sf)
    assert mixed.columns == docs.columns and not {3, 4} & set(ids(mixed)) and set(ids(mixed)) <= {0, 1, 2, 6, 7}
    last = {(r.doc_id or 0): r for r in C.bpe_tokens(spark, docs, sf).collect()}
    assert last[3].n_tokens == last[4].n_tokens == 0 and last[2].decoded_sha256 == hashlib.sha256(rows[2][1].encode()).hexdigest()
    none = docs.limit(0)
    for name, stage in C.STAGES:
        assert stage(spark, none, sf).collect() == [], name
