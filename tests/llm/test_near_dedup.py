"""Near-dedup and components against all pairs."""

import random
import re
from unittest.mock import MagicMock

import numpy as np
import pytest

from terrella.llm import near_dedup as N
from terrella.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width=2):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()


def least(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def plain(rows, width=2):
    sets = {i: shingles(t, width) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    c = least(pairs, ids)
    return {i: (len(sets[i]), c[i]) for i in ids}


def corpus(seed=2):
    r = random.Random(seed)
    out = []
    for _ in range(25):
        base = [r.choice(["the", "of", "Word", "é", *[f"w{k}" for k in range(300)]]) for _ in range(r.choice([1, 2, 5, 40, 300]))]
        for _ in range(r.randrange(1, 9)):
            copy = list(base)
            for _ in range(int(len(copy) * r.choice([0, 0.02, 0.04, 0.05, 0.07]))):
                copy[r.randrange(len(copy))] = f"x{r.randrange(999)}"
            out.append((" " if r.random() < 0.8 else "\n").join(copy))
    return list(enumerate(out))


@pytest.mark.parametrize("width", [2, 5])
@pytest.mark.parametrize("bucket, cluster, leaders, blocked", [(512, 256, 8, 1024), (2, 2, 1, 3)])
def test_components_equal_all_pairs(spark, monkeypatch, bucket, cluster, leaders, blocked, width):
    monkeypatch.setattr(N, "BLOCKED", blocked)
    monkeypatch.setattr(N, "BUCKET", bucket)
    monkeypatch.setattr(N, "CLUSTER", cluster)
    monkeypatch.setattr(N, "LEADERS", leaders)
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width).collect()}
    assert got == plain(rows, width)


def test_cluster_without_a_main_component(spark, monkeypatch):
    """Pages of one template, alike at about 0.7, of which a few are near copies."""
    monkeypatch.setattr(N, "CLUSTER", 8)
    monkeypatch.setattr(N, "LEADERS", 1)
    monkeypatch.setattr(N, "BLOCKED", 16)
    r = random.Random(9)
    template = [f"t{k}" for k in range(100)]
    rows = [(i, " ".join(template + [f"p{i}w{k}" for k in range(22)])) for i in range(70)]
    rows += [(100 + i, f"{rows[r.randrange(70)][1]} more{i}") for i in range(12)]
    r.shuffle(rows)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain(rows)


def test_odd_rows(spark):
    d = spark.createDataFrame([(1, "a b", 0), (1, "a b", 0), (None, "a b", 0), (2, "", 0), (3, None, 0), (4, "A  b", 0), (5, "x", 0), (6, "X", 0)], "doc_id long, text string, rep long")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in N.near_duplicates(d).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 1, False), (5, 5, True), (6, 5, False)]
    assert N.near_duplicates(d.limit(0)).collect() == []


def test_sketches_estimate_similarity():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
    for common in (900, 950, 990):
        a, b = pool[:1000], np.concatenate((pool[:common], pool[2000 : 3000 - common]))
        s = N.odd_sketches(np.stack([N.minhash(a), N.minhash(b)]))
        odd = int(np.bitwise_count(s[0] ^ s[1]).sum())
        assert abs(float(N.similarity(np.array(odd))) - common / (2000 - common)) < 0.1
        assert odd <= N.most_odd(0.8)


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(300)] + [(7, 7), (8, 9), (8, 9)]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == least([e for e in edges if e[0] != e[1]], nodes)
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_workers_give_memory_back(monkeypatch):
    from terrella.llm import workers

    class Runs(list):
        """Takes the place of a table; keeps what workers would run on it."""

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            self.append(run)

    times = []
    monkeypatch.setattr(workers, "give_back", lambda: times.append(1))
    monkeypatch.setattr(N, "F", MagicMock())
    tables = Runs()
    N.signatures(tables, "doc_id", "text")
    for k, run in enumerate([*tables, N._sketch_links(1), N._set_links(80, 1), N._partnered(80, 1)]):
        assert list(run(iter([]))) == [] and len(times) == k + 1
