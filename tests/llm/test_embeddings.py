"""Embedding links against all pairs."""

import numpy as np
import pytest

from terrella.llm import embedding_dedup as E
from tests.llm.test_near_dedup import least


def plain(rows, threshold=0.95):
    ids = sorted(i for i, _ in rows)
    x = np.array([dict(rows)[i] for i in ids], float)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    a, b = np.nonzero(np.triu(x @ x.T >= threshold, 1))
    pairs = [(ids[i], ids[j]) for i, j in zip(a, b)]
    n = {i: sum(i in p for p in pairs) for i in ids}
    c = least(pairs, ids)
    return {i: (n[i], c[i]) for i in ids}


@pytest.mark.parametrize("block", [4096, 3])
def test_links_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    r = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        centre = r.standard_normal(16)
        rows += [(centre + r.standard_normal(16) * r.choice([0, 0.05, 0.2, 0.25])).tolist() for _ in range(r.integers(1, 8))]
    rows = list(enumerate(rows))
    got = {x.vec_id: (x.n_links, x.component_id) for x in E.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = plain(rows)
    assert sum(n for n, _ in want.values()) > 100 and got == want


def test_recall_of_queries_against_all_rows(spark):
    """32-bit vectors with links around the threshold: the query set is the ids divisible by 100."""
    r = np.random.default_rng(11)
    rows = []
    for _ in range(700):
        centre = r.standard_normal(32)
        rows += [(centre + r.standard_normal(32) * s).astype(np.float32).tolist() for s in r.choice([0, 0.05, 0.2, 0.23, 0.26], r.integers(1, 9))]
    r.shuffle(rows)
    rows = list(enumerate(rows))
    got = {x.vec_id: (x.n_links, x.component_id) for x in E.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    x = np.array([v for _, v in rows], float)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    asked = range(0, len(rows), 100)
    assert sum(want[i] for i in asked) > 30 and all(got[i][0] == want[i] for i in asked)
    assert sum(got[i][0] for i in got) == want.sum() and got == plain(rows)


def test_keys_do_not_depend_on_the_batch():
    x = E._units(np.random.default_rng(1).standard_normal((500, 48)))
    whole = E._keys(x, 17, 90)
    assert all((E._keys(x[a : a + n], 17, 90) == whole[a : a + n]).all() for a, n in ((0, 1), (3, 7), (100, 333)))


def test_an_id_on_several_vectors(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.linked_vectors(d).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4)]


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [float("nan"), 1.0, 1.0]), (7, [None, 1.0, 1.0]), (8, [0.0, 1.0, 0.0]), (9, []), (None, [1.0, 0.0, 0.0]), (11, [-0.0, 1e300, 0.0]), (12, [1.0, 0.0])]
    d = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, keys long")
    got = sorted({(r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in E.linked_vectors(d).collect()})
    assert got == [(0, 0, 0, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 8, True), (9, 0, 9, True), (11, 1, 8, False), (12, 0, 12, True)]
    assert E.linked_vectors(d.limit(0)).collect() == []


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(9)
    x = r.standard_normal((400, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    turned = x @ E.rotations(64, E.ROTATIONS * 64).T
    signs = np.packbits(turned > 0, axis=1)
    factor = np.abs(turned).sum(axis=1) / (E.ROTATIONS * 8)
    near, bound = E.estimates(signs, factor, turned, 64)
    off = (near - x @ x.T)[~np.eye(400, dtype=bool)]
    assert abs(off.mean()) < 0.003 and (np.abs(near - x @ x.T) <= bound + 1e-6).mean() > 0.9999
