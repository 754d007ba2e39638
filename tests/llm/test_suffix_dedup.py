"""Removal of repeated strings against counting every string."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from terrella.llm import suffix_dedup as D


def plain(texts, length):
    data = [(t or "").encode() for t in texts]
    n = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[:-1]
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((gone[1:] & ~gone[:-1]).sum()) + bool(len(gone) and gone[0])
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed=5):
    r = random.Random(seed)
    base = "".join(r.choice("abcdé ") for _ in range(2000))
    out = [None, "", "a" * 300, "ab" * 150, "short", base[:30], base[:30]]
    for _ in range(40):
        p = r.randrange(1500)
        t = list(base[p : p + r.randrange(400)])
        for _ in range(r.randrange(6)):
            q = r.randrange(len(t) + 1)
            t[q : q + r.randrange(3)] = [r.choice("xyz")] * r.randrange(3)
        out.append("".join(t) + "".join(r.choice("mnopq") for _ in range(r.randrange(50))))
    return out


@pytest.mark.parametrize("length, gram, stride, hot, shard, merge, core", [(20, 4, 4, 1000, 250_000, 2_000_000, 4), (40, 5, 10, 1000, 300, 2000, 8), (20, 4, 4, 2, 300, 2000, 4), (40, 5, 20, 2, 300, 2000, 6)])
def test_equals_counting(spark, monkeypatch, length, gram, stride, hot, shard, merge, core):
    for k, v in (("HOT", hot), ("SHARD", shard), ("MERGE", merge), ("CORE", core), ("HOT_CORE", core // 2)):
        monkeypatch.setattr(D, k, v)
    texts = corpus()
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in D.without_repeats(d, length=length, gram=gram, stride=stride, with_text=True).collect()}
    for i, want in enumerate(plain(texts, length)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_odd_rows(spark):
    t = "".join(random.Random(1).choice("abcdefgh") for _ in range(900))
    d = spark.createDataFrame([(1, t), (1, t), (None, t[:500]), (2, None), (3, "")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in D.without_repeats(d).collect())
    assert got == [(0, 500, 500, 1), (1, 900, 900, 1), (1, 900, 900, 1), (2, 0, 0, 0), (3, 0, 0, 0)]
    assert D.without_repeats(d.limit(0)).collect() == []


@pytest.mark.parametrize("shard", [10, 60, 10_000])
def test_merge_finds_repeats(shard):
    r = random.Random(shard)
    segments = ["".join(r.choice("ab") for _ in range(r.randrange(12, 60))).encode() for _ in range(30)]
    n = Counter(s[i : i + 12] for s in segments for i in range(len(s) - 11))
    got = D.repeated_starts(segments, np.ones(len(segments)), 12, 3, shard)
    assert [x.tolist() for x in got] == [[i for i in range(len(s) - 11) if n[s[i : i + 12]] > 1] for s in segments]
