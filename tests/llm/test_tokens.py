"""Byte-level BPE and token counts against the libraries."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

from terrella.llm import bpe, token_counts  # noqa: E402

RANKS, MODEL = P.path("byte_bpe_multi_50k.tiktoken"), P.path("piece_bpe_32k.model")
ODD = "aab 's'll\n\t  　é1½²\x1c\x85ⅧZz0_#​漢字🙂ſK'ñ.,"
LONG = ["a" * 20000, "ab" * 9000, "é" * 7000, " " * 3000 + "x", "0123456789" * 900, "the" * 5000]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n=3000, seed=1, alphabet=ODD):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(30))) for _ in range(n)]


def test_encode_equals_library(library):
    c = bpe.Codec(RANKS, P.PATTERN)
    for t in [*texts(), *LONG, ""]:
        ids = c.encode(t)
        assert ids == library.encode_ordinary(t)
        assert c.decode(ids) == t.encode()


def test_merging_together_equals_merging_alone():
    c = bpe.Codec(RANKS, P.PATTERN)
    pieces = [t.encode() for t in texts(2000, 2, "abthernéß ") if t]
    assert c.merge_many(pieces) == [c.merge(p) for p in pieces]
    assert c.merge_many([]) == []


def test_learning_changes_nothing(library):
    c = bpe.Codec(RANKS, P.PATTERN)
    t = texts(1000, 3)
    c.learn([*t, None])
    assert [c.encode(x) for x in t] == [library.encode_ordinary(x) for x in t]


def test_digests_split_a_text_once_and_equal_library(library, monkeypatch):
    seen = []

    class Split:
        def findall(self, text, inner=bpe.COARSE):
            seen.append(text)
            return inner.findall(text)

    monkeypatch.setattr(bpe, "COARSE", Split())
    monkeypatch.setattr(bpe, "REMEMBERED", 500)
    c = bpe.Codec(RANKS, P.PATTERN)
    words = ["".join(random.Random(k % 700).choices("abthernéß漢字слово,", k=9)) for k in range(1500)]
    t = [*texts(500, 6), *LONG, "", None, *[" ".join(words[k : k + 9]) for k in range(1000)], "漢字" * 40 + " the " + "ñandú" * 30 + "!"]
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(range(len(x))), pa.array(x, pa.string())], ["doc_id", "text"]) for x in (t[:300], t[300:700], t[700:], t[:300])]
    order = [x for b in batches for x in b.column(1).to_pylist()]
    got = [c.digest_of(n) for _, found in bpe._learned(c, iter(batches), bpe.DIGEST) for n in found]
    assert seen == [x for x in order if x]
    assert {len(v) for v in c.made.values()} == {len(c.numbers)}  # none of the long ones is left
    want = []
    for x in order:
        ids = library.encode_ordinary(x or "")
        want.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest()))
    assert got == want
    assert c.encode(t[0]) == library.encode_ordinary(t[0]) and c.digest(t[0]) == want[0] and c.encode(LONG[1]) == library.encode_ordinary(LONG[1])


def test_rank_queue_gives_ranks_then_places():
    q, r = bpe.RankQueue(50_000), random.Random(4)
    pushed = [(r.randrange(50_000), i) for i in range(500)] + [(7, 3), (7, 1)]
    for rank, at in pushed:
        q.push(rank, at)
    got = []
    while (rank := q.first()) >= 0:
        got.append((rank, q.pop(rank)))
    assert got == sorted(pushed) and q.top == 0 and not any(q.low) and not any(q.mid)


def test_tables(spark, library):
    rows = [(1, "Is and the thnt.", 5), (1, "Is and the thnt.", 5), (2, None, 6), (3, "", 7), (None, "x" * 5000, 8)]
    d = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(d, RANKS, P.PATTERN).collect())
    want = []
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    back = bpe.decode(bpe.encode(d, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t, _ in rows)
    assert bpe.digests(d.limit(0), RANKS, P.PATTERN).collect() == []


def test_counts_equal_library():
    import sentencepiece

    lib, c = sentencepiece.SentencePieceProcessor(model_file=MODEL), token_counts.Counter(MODEL)
    for t in [*texts(4000, 5, ODD + "▁<s></s>"), *LONG, "<s>", "</s> <unk>", "<0x0A>", " ", "  ", "a ", " a", "\0", "a\n\nb\n"]:
        assert c.count(t) == len(lib.encode(t)), t
    assert len(c.proved) > 10_000


def test_count_tables(spark):
    d = spark.createDataFrame([(1, "é b"), (1, "é b"), (2, None), (3, ""), (4, "word " * 6000)], "doc_id long, text string").withColumn("n_bytes", F.lit(9))
    got = sorted((r.doc_id, r.n_bytes, r.over_limit) for r in token_counts.token_counts(d, MODEL).collect())
    assert got == [(1, 4, False), (1, 4, False), (2, 0, False), (3, 0, False), (4, 30000, True)]
    assert token_counts.token_counts(d.limit(0), MODEL).collect() == []
