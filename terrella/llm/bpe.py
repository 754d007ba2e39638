"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of tokens. Each pair of neighbours that can merge stands in the bucket
of its merge rank, as the position of its left token. A bitmap over the ranks, with a summary bit for
each 64 of them and again for each 64 of those, tells the lowest rank in use by three find-first-set
steps, whatever the length of the pre-token. A bucket hands out its positions from left to right.
Entries whose pair has changed since are stale and skipped when they come up.

Long pre-tokens go through the queue one at a time. Short ones go through it together: the lists of all
new pre-tokens of a batch stand in the same arrays, a bucket holds positions from many of them, and one
step takes the leftmost valid position of each pre-token. As pre-tokens don't touch, that merges each in
its own order.

A text is split once, into coarse pieces, each of which gets a number; what is wanted of a text (its ids, their
decimals, what they decode to) is then put together from what its numbers stand for. Encoding and decoding go
through ids in either case; they are done once for each piece that is remembered.

Rules for odd rows: a null text counts as empty and has no tokens; repeated rows each get their own
result; columns other than the two that are named are not read, so clashing names do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.llm.workers import give_back

#: Pieces that a worker may remember when the next ones are learned, and the longest remembered (characters).
REMEMBERED, REMEMBERED_LENGTH = 400_000, 48

#: Bytes up to which new pre-tokens go through the queue one at a time.
ALONE = 200

#: Bytes of text whose new pre-tokens go through the queue together.
TOGETHER = 4_000_000

#: The white space of Unicode, as the rank files' pattern means by \s.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

#: Coarse pieces, each of them a run of whole matches of the pattern: a run of Latin letters before an
#: ASCII character or the end, else what white space bounds.
COARSE = re.compile(f" ?[A-Za-zÀ-ÖØ-öø-ɏ]++(?=[\\x00-\\x7f]|\\Z)| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


class RankQueue:
    """Positions by merge rank; the lowest rank first, in it the leftmost position."""

    def __init__(self, n_ranks: int):
        self.low = [0] * ((n_ranks >> 6) + 1)
        self.mid = [0] * ((n_ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            w = rank >> 6
            self.low[w] |= 1 << (rank & 63)
            m = w >> 6
            self.mid[m] |= 1 << (w & 63)
            self.top |= 1 << m
        else:
            heappush(bucket, position)

    def push_all(self, rank: int, positions: np.ndarray) -> None:
        """For merges of many pre-tokens together: a bucket is then a list of arrays."""
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.push(rank, positions)
        else:
            bucket.append(positions)

    def take_all(self, rank: int) -> np.ndarray:
        """All positions of a bucket, sorted and each once; the bucket is empty then."""
        bucket = self.buckets[rank]
        found = bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))
        del bucket[1:]
        self.pop(rank)
        return found

    def first(self) -> int:
        """The lowest rank in use; -1 if there is none."""
        top = self.top
        if not top:
            return -1
        m = (top & -top).bit_length() - 1
        word = self.mid[m]
        w = (m << 6) + (word & -word).bit_length() - 1
        word = self.low[w]
        return (w << 6) + (word & -word).bit_length() - 1

    def pop(self, rank: int) -> int:
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            w = rank >> 6
            self.low[w] ^= 1 << (rank & 63)
            if not self.low[w]:
                m = w >> 6
                self.mid[m] ^= 1 << (w & 63)
                if not self.mid[m]:
                    self.top ^= 1 << m
        return position


class _Numbers(dict):
    """Numbers of coarse pieces: from 0 those that are remembered, from -1 downwards the long ones of a batch."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.long: list[str] = []

    def __missing__(self, piece: str) -> int:
        if len(piece) > REMEMBERED_LENGTH:
            self.long.append(piece)
            return -len(self.long)
        self.new.append(piece)
        self[piece] = n = len(self)
        return n


class Codec:
    """Encodes and decodes with the ranks of a .tiktoken file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.wide = max(self.ranks.values()) + 1
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.merges: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.merges[a * self.wide + b] = rank
        self.queue = RankQueue(self.wide)
        self.keys = np.array(sorted(self.merges), np.int64)
        self.at_key = np.array([self.merges[k] for k in self.keys.tolist()], np.int64)
        # White space is spelled out, as \s differs from library to library.
        self.split = regex.compile(pattern.replace("[^\\s", f"[^{WHITE}").replace("\\s", f"[{WHITE}]").replace("\\S", f"[^{WHITE}]")).findall
        self.decimal = {r: b"%d" % r for r in self.bytes_of}
        self.bytes_in, self.digits_in = np.zeros(self.wide, np.int64), np.zeros(self.wide, np.int64)
        for r, t in self.bytes_of.items():
            self.bytes_in[r], self.digits_in[r] = len(t), len(self.decimal[r])
        self.of_bytes = np.array(self.single, np.int64)
        self.byte_pairs = self._ranks(np.repeat(self.of_bytes, 256), np.tile(self.of_bytes, 256))
        self._forget(())

    def _forget(self, wanted: tuple[str, ...]) -> None:
        """Nothing is remembered, and of what comes wanted will be: for each of it, a list by number."""
        self.numbers = _Numbers()
        self.made: dict[str, list] = {w: [] for w in wanted}

    def merge(self, data: bytes) -> list[int]:
        """All merges of one pre-token, lowest rank first and leftmost among equals."""
        single, merges, wide, queue = self.single, self.merges, self.wide, self.queue
        token = [single[b] for b in data]
        n = len(token)
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        pair = [-1] * (n + 1)  # the rank at which a token merges with its right neighbour now
        push, look = queue.push, merges.get
        left = token[0]
        for i in range(n - 1):
            right = token[i + 1]
            rank = look(left * wide + right, -1)
            if rank >= 0:
                pair[i] = rank
                push(rank, i)
            left = right
        while (rank := queue.first()) >= 0:
            i = queue.pop(rank)
            if pair[i] != rank:
                continue
            j = after[i]
            k = after[j]
            token[i] = rank
            token[j] = -1
            pair[j] = -1
            after[i] = k
            if k < n:
                before[k] = i
                new = look(rank * wide + token[k], -1)
                pair[i] = new
                if new >= 0:
                    push(new, i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                new = look(token[h] * wide + rank, -1)
                if new != pair[h]:
                    pair[h] = new
                    if new >= 0:
                        push(new, h)
        return [t for t in token if t >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.wide + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.at_key[at], -1)

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """What merge() gives for each of many pre-tokens, all of them non-empty."""
        if not pieces:
            return []
        ids, counts = self._merge_together(pieces)
        ids, ends = ids.tolist(), counts.cumsum().tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All their ids, and how many each has."""
        queue = self.queue
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        token = self.of_bytes[data]
        n = len(token)
        of = np.repeat(np.arange(len(pieces)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        pair = np.full(n, -1, np.int64)
        inner = np.flatnonzero(after >= 0)
        pair[inner] = self.byte_pairs[data[inner].astype(np.int64) * 256 + data[inner + 1]]
        self._push_grouped(pair[inner], inner)
        while (rank := queue.first()) >= 0:
            i = queue.take_all(rank)
            i = i[pair[i] == rank]
            if not len(i):
                continue
            if len(i) > 1:
                w = of[i]
                leftmost = np.concatenate(([True], w[1:] != w[:-1]))
                if not leftmost.all():
                    queue.push_all(rank, i[~leftmost])
                    i = i[leftmost]
            j = after[i]
            k = after[j]
            token[i] = rank
            token[j] = -1
            pair[j] = -1
            after[i] = k
            more = k >= 0
            left, k = i[more], k[more]
            before[k] = left
            pair[i] = -1
            h = before[i]
            with_h = h >= 0
            h = h[with_h]
            at = np.concatenate((left, h))
            new = self._ranks(token[at], np.concatenate((token[k], np.full(len(h), rank))))
            changed = new != pair[at]
            pair[at] = new
            self._push_grouped(new[changed], at[changed])
        live = token >= 0
        return token[live], np.add.reduceat(live, ends - sizes, dtype=np.int64)

    def _push_grouped(self, rank: np.ndarray, position: np.ndarray) -> None:
        valid = rank >= 0
        rank, position = rank[valid], position[valid]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        rank, position = rank[order], position[order]
        starts = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1]))).tolist()
        for r, a, b in zip(rank[starts].tolist(), starts, [*starts[1:], len(rank)]):
            self.queue.push_all(r, np.sort(position[a:b]) if b - a > 1 else position[a:b])

    def learn(self, texts: Iterable[str | None], wanted: tuple[str, ...] = ("ids",)) -> list[list[int]]:
        """The numbers of each text's coarse pieces, good until the next call; new pieces go through the queue together."""
        # Before and not after: what is forgotten once the new ones are known would be merged alone.
        if tuple(self.made) != wanted or len(self.numbers) > REMEMBERED:
            self._forget(wanted)
        self.drop_long()
        numbers = self.numbers
        number = numbers.__getitem__
        found = [list(map(number, COARSE.findall(t))) if t else [] for t in texts]
        new, long, numbers.new = numbers.new, numbers.long, []
        if new or long:
            self._make([*new, *reversed(long)])  # the last stand at -1
        return found

    def drop_long(self) -> None:
        """The pieces that are too long to be remembered go."""
        for values in self.made.values():
            del values[len(self.numbers) :]
        self.numbers.long = []

    def _make(self, pieces: list[str]) -> None:
        """Add to each list what is wanted of coarse pieces."""
        split = list(map(self.split, pieces))
        parts = list(set(chain.from_iterable(split)))
        data = list(map(str.encode, parts))
        rank = list(map(self.ranks.get, data))
        short = [k for k, r in enumerate(rank) if r is None and len(parts[k]) <= REMEMBERED_LENGTH]
        alone = [k for k, r in enumerate(rank) if r is None and len(parts[k]) > REMEMBERED_LENGTH]
        if sum(len(data[k]) for k in short) <= ALONE:
            short, alone = [], [*short, *alone]
        merged = [self.merge(data[k]) for k in alone]
        ids, counts = np.array([i for x in merged for i in x], np.int64), np.array([len(x) for x in merged], np.int64)
        if short:
            more = self._merge_together([data[k] for k in short])
            ids, counts = np.concatenate((ids, more[0])), np.concatenate((counts, more[1]))
        which = [*alone, *short]
        for name, values in self.made.items():
            of, made = self._values(name, rank, ids, counts)
            for k, v in zip(which, made):
                of[k] = v
            of = dict(zip(parts, of))
            if name == "ids":
                values.extend([of[x[0]] if len(x) == 1 else tuple(chain.from_iterable(map(of.__getitem__, x))) for x in split])
            else:
                joined = b"," if name == "listed" else b""
                values.extend([of[x[0]] if len(x) == 1 else joined.join(map(of.__getitem__, x)) for x in split])

    def _values(self, name: str, rank: list[int | None], ids: np.ndarray, counts: np.ndarray) -> tuple[list, list]:
        """What is wanted of pre-tokens that are tokens (null: of others), and of those that have so many of the ids each."""
        if not len(ids):
            cut = np.zeros(1, np.int64)
        elif name == "ids":
            cut = np.concatenate(([0], counts.cumsum()))
        else:
            size = self.digits_in[ids] + 1 if name == "listed" else self.bytes_in[ids]
            cut = np.concatenate(([0], np.concatenate(([0], size.cumsum()))[counts.cumsum()]))
        ids, cut = ids.tolist(), cut.tolist()
        if name == "ids":
            return [None if r is None else (r,) for r in rank], [tuple(ids[a:b]) for a, b in zip(cut, cut[1:])]
        if name == "listed":
            whole = b",".join(map(self.decimal.__getitem__, ids))
            return list(map(self.decimal.get, rank)), [whole[a : b - 1] for a, b in zip(cut, cut[1:])]
        whole = self.decode(ids)
        return list(map(self.bytes_of.get, rank)), [whole[a:b] for a, b in zip(cut, cut[1:])]

    def encode(self, text: str | None) -> list[int]:
        return self.ids_of(self.learn([text])[0])

    def ids_of(self, numbers: list[int]) -> list[int]:
        """For numbers that learn() gave for ids."""
        return list(chain.from_iterable(map(self.made["ids"].__getitem__, numbers)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Tokens, the hash of the ids' decimals joined by commas, and the hash of what they decode to."""
        return self.digest_of(self.learn([text], DIGEST)[0])

    def digest_of(self, numbers: list[int]) -> tuple[int, str, str]:
        """The same for numbers that learn() gave for DIGEST."""
        listed = b",".join(map(self.made["listed"].__getitem__, numbers))
        decoded = b"".join(map(self.made["decoded"].__getitem__, numbers))
        return listed.count(b",") + 1 if listed else 0, hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest()


#: What digest() is made from.
DIGEST = ("listed", "decoded")

_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary and Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _learned(c: Codec, batches: Iterator[pa.RecordBatch], wanted: tuple[str, ...], rows: int = 256) -> Iterator[tuple[pa.Array, list[list[int]]]]:
    """Keys and the numbers of texts in small slices; before that, the codec has learned the pieces of some MB of them.

    Workers outlive tasks, so at its end a task gives back the memory that it took but for what is remembered.
    """
    try:
        for batch in batches:
            size = batch.num_rows and max(1, min(batch.num_rows, batch.num_rows * TOGETHER // max(1, batch.nbytes)))
            for start in range(0, batch.num_rows, size or 1):
                part = batch.slice(start, size)
                found = c.learn((t.as_py() for t in part.column(1)), wanted)
                for at in range(0, part.num_rows, rows):
                    yield part.column(0).slice(at, rows), found[at : at + rows]
    finally:
        c.drop_long()
        give_back()


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, ids array<int>): the ids of each whole text. No shuffle; memory is bounded by a batch."""

    def run(batches):
        c = codec(path, pattern)
        for k, found in _learned(c, batches, ("ids",)):
            yield pa.RecordBatch.from_arrays([k, pa.array([c.ids_of(x) for x in found], pa.list_(pa.int32()))], [key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Rows (key, decoded binary): the bytes that each list of ids stands for; null ids give none."""

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or ()) for x in b.column(1).to_pylist()], pa.binary())], [key, "decoded"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, ids).mapInArrow(run, f"{key} {kind}, decoded binary")


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_tokens, ids_sha256, decoded_sha256): encode, decode and hash without shipping the ids."""

    def run(batches):
        c = codec(path, pattern)
        for k, found in _learned(c, batches, DIGEST):
            n, listed, back = zip(*map(c.digest_of, found))
            yield pa.RecordBatch.from_arrays([k, pa.array(n, pa.int64()), pa.array(listed, pa.string()), pa.array(back, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
