"""Token counts with a whole-token shortcut, for the sentencepiece BPE vocabulary.

The vocabulary has no piece in which a space mark follows another character, so no merge crosses the
start of a run of space marks, and none that holds a line feed: a text splits there into pre-tokens that
encode alone. Before any text is read, each vocabulary string of that form is encoded by itself; those that
come back as their one token are proved, and a pre-token that equals one counts 1 without any merge. Only
other pre-tokens are merged.

Rules for odd rows: a null or empty text has no tokens; repeated rows each get their own result; columns
other than the two named are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

MARK = "▁"

#: Counts that a worker remembers for pre-tokens that need merges, and the longest remembered.
REMEMBERED, REMEMBERED_LENGTH = 500_000, 48

_PRE = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


class Counter(dict):
    """Tokens by pre-token: the proved ones for good, others as long as there is room."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = [p for i, p in enumerate(pieces) if (MARK in p.lstrip(MARK) or "\n" in p) and not self.model.is_control(i)]
        if crossing or self.model.encode("a b") != self.model.encode("a") + self.model.encode("b") or self.model.encode(" ") == []:
            raise ValueError(f"{path}: its pieces or its normaliser join what stands on both sides of a space")
        self.proved = self.prove(pieces)
        self.update(self.proved)
        self.extra = 0

    def prove(self, pieces: list[str]) -> dict[str, int]:
        """The vocabulary strings that encode alone as the one token that they are."""
        forms = [(i, p) for i, p in enumerate(pieces) if _PRE.fullmatch(p) and p != MARK]
        ids = self.model.encode([self._alone(p) for _, p in forms], num_threads=1)
        return {p: 1 for (i, p), got in zip(forms, ids) if got[self._before(p) :] == [i]} | {MARK: 1}

    @staticmethod
    def _alone(pre: str) -> str:
        """A text that ends in the pre-token. The model puts a first mark before any text; it stays apart from what follows a line feed."""
        return pre[1:] if pre[0] == MARK else "\n" + pre

    @staticmethod
    def _before(pre: str) -> int:
        return 0 if pre[0] == MARK else 2

    def __missing__(self, pre: str) -> int:
        n = len(self.model.encode(self._alone(pre))) - self._before(pre)
        if len(pre) <= REMEMBERED_LENGTH:
            if self.extra >= REMEMBERED:
                self.clear()
                self.update(self.proved)
                self.extra = 0
            self[pre] = n
            self.extra += 1
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, _PRE.findall(MARK + text.replace(" ", MARK))))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(df: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_bytes, n_tokens, over_limit) for each whole text. No shuffle."""

    def run(batches):
        c = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                n = pa.array([c.count(t) for t in b.column(1).to_pylist()], pa.int64())
                size = pc.fill_null(pc.cast(pc.binary_length(b.column(1)), pa.int64()), 0)
                yield pa.RecordBatch.from_arrays([b.column(0), size, n, pc.greater(n, limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"{key} {kind}, n_bytes long, n_tokens long, over_limit boolean")
