"""Personal data, and terms that give it away, by co-occurrence over the corpus.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers. Each distinct value of them is
a protected entity c. A term t is a word that stands within CONTEXT characters of it. Over distinct texts,
N of them, the information that t gives about c is

    PMI(t; c) = log2(N * n(t, c) / (n(t) * n(c)))      of      IC(c) = log2(N / n(c))

where n(t, c) counts texts in which t stands near c, n(t) texts with t anywhere, n(c) texts with c. A term with
PMI >= SHARE * IC, seen near c in LEAST texts at least, discloses c: its places in all texts that hold c become
spans of kind term, and sanitised() generalises them. Exact copies of a text count once. Words are runs of
letters, digits and underscores of any script, with their combining marks; what entities cover is no word.

An entity in fewer than LEAST texts is judged by the narrowest group around it that is in so many: the domain of
an address, the network of an IP address, the issuer of a card, a phone number less its last four digits; at
last, all entities of its kind. Then c above is the group. One or two texts alone are no evidence of disclosure.

n(t) is counted only for terms that could still pass when n(t) is as low as the texts in which t stands near
any entity; that bound drops common words before the corpus is counted.

Rules for odd rows: a null text counts as empty and has no spans; rows that repeat give the same spans each;
an empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import identity, small, staged

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT, SHARE, LEAST = 80, 0.9, 3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Letters, digits and underscores of any script, and combining marks, which \w leaves out.
_MARKS = [i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] == "M"]
_RUNS = [[i for _, i in g] for _, g in groupby(enumerate(_MARKS), lambda x: x[1] - x[0])]
_WORD = re.compile("[\\w" + "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in _RUNS) + "]+")

#: Slots of the bitmap that tells candidate terms from other words.
SLOTS = 1 << 18


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind and start."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _entity(kind: int, value: str) -> str:
    """One form for the ways to write an entity; a hash, so that tables hold no personal data."""
    plain = value.lower() if kind < 2 else re.sub("[^0-9]", "", value)
    return hashlib.sha256(f"{kind}:{plain}".encode()).hexdigest()[:24]


def _groups(kind: int, value: str) -> tuple[str, str, str]:
    """The entity, the group around it, its kind: hashes, narrowest first."""
    digits = re.sub("[^0-9]", "", value)
    around = (value.rpartition("@")[2].lower(), value.rpartition(".")[0], digits[:6], digits[:-4])[kind]
    return _entity(kind, value), *(hashlib.sha256(x.encode()).hexdigest()[:24] for x in (f"group {kind}:{around}", f"kind {kind}"))


def _words(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the words between the entities."""
    at = 0
    for start, end in [*sorted((a, b) for _, a, b in spans), (len(text), len(text))]:
        if start > at:
            for m in _WORD.finditer(text, at, start):
                yield m[0].lower(), m.start(), m.end()
        at = max(at, end)


def _near(text: str, spans: list[tuple[int, int, int]]) -> set[tuple[str, str]]:
    """(entity, term) of the terms near each entity, outside of all entities."""
    words = list(_words(text, spans)) if spans else []
    starts, ends = [w[1] for w in words], [w[2] for w in words]
    out = set()
    for kind, start, end in spans:
        entity = _entity(kind, text[start:end])
        for a, b in ((start - CONTEXT, start), (end, end + CONTEXT)):
            out.update((entity, w[0]) for w in words[bisect_left(starts, a) : bisect_right(ends, b)])
    return out


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _found(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (row, copy, key, n_email, n_ip, n_card, n_phone, base, held, near); copy identifies the text. Staged."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                counts, base, held, near = [[], [], [], []], [], [], []
                for t in b.column(3).to_pylist():
                    spans = base_spans(t)
                    for k in range(4):
                        counts[k].append(sum(s[0] == k for s in spans))
                    base.append(_listed(spans))
                    held.append([dict(zip(("entity", "around", "kind"), x)) for x in sorted({_groups(k, t[a:b]) for k, a, b in spans})])
                    near.append([dict(zip(("entity", "term"), x)) for x in sorted(_near(t, spans))])
                groups = pa.list_(pa.struct([("entity", pa.string()), ("around", pa.string()), ("kind", pa.string())]))
                kind = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(3)], *[pa.array(c, pa.int64()) for c in counts], pa.array(base, pa.string()), pa.array(held, groups), pa.array(near, kind)], ["row", "copy", key, "n_email", "n_ip", "n_card", "n_phone", "base", "held", "near"])

    whole = F.coalesce(F.col(text), F.lit(""))
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(_row(key, text).alias("row"), identity(whole).alias("copy"), F.col(key), whole.alias("__text"))
    return staged(rows.mapInArrow(run, f"row binary, copy binary, {key} {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, held array<struct<entity:string,around:string,kind:string>>, near array<struct<entity:string,term:string>>"))


def _row(key: str, text: str) -> Column:
    return identity(F.col(key), F.coalesce(F.col(text), F.lit("")))


def _judged(found: DataFrame, least: int) -> DataFrame:
    """Rows (entity, by, c): the narrowest group of each entity that is in enough texts, and in how many. Staged."""
    held = found.filter(F.size("held") > 0).select("copy", F.explode("held").alias("x")).select("copy", "x.*")
    groups = F.array("entity", "around", "kind")
    counts = staged(held.select("copy", F.explode(groups).alias("by")).distinct().groupBy("by").agg(F.count("*").alias("c")).filter(F.col("c") >= least))
    levels = held.select("entity", F.posexplode(groups).alias("level", "by")).distinct().join(small(counts), "by")
    return staged(levels.groupBy("entity").agg(F.min(F.struct("level", "by", "c")).alias("x")).select("entity", "x.by", "x.c"))


def _places(df: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (row, copy, term, at): the terms in each text, with their places if it holds an entity. Staged."""
    slots = bytearray(SLOTS)
    for r in terms.select(F.pmod(F.crc32("term"), F.lit(SLOTS)).alias("slot")).distinct().collect():
        slots[r["slot"]] = 1
    slots = bytes(slots)

    def run(batches: Iterator[pa.RecordBatch]):
        place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                out = [[], [], [], []]
                for row, copy, t in zip(*(c.to_pylist() for c in batch.slice(first, 256).columns)):
                    spans = base_spans(t)
                    terms: dict[str, list] = {}
                    for w, a, b in _words(t, spans):
                        terms.setdefault(w, []).append((a, b))
                    for w, at in terms.items():
                        if slots[zlib.crc32(w.encode()) % SLOTS]:
                            for c, x in zip(out, (row, copy, w, [{"start": a, "end": b} for a, b in at] if spans else [])):
                                c.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, (pa.binary(), pa.binary(), pa.string(), place))], ["row", "copy", "term", "at"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(_row(key, text).alias("row"), identity(whole).alias("copy"), whole.alias("__text"))
    # Words that share a slot with a term go here.
    return staged(rows.mapInArrow(run, "row binary, copy binary, term string, at array<struct<start:bigint,end:bigint>>").join(small(terms), "term", "left_semi").select("row", "copy", "term", "at"))


def _disclosing(df: DataFrame, found: DataFrame, judged: DataFrame, key: str, text: str, share: float, least: int) -> tuple[DataFrame, DataFrame] | None:
    """Rows (by, term), the pairs above the threshold, and _places() of the terms; None if there are no such. Staged."""
    near = found.filter(F.size("near") > 0).select("copy", F.explode("near").alias("x")).select("copy", "x.entity", "x.term")
    pairs = staged(near.join(small(judged), "entity").select("copy", "by", "term").distinct())
    joint = staged(pairs.groupBy("by", "term").agg(F.count("*").alias("tc")).filter(F.col("tc") >= least))
    texts = found.agg(F.count_distinct("copy")).first()[0]
    if not joint.limit(1).count():
        return None
    entities = judged.select("by", "c").distinct()
    least_df = pairs.groupBy("term").agg(F.count_distinct("copy").alias("t0"))
    n = F.lit(float(texts))

    def passes(t: Column) -> Column:
        return F.log2(n * F.col("tc") / (t * F.col("c"))) >= share * F.log2(n / F.col("c"))

    could = staged(joint.join(entities, "by").join(least_df, "term").filter((F.col("c") < texts) & passes(F.col("t0"))))
    terms = staged(could.select("term").distinct())
    if not terms.limit(1).count():
        return None
    places = _places(df, terms, key, text)
    counted = places.select("copy", "term").distinct().groupBy("term").agg(F.count("*").alias("t"))
    return staged(could.join(counted, "term").filter(passes(F.col("t"))).select("by", "term")), places


def find(df: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """Rows (row, key, counts of the base kinds, base, terms): spans as text; terms an array of (start, end)."""
    found = _found(df, key, text)
    judged = _judged(found, least)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    disclosing = _disclosing(df, found, judged, key, text, share, least)
    if disclosing is None:
        return found.drop("held", "near", "copy").withColumn("terms", none)
    pairs, places = disclosing
    held = found.filter(F.size("held") > 0).select("row", F.explode("held").alias("x")).select("row", "x.entity").join(small(judged), "entity").select("row", "by").distinct()
    marked = held.join(places.filter(F.size("at") > 0).select("row", "term", "at"), "row").join(small(pairs), ["by", "term"])
    terms = marked.select("row", F.explode("at").alias("x")).groupBy("row").agg(F.array_sort(F.collect_set("x")).alias("terms"))
    return found.drop("held", "near", "copy").join(terms, "row", "left").withColumn("terms", F.coalesce("terms", none))


def report(df: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """Counts, the hash of the base spans, and all spans."""
    listed = F.array_join(F.transform("terms", lambda x: F.concat_ws(":", F.lit("term"), x["start"].cast("string"), x["end"].cast("string"))), ",")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(listed != "", listed))
    return find(df, key, text, share, least).select(key, "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"))


def sanitised(df: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """Rows (key, sanitised): the text with each entity and disclosing term replaced by its kind in brackets."""
    kind_of = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for t, terms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = sorted([(a, b, k) for k, a, b in base_spans(t)] + [(x["start"], x["end"], 4) for x in terms or ()])
                parts, at = [], 0
                for a, b, k in spans:
                    if a >= at:
                        parts += [t[at:a], f"[{KINDS[k].upper()}]"]
                    at = max(at, b)
                out.append("".join([*parts, t[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, "sanitised"])

    spans = staged(find(df, key, text, share, least).filter(F.size("terms") > 0).select("row", "terms").dropDuplicates(["row"]))
    texts = df.select(_row(key, text).alias("row"), F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return texts.join(small(spans), "row", "left").select(key, "__text", "terms").mapInArrow(run, f"{key} {kind_of}, sanitised string")
