"""Secret scans behind a trigram inverted index, in DataFrame functions alone.

From each rule's regular expression a Boolean query over trigrams is derived: an OR of clauses, each an AND of
trigrams that any match must hold (in lower case). Of each clause the index takes the RAREST trigrams, counted on
a sample of SAMPLE documents: fewer trigrams only let more candidates through. The index lists, for each block of
documents and each such trigram, the documents that hold it. Intersecting a clause's postings gives its
candidates, and the rule's expression runs over the candidates only. A rule without mandatory trigrams scans all
texts.

Positions come from the lengths of what stands between the matches (split) and of the matches themselves, in
code points. Postings are cut into blocks of documents, so no list grows with the corpus.

Rules for odd rows: a null text counts as empty and has no spans; a row with a null id is no posting, so all
rules scan it; rows that repeat an id each get their own spans, as candidates are only a superset; an empty
table gives no rows. Very long texts take time in proportion to their length. Only the named columns are read,
all others pass through beside one struct column.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import SEPARATORS, small, staged

#: Documents of a block, about; matches that one running sum sees; pieces of a text that are cut out of one part.
BLOCK, RUN, PARTS = 4096, 256, (4096, 64)

#: Trigrams that the index holds for a clause; documents, about, on which their rarity is counted.
RAREST, SAMPLE = 2, 2000


@dataclass(frozen=True)
class Rule:
    """least: characters that the match, or its group, has to have; shorter matches are dropped.

    plain: the same expression without what only Java knows (possessive repeats, which keep it from recursing
    over long secrets); the trigrams are derived from it, and other engines can run it.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False
    plain: str = ""

    def __post_init__(self):
        object.__setattr__(self, "plain", self.plain or self.pattern)


_HEADER, _END = "-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", "-----END [A-Z ]{0,32}PRIVATE KEY-----"

#: What follows a private key's header: all up to its END line, or without one the base64 lines.
_BODY = rf"(?:[^-]*+(?:-(?!----)[^-]*+)*+{_END}|(?:(?:[{SEPARATORS}]|\\[nr])*+[A-Za-z0-9+/=]{{16,}}+)*+(?:(?:\r?\n|\\n)[A-Za-z0-9+/=]++\r?(?dm:$))?+)"
_PLAIN_BODY = rf"(?:(?:[^-]|-{{1,4}}[^-])*{_END}|(?:(?:[{SEPARATORS}]|\\[nr])*[A-Za-z0-9+/=]{{16,}})*(?:(?:\r?\n|\\n)[A-Za-z0-9+/=]+\r?(?m:$))?)"

_NAME = f"[^/{SEPARATORS}:@]"

RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", "[0-9a-f]{32,}", 0, 32, True),  # a run of hex digits is one match either way
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}+", plain="gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}+", plain="xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}+", plain="[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("private", _HEADER + _BODY, plain=_HEADER + _PLAIN_BODY),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+", plain=r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
    Rule("login", f"[a-z]{{2,10}}://{_NAME}++:{_NAME}++@", plain=f"[a-z]{{2,10}}://{_NAME}+:{_NAME}+@"),
)

#: Strings that stand for a part of an expression, and clauses, at most; beyond, the part counts as unknown.
_STRINGS, _CLAUSES = 16, 64


def _strings(op, arg) -> list[str] | None:
    """All texts that a part of an expression matches, if they are few."""
    if op is C.LITERAL:
        return [chr(arg).lower()]
    if op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= _STRINGS:
        return sorted({chr(a).lower() for _, a in arg})
    if op is C.SUBPATTERN:
        return _sequence(arg[-1])
    if op is C.BRANCH:
        found = [_sequence(x) for x in arg[1]]
        return None if any(x is None for x in found) else sorted({s for x in found for s in x})
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] is not C.MAXREPEAT and arg[1] <= 2:
        once = _sequence(arg[2])
        return None if once is None else sorted({"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(once, repeat=n)})
    return None


def _sequence(nodes) -> list[str] | None:
    out = [""]
    for op, arg in nodes:
        more = _strings(op, arg)
        if more is None or len(out) * len(more) > _STRINGS:
            return None
        out = [a + b for a, b in product(out, more)]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Clauses of mandatory trigrams, any of which a text with a match fulfils; None: no such query."""
    clauses, run = [frozenset()], [""]

    def closed() -> list[frozenset[str]]:
        fresh = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        return clauses if frozenset() in fresh or len(clauses) * len(fresh) > _CLAUSES else [a | b for a in clauses for b in fresh]

    for op, arg in parser.parse(pattern):
        more = _strings(op, arg)
        if more is not None and len(run) * len(more) <= _STRINGS:
            run = [a + b for a, b in product(run, more)]
        else:
            clauses, run = closed(), more or [""]
    found = [c for c in closed() if c]
    return sorted(set(found), key=sorted) if len(found) == len(closed()) else None


def _held(trigrams: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.contains(F.col("__lower"), F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))


def _postings(lower: DataFrame, trigrams: list[str], blocks: int) -> DataFrame:
    """The inverted index: rows (__block, __trigram, __ids)."""
    listed = lower.select("__id", F.explode(_held(trigrams)).alias("__trigram")).withColumn("__block", F.pmod(F.xxhash64("__id"), F.lit(blocks)))
    return listed.groupBy("__block", "__trigram").agg(F.collect_set("__id").alias("__ids"))


def _rarest(lower: DataFrame, n: int, queries: dict[int, list[frozenset[str]] | None]) -> dict[int, list[frozenset[str]] | None]:
    """The queries with the rarest trigrams of each clause; of equally rare ones those that other clauses have too."""
    trigrams = sorted({t for q in queries.values() for c in q or () for t in c})
    some = lower.filter(F.pmod(F.xxhash64("__id", F.lit(5)), F.lit(1_000_000)) < int(1_000_000 * SAMPLE / max(n, 1)) + 1)
    counts = dict(enumerate([0] * len(trigrams))) | {r["t"]: r["count"] for r in some.select(F.explode(_held(trigrams)).alias("t")).groupBy("t").count().collect()}
    often = {t: counts[i] for i, t in enumerate(trigrams)}
    shared = {t: sum(t in c for q in queries.values() for c in q or ()) for t in trigrams}
    return {i: q and [frozenset(sorted(c, key=lambda t: (often[t], -shared[t], t))[:RAREST]) for c in q] for i, q in queries.items()}


def candidates(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """Rows (__id, __rules): a bit for each rule whose query the document fulfils. And the bits of rules without a query."""
    spark, n = df.sparkSession, df.count()
    lower = df.select(F.col(key).alias("__id"), F.lower(F.col(text)).alias("__lower")).filter(F.col("__id").isNotNull() & F.col("__lower").isNotNull())
    queries = _rarest(lower, n, {i: trigram_query(r.plain) for i, r in enumerate(rules)})
    trigrams = sorted({t for q in queries.values() for c in q or () for t in c})
    always = sum(1 << i for i, q in queries.items() if q is None)
    postings = _postings(lower, trigrams, max(1, n // BLOCK))
    number = {t: i for i, t in enumerate(trigrams)}
    # As large as the rules, whatever the corpus.
    clauses = [(1 << i, f"{i}.{k}", len(c), number[t]) for i, q in queries.items() if q for k, c in enumerate(q) for t in c]
    wanted = spark.createDataFrame(clauses, "__bit long, __clause string, __need int, __trigram int")
    lists = postings.join(F.broadcast(wanted), "__trigram").groupBy("__block", "__clause", "__bit", "__need").agg(F.collect_list("__ids").alias("__lists"))
    both = F.aggregate(F.slice("__lists", 2, F.size("__lists")), F.element_at("__lists", 1), lambda a, b: F.array_intersect(a, b))
    hits = lists.filter(F.size("__lists") == F.col("__need")).select("__bit", F.explode(both).alias("__id"))
    return staged(hits.groupBy("__id").agg(F.bit_or("__bit").alias("__rules"))), always


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use).getItem(0)


def _runs(items: Column, size: int) -> Column:
    """A non-empty array, cut into arrays of so many."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")), lambda r: F.slice(items, r * size + 1, F.lit(size)))


def _prefixes(items: Column, zero: Column, step, kind: str) -> Column:
    """The state, a struct of type kind, after each item. It goes over RUN items, then over such runs, as an array that
    grows item by item is copied each time."""
    none = F.array().cast(f"array<{kind}>")

    def run_of(run, base):
        more = lambda a, x: _let(step(a["at"], x), lambda v: F.struct(v.alias("at"), F.concat(a["found"], F.array(v)).alias("found")))
        return F.aggregate(run, F.struct(base.alias("at"), none.alias("found")), more)

    def all_runs(rs):
        more = lambda a, r: _let(run_of(r, a["at"]), lambda x: F.struct(x["at"].alias("at"), F.concat(a["found"], F.array(x["found"])).alias("found")))
        return F.flatten(F.aggregate(rs, F.struct(zero.cast(kind).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("found")), more)["found"])

    return F.when(F.size(items) == 0, none).otherwise(_let(_let(items, lambda x: _runs(x, RUN)), all_runs))


def _running(items: Column) -> Column:
    """From structs (gap, length, ok): (start, end, ok)."""

    def step(a, x):
        start = a["end"] + x["gap"]
        return F.struct(start.alias("start"), (start + x["length"]).alias("end"), x["ok"].alias("ok"))

    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(False).alias("ok"))
    return _prefixes(items, zero, step, "struct<start:bigint,end:bigint,ok:boolean>")


def _spans(rule: Rule, at: int, text: Column) -> Column:
    """Structs (start, kind number, end) of the rule's matches in a text."""
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    items = F.zip_with(
        F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("length"))),
        F.transform(measured, lambda m: F.length(m) >= rule.least),
        lambda x, ok: F.struct(x["gap"].alias("gap"), x["length"].alias("length"), ok.alias("ok")),
    )
    real = F.filter(items, lambda x: x["length"].isNotNull())  # what stands after the last match is no match
    kept = F.filter(_running(real), lambda x: x["ok"])
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(at).alias("kind"), x["end"].alias("end")))


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", out: str = "secrets") -> DataFrame:
    """df with an array column of (start, kind number, end) by start, then kind; code points, end exclusive."""
    hits, always = candidates(df, rules, key, text)
    own = [c for c in df.columns if c != out]
    every = (1 << len(rules)) - 1
    d = df.select(*own, F.coalesce(F.col(text), F.lit("")).alias("__text"), F.col(key).alias("__id")).join(small(hits), "__id", "left")
    mask = F.when(F.col("__id").isNull(), F.lit(every)).otherwise(F.coalesce(F.col("__rules"), F.lit(0)).bitwiseOR(F.lit(always)))
    d = d.withColumn("__mask", mask)
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    parts = [F.when((F.col("__mask").bitwiseAND(F.lit(1 << i)) != 0) & F.col("__text").rlike(r.pattern), _spans(r, i, F.col("__text"))).otherwise(none) for i, r in enumerate(rules)]
    return d.select(*own, F.array_sort(F.concat(*parts)).alias(out))


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans."""
    d = scan(df, rules, key, text, "__spans")
    base = [i for i, r in enumerate(rules) if r.base]
    of_base = F.filter("__spans", lambda s: s["kind"].isin(base))

    def count(i: int) -> Column:
        return F.size(F.filter("__spans", lambda s: s["kind"] == i)).cast("long").alias(f"n_{rules[i].kind}")

    counts = [count(i) for i in base]
    return d.select(key, *counts, F.sha2(listed(of_base, rules), 256).alias("base_sha256"), listed(F.col("__spans"), rules).alias("spans"))


def _merged(spans: Column) -> Column:
    """Structs (start, end) of the runs of sorted spans that overlap."""

    def step(a, s):
        apart = s["start"] >= a["end"]
        return F.struct(F.when(apart, s["start"]).otherwise(a["start"]).alias("start"), F.greatest(a["end"], s["end"]).alias("end"), apart.alias("apart"))

    zero = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.lit(True).alias("apart"))
    upto = _prefixes(spans, zero, step, "struct<start:bigint,end:bigint,apart:boolean>")
    # A run's last state is the one before a span that is apart.
    last = lambda a: F.zip_with(a, F.slice(a, 2, F.size(a)), lambda x, y: F.when(F.coalesce(y["apart"], F.lit(True)), F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    return F.filter(_let(upto, last), lambda x: x.isNotNull())


def _pieces(text: Column, cuts: Column, base: Column, sizes: tuple[int, ...] = PARTS) -> Column:
    """What stands in a text, whose first character is number base, at each of the structs (start, end), in order.

    Parts of many pieces are cut out first, and pieces out of these, as a cut reads its text from the start.
    """
    at = lambda t, x, y, b: F.substr(t, (x - b + 1).cast("int"), (y - x).cast("int"))
    if not sizes:
        return F.transform(cuts, lambda c: at(text, c["start"], c["end"], base))

    def of_run(run):
        start, end = F.element_at(run, 1)["start"], F.element_at(run, -1)["end"]
        return _let(F.struct(at(text, start, end, base).alias("t"), start.alias("b")), lambda p: _pieces(p["t"], run, p["b"], sizes[1:]))

    return F.flatten(F.transform(_runs(cuts, sizes[0]), of_run))


def redacted(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]", length: str | None = "n_chars") -> DataFrame:
    """df with each secret in its text, or run of secrets that overlap, replaced by a mark."""
    d = scan(df, rules, key, text, "__spans")
    t = F.col(text)

    def between(m):
        """From merged spans: what stands before, between and after them."""
        zero = F.lit(0).cast("long")
        starts = F.concat(F.array(zero), F.transform(m, lambda x: x["end"]))
        ends = F.concat(F.transform(m, lambda x: x["start"]), F.array(F.length(t).cast("long")))
        return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))

    clean = F.array_join(_let(_let(_merged(F.col("__spans")), between), lambda cuts: _pieces(t, cuts, F.lit(0).cast("long"))), mark)
    # A step of its own: inside a lambda, a name means the select's new column of that name before the old one.
    d = d.withColumn("__clean", F.when(F.size("__spans") > 0, clean))
    fresh = {text: F.coalesce(F.col("__clean"), t)}
    if length in df.columns:
        fresh[length] = F.coalesce(F.length("__clean").cast("long"), F.col(length))
    return d.select(*[fresh.get(c, F.col(c)).alias(c) for c in df.columns])


__all__ = ["RULES", "Rule", "candidates", "listed", "redacted", "report", "scan", "trigram_query"]
