"""Quality rules with cross-document line frequency, in DataFrame functions alone.

Each line is normalised (lower case, runs of separators as one space) and hashed. For each host, distinct
texts are counted by line hash; exact copies of a text count once. A line that stands in more than SHARE of a
host's texts, and in LEAST of them at least, is boilerplate of that host and removed. A document of which
less than LEFT of its words remain is depleted and rejected. Both limits are shares, so they mean the same
at any size; a host has at most (lines in a text) / SHARE such lines on average, which bounds its list.

Rules for odd rows: a null text has no words; such and empty texts fail the base rules. Rows with a null host
form one host. Repeated rows each get their own result. Only the named columns are read, all others pass
through; the result is one struct column whose name the caller gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import SEPARATORS, bare, small, staged

#: 0.05: a line in a twentieth of a host's texts is no prose. At a fifth the rule found nothing in hosts of any size.
SHARE, LEAST, LEFT = 0.05, 10, 0.2


def let(value: Column, use) -> Column:
    """use(value) with value worked out once: a plain reference inside a lambda is worked out for each element."""
    return F.transform(F.array(value), use).getItem(0)


def _shifted(array: Column, by: int) -> Column:
    return F.slice(array, by + 1, F.size(array))


def _doubled(hashes: Column, by: int) -> Column:
    """Hashes of windows twice as long; the last ones are of no use and cut off later."""
    return let(hashes, lambda h: F.zip_with(h, _shifted(h, by), lambda a, b: F.xxhash64(a, b)))


def _windows(words: Column) -> Column:
    """A hash for each 8-word window."""
    full = _doubled(_doubled(_doubled(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)
    return let(full, lambda h: F.slice(h, 1, F.greatest(F.size(h) - 7, F.lit(0))))


def _covered(windows: Column) -> Column:
    """Words in windows whose hash comes twice or more: sort (hash, position), mark equal neighbours, add up."""

    def marked(s):
        left = F.zip_with(s, F.concat(F.array(F.lit(None)), F.slice(s, 1, F.size(s) - 1)), lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), F.coalesce(a["h"] == b["h"], F.lit(False)).alias("m")))
        return F.zip_with(left, _shifted(s, 1), lambda a, b: F.when(a["m"] | F.coalesce(a["h"] == b["h"], F.lit(False)), a["i"]))

    pairs = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    starts = F.array_sort(F.filter(let(pairs, marked), lambda x: x.isNotNull()))
    steps = let(starts, lambda p: F.zip_with(p, _shifted(p, 1), lambda a, b: F.least(F.lit(8), F.coalesce(b - a, F.lit(8)))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)


def _lines(text: str) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: x.rlike(f"[^{SEPARATORS}]"))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(F.lower(F.regexp_replace(line, f"[{SEPARATORS}]+", " "))))


def _host(host: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("null"))


def boilerplate(df: DataFrame, text: str = "text", host: str = "source", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """Rows (__host, __lines array<bigint>): hashes of the lines above a host's limit. A staged table."""
    lines = (
        df.select(_host(host).alias("__host"), F.xxhash64(F.col(text)).alias("__text"), F.array_distinct(F.transform(_lines(text), _line_hash)).alias("__all"))
        # One row without a line for each text counts the texts of the host.
        .select("__host", "__text", F.explode(F.concat(F.array(F.lit(None).cast("long")), F.col("__all"))).alias("__line"))
    )
    counts = lines.groupBy("__host", "__line").agg(F.count_distinct("__text").alias("__n"))
    counts = staged(counts.filter(F.col("__line").isNull() | (F.col("__n") >= least)))
    texts = counts.filter(F.col("__line").isNull()).select("__host", F.col("__n").alias("__of"))
    above = counts.filter(F.col("__line").isNotNull()).join(texts, "__host").filter(F.col("__n") > share * F.col("__of"))
    return staged(above.groupBy("__host").agg(F.collect_list("__line").alias("__lines")))


def assess(df: DataFrame, out: str = "quality", text: str = "text", host: str = "source", share: float = SHARE, least: int = LEAST, left: float = LEFT, keep_text: bool = False) -> DataFrame:
    """df with a struct column: the base counts, base_failed, words_left, kept, and with keep_text the text less boilerplate lines."""
    frequent = boilerplate(df, text, host, share, least)
    own = [c for c in df.columns if c != out]
    d = df.select(*own, F.coalesce(F.col(text), F.lit("")).alias("__t"), _host(host).alias("__host")).join(small(frequent), "__host", "left")
    t = bare("__t")
    d = d.withColumn("__words", F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"[{SEPARATORS}]+")))
    d = d.withColumn("__windows", _windows(F.col("__words"))).withColumn("__lined", _lines("__t"))
    removed = F.when(
        F.col("__lines").isNotNull(),
        F.aggregate(
            F.filter("__lined", lambda x: F.array_contains(F.col("__lines"), _line_hash(x))),
            F.lit(0).cast("long"),
            lambda a, x: a + F.regexp_count(x, F.lit(f"[^{SEPARATORS}]+")),
        ),
    ).otherwise(F.lit(0).cast("long"))
    d = d.select(
        *own,
        "__t",
        "__lines",
        F.size("__words").cast("long").alias("__n"),
        F.length(F.array_join("__words", "")).cast("long").alias("__chars"),
        F.regexp_count(F.col("__t"), F.lit("[#*$%&|<>]")).cast("long").alias("__symbols"),
        (F.size("__lined") - F.size(F.array_distinct("__lined"))).cast("long").alias("__dup"),
        F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), _covered(F.col("__windows"))).otherwise(F.lit(0).cast("long")).alias("__repeat"),
        removed.alias("__removed"),
    )
    failed = (F.col("__n") < 20) | (100 * F.col("__repeat") > 30 * F.col("__n"))
    words_left = F.col("__n") - F.col("__removed")
    fields = [
        F.col("__n").alias("n_words"),
        F.col("__chars").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"),
        F.col("__dup").alias("n_dup_lines"),
        F.col("__repeat").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & (words_left >= left * F.col("__n"))).alias("kept"),
        words_left.alias("words_left"),
    ]
    if keep_text:
        rest = F.array_join(F.filter(F.split("__t", "\n", -1), lambda x: ~F.array_contains(F.col("__lines"), _line_hash(x)) | ~x.rlike(f"[^{SEPARATORS}]")), "\n")
        fields.append(F.when(F.col("__lines").isNull() | (F.col("__removed") == 0), F.col("__t")).otherwise(rest).alias("text"))
    return d.select(*own, F.struct(*fields).alias(out))
