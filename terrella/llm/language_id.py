"""Language identification by fusing evidence as Bayes' rule does.

Text: a naive Bayes model over hashed byte trigrams, fitted on a bounded sample of labelled rows, gives a
likelihood for each language; as trigrams aren't independent, it counts as PER_TRIGRAM of itself. Declared
language (markup), address suffix: the model holds how often each stands with each language in the sample.
Host priors: the text's verdicts are counted by host in a grouped aggregation and smoothed towards the counts
of the host's suffix, and those towards all counts. The posterior multiplies what there is of these.

Pages have no labels: with_evidence() counts their declared languages and suffixes against the text's verdicts.

Rules for odd rows: a null or empty text says nothing, and the other evidence decides; a null declared
language, address or host is no evidence; repeated rows each get their own result; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import small, staged
from terrella.llm.shingles import slices

#: Labelled rows that the model is fitted on, about; hashed trigrams.
SAMPLE, BUCKETS = 4000, 1 << 15

#: The weight of a trigram's likelihood, and of a parent's share in rows.
PER_TRIGRAM, ROWS = 0.2, 20.0

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[48:58] = 48


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram, row) over the bytes of many texts."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = _FOLD[data]
    h = (x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA6B) ^ x[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:-2] == row[2:]
    return (h >> np.uint32(17)).astype(np.int64)[inside], row[:-2][inside]


@dataclass
class Model:
    """Log likelihoods by language; everything in it is bounded by SAMPLE and BUCKETS."""

    languages: list[str]
    text: np.ndarray
    prior: np.ndarray
    declared: dict[str, np.ndarray]
    suffix: dict[str, np.ndarray]


def suffix_of(host: Column) -> Column:
    return F.lower(F.regexp_extract(host, r"\.([A-Za-z]+)$", 1))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def markup(df: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """df with the columns text (less scripts, styles, comments, tags), declared (of the html tag) and host; null where there is none."""
    words = F.regexp_replace(F.regexp_replace(F.col(html), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*+>|<[^>]*+>", " "), "&#?[A-Za-z0-9]++;", " ")
    lang = F.regexp_extract(F.col(html), r"""(?i)<html\b[^>]*?\slang\s*+=\s*+["']?([A-Za-z]+)""", 1)
    return df.withColumns({"text": words, "declared": F.lower(F.nullif(lang, F.lit(""))), "host": F.nullif(host_of(F.col(url)), F.lit(""))})


def with_evidence(model: Model, df: DataFrame, key: str, text: str = "text", declared: str = "declared", host: str = "host", sample: int = SAMPLE) -> Model:
    """model with what declared languages and suffixes say, from the text's verdicts on rows without labels."""
    said = identify(df, model, key, text).filter("text_language is not null").select(key, F.col("text_language").alias("__said")).dropDuplicates([key])
    found = fit(df.join(said, key), text, "__said", declared, host, sample)
    place = {x: i for i, x in enumerate(found.languages)}

    def placed(logs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        # A language without a verdict counts as the least likely of those with one.
        return {k: np.array([v[place[x]] if x in place else v.min() for x in model.languages]) for k, v in logs.items()}

    return replace(model, declared=placed(found.declared), suffix=placed(found.suffix))


def fit(df: DataFrame, text: str, label: str, declared: str | None = None, host: str | None = None, sample: int = SAMPLE) -> Model:
    """The model of a hash sample of about so many labelled rows."""
    labelled = df.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    n = labelled.count()
    near = F.lit(None).cast("string")
    rows = labelled.select(F.col(text).alias("t"), F.lower(F.col(label).cast("string")).alias("l"), (F.lower(F.col(declared)) if declared else near).alias("d"), (suffix_of(F.col(host)) if host else near).alias("s"))
    if n > sample:
        rows = rows.filter(F.pmod(F.xxhash64("t", "l"), F.lit(1_000_000)) < int(1_000_000 * sample / n) + 1)

    def count(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for first, k, data, offsets in slices(batch, 0):
                gram, row = trigrams(data, offsets)
                labels = np.array(batch.column(1).slice(first, k).to_pylist(), object)
                for language in set(labels.tolist()):
                    got = np.bincount(gram[(labels == language)[row]], minlength=BUCKETS)
                    at = np.flatnonzero(got)
                    yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array(at), pa.array(got[at])], ["l", "gram", "n"])

    rows = staged(rows)
    sizes = rows.groupBy("l").count().collect()
    languages = sorted(r["l"] for r in sizes)
    place = {x: i for i, x in enumerate(languages)}
    counts = np.full((len(languages), BUCKETS), 0.5)
    for r in rows.mapInArrow(count, "l string, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n")).collect():
        counts[place[r["l"]], r["gram"]] += r["n"]
    prior = np.array([{r["l"]: r["count"] for r in sizes}[x] + 1.0 for x in languages])

    def held(column: str) -> dict[str, np.ndarray]:
        got: dict[str, np.ndarray] = {}
        for r in rows.filter(F.length(column) > 0).groupBy(column, "l").count().collect():
            got.setdefault(r[column], np.full(len(languages), 1.0))[place[r["l"]]] += r["count"]
        return {k: np.log(v / (prior + len(got) + 1)) for k, v in got.items()}

    text_log = np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts
    return Model(languages, text_log, np.log(prior / prior.sum()), held("d"), held("s"))


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", declared: str | None = None, host: str | None = None) -> DataFrame:
    """Rows (key, language, text_language, confidence, kept); kept where a language has more than half of the posterior."""
    languages, m = model.languages, len(model.languages)
    kind = df.schema[key].dataType.simpleString()
    none = F.lit(None).cast("string")

    def likely(batches):
        for batch in batches:
            for first, n, data, offsets in slices(batch, 1):
                gram, row = trigrams(data, offsets)
                got = np.stack([np.bincount(row, weights=model.text[k][gram], minlength=n) for k in range(m)], axis=1) * PER_TRIGRAM if m else np.zeros((n, 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), *[batch.column(k).slice(first, n) for k in (2, 3, 4)], pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m, pa.int32()), pa.array(got.ravel(), pa.float64()))],
                    [key, "d", "h", "s", "text_log"],
                )

    columns = df.select(key, F.coalesce(F.col(text), F.lit("")).alias("__t"), (F.lower(F.col(declared).cast("string")) if declared else none).alias("d"), (F.col(host).cast("string") if host else none).alias("h"), (suffix_of(F.col(host)) if host else none).alias("s"))
    scored = staged(columns.mapInArrow(likely, f"{key} {kind}, d string, h string, s string, text_log array<double>"))
    top = F.array_max("text_log")
    best = F.when((F.size("text_log") > 0) & (top < 0), F.array_position("text_log", top) - 1)
    # Counts of the text's verdicts: by host and suffix, by suffix, in all.
    votes = scored.withColumn("v", best).filter("v is not null and h is not null").groupBy("h", "s", "v").agg(F.count("*").cast("double").alias("n"))
    votes = staged(votes)
    vector = F.array(*[F.coalesce(F.sum(F.when(F.col("v") == i, F.col("n"))), F.lit(0.0)) for i in range(m)]) if m else F.array().cast("array<double>")
    total = votes.agg(vector.alias("all")).first()["all"]
    flat = [(x + 1.0) / (sum(total) + m) for x in total]
    parent = F.array(*[F.lit(x) for x in flat]) if m else F.array().cast("array<double>")

    def smoothed(counts: Column, towards: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(counts, towards, lambda c, p: (c + ROWS * p) / (size + ROWS))

    suffixes = votes.groupBy("s").agg(vector.alias("c")).select("s", smoothed(F.col("c"), parent).alias("sp"))
    hosts = votes.groupBy("h", "s").agg(vector.alias("c")).join(small(staged(suffixes)), "s").select("h", smoothed(F.col("c"), F.col("sp")).alias("prior"))
    joined = scored.join(small(staged(hosts)), "h", "left")

    def fused(batches):
        for batch in batches:
            n = batch.num_rows
            logs = batch.column(2).flatten().to_numpy().reshape(n, m) if m else np.zeros((n, 0))
            score = logs.copy()
            for i, (d, s, p) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                score[i] += model.declared.get(d, 0.0) if d else 0.0
                score[i] += model.suffix.get(s, 0.0) if s else 0.0
                score[i] += np.log(p) if p is not None else model.prior
            if not m:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.array(np.zeros(n)), pa.array([True] * n)], [key, "language", "text_language", "confidence", "kept"])
                continue
            share = np.exp(score - score.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            at = share.argmax(axis=1)
            high = share[np.arange(n), at]
            said = [languages[k] if x.any() else None for k, x in zip(logs.argmax(axis=1).tolist(), logs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([languages[k] for k in at.tolist()]), pa.array(said, pa.string()), pa.array(np.round(high, 6)), pa.array(high > 0.5)], [key, "language", "text_language", "confidence", "kept"])

    return joined.select(key, "d", "text_log", "s", "prior").mapInArrow(fused, f"{key} {kind}, language string, text_language string, confidence double, kept boolean")
