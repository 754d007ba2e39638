"""Mixing sources to target weights by a low-discrepancy schedule.

Each source is a stream: its documents in the order of a hash of their ids, end to end, again and again, cut
into blocks of BLOCK words. A source with a target of T words gives its first T words, so the last block may
be short. The schedule deals slots to sources: the points i / golden ratio (mod 1) fall into the sources'
shares of [0, 1), the slots of each source are ranked, and the slot of rank r takes block r. Where a source
has all its blocks, later slots of it are void; blocks whose slot didn't come up in the run of points stand
at the end, by rank.

Nothing gathers a source in one task: streams are laid out by sums over hash buckets, and those by sums over
groups of buckets, slots are ranked by sums over chunks of points, and the points meet the shares in narrow bins.

Targets: sources in code point order, null last, weigh 5, 2, 1, 5, ... and share 150 % of all words; a target
stops at twice its source's size and the excess is shared anew by weight.

Rules for odd rows: a null or empty text has size 0 and nothing is taken of it; a null source is a source;
repeated rows each take their own place in the stream; an empty table gives no rows. Only the named columns
are read; mixed_documents() reads all, and tells rows apart by 128 bits of hashes of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrella.llm.common import SEPARATORS, bare, n_words, release, staged

WEIGHTS, TOTAL, MOST, BLOCK = (5, 2, 1), 1.5, 2, 1024

#: Documents of a hash bucket and points of a chunk that one window sees, about; hexadecimal digits by which
#: buckets are grouped; bins of [0, 1).
BUCKET, CHUNK, DIGITS, BINS = 512, 16384, 3, 4096

GOLDEN = 0.6180339887498949


def _name(source: str) -> Column:
    """Sources in code point order as a never-null key; null comes last."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("~"))


def targets(sizes: DataFrame) -> DataFrame:
    """sizes: rows (__name, source_size). Adds target, by filling up to twice the size. A staged table."""
    spark = sizes.sparkSession
    sizes = staged(sizes.repartitionByRange("__name").withColumn("__part", F.spark_partition_id()))
    before = sizes.groupBy("__part").count().withColumn("__before", F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("__part").orderBy("__name")) - 1 + F.col("__before")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(rank, F.lit(len(WEIGHTS))) + 1).cast("int"))
    weighed = staged(sizes.join(before.select("__part", "__before"), "__part").withColumn("__weight", weight).drop("__part", "__before"))
    release(sizes)
    words = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = float("inf")  # words for each unit of weight
    cap = float(MOST) * F.col("source_size")
    while True:
        # A source that is above at some level is above at every later one, as levels only rise.
        above = (cap < F.lit(level) * F.col("__weight")) if level != float("inf") else F.lit(False)
        full, free = weighed.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("__weight")))).first()
        new = (TOTAL * words - (full or 0.0)) / free if free else 0.0
        if new == level:
            break
        level = new
    out = weighed.withColumn("target", F.least(cap, F.lit(level) * F.col("__weight")))
    return out.select("__name", "source_size", "target") if words else weighed.select("__name", "source_size", F.lit(0.0).alias("target"))


def _bases(sums: DataFrame, digits: int) -> DataFrame:
    """sums: (__name, __bucket, __sum), buckets of so many digits. (__name, __bucket, __base): the sum of all buckets before."""
    if digits <= DIGITS:
        upto = Window.partitionBy("__name").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        return sums.withColumn("__base", F.coalesce(F.sum("__sum").over(upto), F.lit(0))).drop("__sum")
    grouped = sums.withColumn("__group", F.substring("__bucket", 1, digits - DIGITS))
    upto = Window.partitionBy("__name", "__group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = grouped.withColumn("__in", F.coalesce(F.sum("__sum").over(upto), F.lit(0)))
    groups = staged(grouped.groupBy("__name", F.col("__group").alias("__bucket")).agg(F.sum("__sum").alias("__sum")))
    before = _bases(groups, digits - DIGITS).withColumnRenamed("__bucket", "__group")
    return within.join(before, ["__name", "__group"]).select("__name", "__bucket", (F.col("__base") + F.col("__in")).alias("__base"))


def layout(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", extra: tuple[Column, ...] = (), bucket: int = BUCKET) -> DataFrame:
    """A row for each document: __name, size, its start in its source's stream, source_size, target. A staged table."""
    rows = df.select(F.col(key), _name(source).alias("__name"), n_words(text).alias("size"), F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("__order"), *extra)
    rows = staged(rows)
    digits = 0
    n = rows.count()
    while n > bucket * 16**digits:
        digits += 1
    rows = rows.withColumn("__bucket", F.substring("__order", 1, digits) if digits else F.lit(""))
    sums = rows.groupBy("__name", "__bucket").agg(F.sum("size").alias("__sum"))
    sums = staged(sums)
    starts = _bases(sums, digits)
    wide = targets(sums.groupBy("__name").agg(F.sum("__sum").alias("source_size")))
    own = [F.col(c) for c in rows.columns if c.startswith("__extra")]
    within = Window.partitionBy("__name", "__bucket").orderBy("__order", key, "size", *own).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__in", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts, ["__name", "__bucket"]).withColumn("start", F.col("__base") + F.col("__in")).drop("__base", "__in", "__bucket", "__order")
    out = staged(placed.join(wide, "__name"))
    release(rows, sums)
    return out


def pieces(placed: DataFrame, key: str = "doc_id", block: int = BLOCK, extra: tuple[str, ...] = ()) -> DataFrame:
    """What blocks hold of documents: (__name, rank, epoch, key, start, from_word, n_words). Two rounds of a stream at most."""
    last = F.floor("target")
    rounds = placed.filter(F.col("size") > 0).select("*", F.explode(F.array(*[F.lit(e) for e in range(MOST)])).alias("epoch"))
    at = F.col("epoch") * F.col("source_size") + F.col("start")
    rounds = rounds.withColumn("__at", at).withColumn("__to", F.least(F.col("__at") + F.col("size"), last)).filter(F.col("__to") > F.col("__at"))
    cut = rounds.withColumn("rank", F.explode(F.sequence(F.floor(F.col("__at") / block), F.floor((F.col("__to") - 1) / block))))
    begin, end = F.greatest("__at", F.col("rank") * block), F.least("__to", (F.col("rank") + 1) * block)
    return cut.select("__name", "rank", "epoch", key, *extra, "start", (begin - F.col("__at")).alias("from_word"), (end - begin).alias("n_words"))


def schedule(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (__name, rank, slot): the place in the mix of each source's blocks."""
    spark = placed.sparkSession
    need = placed.groupBy("__name").agg(F.ceil(F.floor(F.max("target")) / block).alias("__need")).filter("__need > 0")
    need = staged(need)
    total = need.agg(F.sum("__need")).first()[0] or 0
    # Shares end to end: again by sums of parts, then within them.
    parts = staged(need.repartitionByRange("__name").withColumn("__part", F.spark_partition_id()))
    before = parts.groupBy("__part").agg(F.sum("__need").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    low = F.coalesce(F.sum("__need").over(Window.partitionBy("__part").orderBy("__name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("__before")
    shares = parts.join(before.select("__part", "__before"), "__part").withColumn("__low", low).withColumn("__from", F.col("__low") / float(total or 1)).withColumn("__to", (F.col("__low") + F.col("__need")) / float(total or 1))
    binned = shares.select("__name", "__need", "__from", "__to", F.explode(F.sequence(F.floor(F.col("__from") * BINS), F.least(F.floor(F.col("__to") * BINS), F.lit(BINS - 1)))).alias("__bin"))
    points = spark.range(total + total // 50 + 64 if total else 0).select(F.col("id").alias("slot"), F.expr(f"(id * {GOLDEN}D) % 1D").alias("__u"))
    points = points.withColumn("__bin", F.least(F.floor(F.col("__u") * BINS), F.lit(BINS - 1)))
    dealt = points.join(binned, "__bin").filter("__u >= __from and __u < __to").select("slot", "__name", "__need", F.floor(F.col("slot") / CHUNK).alias("__chunk"))
    dealt = staged(dealt)
    chunks = dealt.groupBy("__name", "__chunk").agg(F.count("*").alias("__n"))
    chunks = chunks.withColumn("__base", F.coalesce(F.sum("__n").over(Window.partitionBy("__name").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = dealt.withColumn("__in", F.row_number().over(Window.partitionBy("__name", "__chunk").orderBy("slot")) - 1).join(chunks.drop("__n"), ["__name", "__chunk"])
    ranked = ranked.withColumn("rank", F.col("__in") + F.col("__base")).filter("rank < __need").select("__name", "rank", "slot")
    got = dealt.groupBy("__name").agg(F.count("*").alias("__got"))
    missing = need.join(got, "__name", "left").withColumn("__got", F.coalesce("__got", F.lit(0))).filter("__got < __need")
    after = float(total) * 1.1 + 64
    late = missing.select("__name", F.explode(F.sequence(F.col("__got"), F.col("__need") - 1)).alias("rank")).withColumn("slot", (F.lit(after) + F.col("rank")).cast("long"))
    return ranked.unionByName(late)


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """The mix: rows (slot, __name, rank, epoch, key, start, from_word, n_words); read by slot, then epoch and start."""
    placed = layout(df, key, text, source)
    return _mixed(placed, key, block)


def _mixed(placed: DataFrame, key: str, block: int, extra: tuple[str, ...] = ()) -> DataFrame:
    return pieces(placed, key, block, extra).join(schedule(placed, block), ["__name", "rank"])


def taken(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """Rows (key, size, source_size, target, taken, n_blocks, first_slot): what the mix takes of each document, and where.

    n_blocks counts the blocks that hold words of the document; first_slot is the least slot of these, null without any.
    """
    placed = layout(df, key, text, source)
    found = _mixed(placed, key, block).groupBy("__name", "start").agg(F.sum("n_words").alias("taken"), F.count_distinct("rank").alias("n_blocks"), F.min("slot").alias("first_slot"))
    # Documents without words share their start with the next one, which has all that is taken there.
    out = placed.withColumn("__at", F.when(F.col("size") > 0, F.col("start"))).join(found.withColumnRenamed("start", "__at"), ["__name", "__at"], "left")
    return out.select(key, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"), "first_slot")


def mixed_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, length: str | None = "n_chars") -> DataFrame:
    """The documents of the mix, with df's columns: one row for each round in which the mix takes a document.

    The rows of each partition, a hash sample of the documents and so a mix of its own, stand in the order of the slot
    in which the round of the document begins: texts move once. A document of which a round takes all keeps its text;
    where a source's target ends inside a document, that round's row has the words taken, joined by spaces.
    """
    row = [F.xxhash64(F.lit(k), *[F.col(c) for c in df.columns]).alias(f"__extra_{k}") for k in (1, 2)]
    of = ("__extra_1", "__extra_2")
    placed = layout(df, key, text, source, extra=tuple(row))
    begins = F.min_by(F.struct("from_word", "slot"), "rank").alias("__x")
    rounds = _mixed(placed, key, block, of).groupBy("__name", "start", "epoch", key, *of).agg(begins, F.sum("n_words").alias("__n"))
    rounds = rounds.select(*of, "epoch", "start", F.col("__x.from_word").alias("__from"), F.col("__x.slot").alias("__slot"), "__n").withColumnsRenamed({"epoch": "__epoch", "start": "__start"})
    got = df.select("*", *row).dropDuplicates(of).join(rounds, list(of))
    words = F.split(bare(text), f"[{SEPARATORS}]+")
    whole = F.col("__n") == n_words(text)
    got = got.withColumn("__text", F.when(whole, F.col(text)).otherwise(F.array_join(F.slice(words, (F.col("__from") + 1).cast("int"), F.col("__n").cast("int")), " ")))
    place = ["__slot", "__epoch", "__start"]
    got = got.sortWithinPartitions(*place)
    fresh = {text: F.col("__text")} | ({length: F.length("__text").cast("long")} if length in df.columns else {})
    return got.select(*[fresh.get(c, F.col(c)).alias(c) for c in df.columns])
