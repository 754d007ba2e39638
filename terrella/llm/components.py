"""Connected components by contraction, for links of any number.

Each round sends every node to its least neighbour, if that is less than itself, follows such steps once
more, and puts the new names into the links. Links inside a component vanish; the least node never changes
its name, so it names the component in the end. Minima are taken before rows are dealt out, so a node with
very many links does no harm; tables that have become small are broadcast after a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import release, small, staged


def components(links: DataFrame) -> DataFrame:
    """links: (a, b). Rows (node, component) for the nodes that have a link to another; component is the least node."""
    edges = staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    names = None
    while n := edges.count():
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        first = staged(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("h")))
        step = first.join(small(first, 2 * n).select(F.col("v").alias("h"), F.col("h").alias("hh")), "h", "left")
        hook = staged(step.select("v", F.coalesce("hh", "h").alias("h")))
        to = small(hook, 2 * n)
        renamed = edges.join(to.select(F.col("v").alias("a"), F.col("h").alias("ha")), "a").join(to.select(F.col("v").alias("b"), F.col("h").alias("hb")), "b")
        shorter = staged(renamed.filter("ha <> hb").select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b")).distinct())
        if names is None:
            new = staged(hook.select(F.col("v").alias("node"), F.col("h").alias("component")))
        else:
            new = staged(names.join(to.select(F.col("v").alias("component"), "h"), "component", "left").select("node", F.coalesce("h", "component").alias("component")))
            release(names)
        release(edges, first, hook)
        edges, names = shorter, new
    if names is None:
        names = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return names
