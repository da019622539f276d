"""Connected components of a graph given as links, by alternating stars.

Each round hooks every node's larger neighbours to the smallest node that it
sees (large star), then its smaller ones (small star), until each component is a
star around its smallest node.  A node's minimum is aggregated before the shuffle.
The joins that spread it bring the links of a node with very many, two numbers
each, to one task unless Spark's adaptive execution splits the partition, which
it does above its threshold of bytes.  The links of each round are written to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import stored


def _is_stars(links: DataFrame) -> bool:
    """Whether no node hangs on two others, or both hangs and holds."""
    ends = links.select(F.col("src").alias("node"), F.col("dst").alias("on")).unionByName(links.select(F.col("dst").alias("node"), F.lit(None).cast(links.schema["dst"].dataType).alias("on")))
    seen = ends.groupBy("node").agg(F.min("on").alias("low"), F.max("on").alias("high"), F.count_if(F.col("on").isNull()).alias("holds"))
    return seen.where((F.col("low") != F.col("high")) | (F.col("low").isNotNull() & (F.col("holds") > 0))).isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link to another; the component
    is its smallest node.  Links may repeat and go either way; null ends and
    links of a node to itself say nothing; no links give no rows."""
    x, y = F.col(a), F.col(b)
    star = stored(links.where(x != y).select(F.greatest(x, y).alias("src"), F.least(x, y).alias("dst")).distinct())
    while not _is_stars(star):
        both = star.unionByName(star.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = both.where(F.col("dst") > F.col("src")).join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        least = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(least, "src").where(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        star = stored(small.unionByName(least.select("src", F.col("m").alias("dst"))).distinct())
    roots = star.select("dst").distinct().select(F.col("dst").alias("node"), F.col("dst").alias("component"))
    return star.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
