"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component): for every id in columns a and b of links, the smallest id that links reach.

    Alternates two steps over the links alone: each id's larger neighbours are tied to its smallest neighbour, then its
    smaller ones are. Both keep components whole and shorten paths, so a few rounds end in stars around the smallest
    ids. A round is a minimum per id (combined before the shuffle) and a join that Spark may split for a hub; nothing is
    gathered per id. Each round is written to the shared folder.
    """
    pairs = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    pairs = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # Larger neighbours: every id looks at all its links.
        both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # Smaller neighbours: every id looks at its links downwards.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").unionByName(low.select("a", F.col("low").alias("b")))
        pairs = written(small.distinct())
        now = pairs.agg(F.count("*"), F.sum(F.col("b").cast("decimal(20,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("b").alias("id")).distinct()
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
