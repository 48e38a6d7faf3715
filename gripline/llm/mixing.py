"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripline.llm.common import SPACE, spread, written

WEIGHTS = (1, 2, 3)
LIMIT = 3
BLOCKS = 32


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Columns k, n_source and target for a table of source keys k and sizes n_source: one small row per source.

    Sources in order of k take the weights in turn and share the sum of all sizes. A target stops at limit times
    the size of its source and the excess goes to the others by weight: in order of limit * size / weight, a source is
    full while an even share by weight of what is left reaches its limit.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(Window.orderBy("k")) - 1) % len(weights) + 1).cast("int"))
    rows = totals.withColumn("w", weight.cast("double")).withColumn("cap", F.col("n_source").cast("double") * F.lit(float(limit)))
    filled = Window.orderBy(F.col("cap") / F.col("w"), "k")
    everything = Window.partitionBy()
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "k", "n_source", "w", "cap",
        F.sum(F.col("n_source")).over(everything).cast("double").alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("used"),
        F.sum("w").over(filled.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    )
    rows = rows.withColumn("full", (F.col("total") - F.col("used")) / F.col("open") >= F.col("cap") / F.col("w"))
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    left = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    return rows.select("k", "n_source", F.when(F.col("full"), F.col("cap")).otherwise((F.col("total") - spent) / left * F.col("w")).alias("target"))


def mix(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, blocks: int = BLOCKS, seed: str = "mix") -> DataFrame:
    """Rows (doc, size, source_size, target, copies): each row of docs in the struct `doc`, and how often the mix takes it.

    docs needs doc_id and source, and text unless a size is given. Every document of a source has the same number of
    expected copies, target / source_size. Documents of a source are laid in one order, by size class, then by a hash
    of the id, size and id; the prefix sum of expected copies plus one random offset per source (from `seed`) crosses
    a whole number once for each copy taken. As sizes are laid in order, the sizes taken come near the target.

    The order needs no task that holds a source: rows are numbered within (source, size class, hash block), and a small
    table of block counts carries the offsets; `blocks` cuts a hot class. Reruns agree.

    A null source is a source of its own, last in order. A null or empty text has size 0, and a source without words
    gives nothing. Repeated rows are documents of their own. An empty table gives an empty table. Other columns, also with
    names used here, stay in `doc`.
    """
    n = words(docs["text"]) if size is None else size
    every = [docs[c] for c in docs.columns]
    digits = F.col("n").cast("string")
    base = docs.select(
        F.struct(*every).alias("doc"),
        F.when(docs["source"].isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), docs["source"].cast("string"))).alias("k"),
        n.cast("long").alias("n"), docs["doc_id"].alias("id"), spread(docs["doc_id"], blocks).alias("block"), F.xxhash64(*every).alias("tie"),
    ).withColumn("class", F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int"))
    place = ["k", "class", "block"]
    counts = written(base.groupBy(*place).agg(F.count("*").alias("rows"), F.sum("n").alias("words")))
    share = targets(counts.groupBy("k").agg(F.sum("words").alias("n_source")), weights, limit)
    earlier = Window.partitionBy("k").orderBy("class", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows", "words").join(share, "k")
    at = (F.row_number().over(Window.partitionBy(*place).orderBy("n", "id", "tie")) + F.col("before")).cast("double")
    rate = F.when(F.col("n_source") > 0, F.col("target") / F.col("n_source").cast("double")).otherwise(F.lit(0.0))
    start = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("k")).cast("binary")), 1, 4), 16, 10).cast("double") / F.lit(65536.0)
    numbered = base.join(offsets, place).select("doc", "n", "n_source", "target", at.alias("at"), rate.alias("rate"), start.alias("start"))
    crossed = F.floor(F.col("at") * F.col("rate") + F.col("start")) - F.floor((F.col("at") - 1.0) * F.col("rate") + F.col("start"))
    return numbered.select("doc", F.col("n").alias("size"), F.col("n_source").alias("source_size"), "target", crossed.cast("long").alias("copies"))


def taken(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the columns of docs, each document once per copy taken."""
    mixed = mix(docs, **options).where("copies > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("doc.*")
