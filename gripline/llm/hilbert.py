"""Sharding along a Hilbert curve over document metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gripline.llm.common import spread, text_of

BITS = 4
BLOCKS = 32
#: Sizes from this power of two on have levels of their own.
FIRST_POWER = 4


def curve(spark: SparkSession, bits: int = BITS) -> DataFrame:
    """Columns x0, x1, x2 and h: the place of every cell of a cube with 2^bits levels a side on its Hilbert curve.

    Cells whose indexes follow each other share a face. 2^(3 * bits) rows, whatever the corpus.
    """
    side = 1 << bits
    cell = F.array(*[((F.col("id") / side**i).cast("long") % side).cast("int") for i in range(3)])
    steps = F.array(*[F.struct(F.lit(1 << b).alias("bit"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(3)])

    def turn(x: Column, step: Column) -> Column:
        """Mirror or swap the first axis with axis i below one bit."""
        axis, low = F.get(x, step["i"]), step["bit"] - 1
        mirrored = axis.bitwiseAND(step["bit"]) != 0
        swap = F.get(x, F.lit(0)).bitwiseXOR(axis).bitwiseAND(low)
        return F.transform(x, lambda v, k: v.bitwiseXOR(F.when(mirrored, F.when(k == 0, low).otherwise(0)).otherwise(F.when((k == 0) | (k == step["i"]), swap).otherwise(0))))

    # For axis 0 both places are one, and its swap is 0.
    rows = spark.range(side**3).select(cell.alias("a")).withColumn("t", F.aggregate(steps, F.col("a"), turn))
    x = [F.get("t", F.lit(i)) for i in range(3)]
    rows = rows.select("a", x[0].alias("g0"), x[1].bitwiseXOR(x[0]).alias("g1"), x[2].bitwiseXOR(x[1]).bitwiseXOR(x[0]).alias("g2"))
    flip = F.lit(0)
    for b in range(1, bits):
        flip = flip.bitwiseXOR(F.when(F.col("g2").bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
    rows = rows.withColumn("flip", flip)
    h = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for i in range(3):
            h = h * 2 + F.shiftright(F.col(f"g{i}").bitwiseXOR(F.col("flip")), b).bitwiseAND(F.lit(1))
    return rows.select(*[F.get("a", F.lit(i)).alias(f"x{i}") for i in range(3)], h.alias("h"))


def levels(rows: DataFrame, name: str, to: str, bits: int = BITS) -> DataFrame:
    """Columns name and to: distinct values in order, cut into at most 2^bits levels."""
    place = F.row_number().over(Window.orderBy(name)) - 1
    many = F.count("*").over(Window.partitionBy())
    return rows.select(name).distinct().select(name, F.floor(place * F.greatest(F.lit(1.0), F.least(many, F.lit(1 << bits)) / 1.0) / F.greatest(many, F.lit(1))).cast("int").alias(to))


def shard(docs: DataFrame, shards: int = 8, bits: int = BITS, blocks: int = BLOCKS, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Rows (doc, size, text_crc32, curve, shard, slot): documents in order of the curve, cut into runs of equal counts.

    The metadata lang, source and size (a power of two) are quantised to 2^bits levels each; shards hold the runs of the
    curve over these levels, so that a file spans few values of each. Law `rows`: counts of shards are at most one
    apart. `slot` counts from 0 within a shard. Within a cell of the curve, rows follow in order of a hash of the id, the
    id and all columns. Ranks come from counts per (cell, block), added up in two small steps; no task holds a hot cell.

    A null lang or source is a value before all others; a null text has size 1 and the checksum of no bytes. Repeated rows
    get places of their own. An empty table gives an empty one. Other columns stay in the struct `doc`.
    """
    spark = docs.sparkSession
    every = [docs[c] for c in docs.columns]
    held = [docs[c] for c in keep or docs.columns]
    key = lambda name: F.coalesce(F.concat(F.lit("v"), docs[name].cast("string")), F.lit(""))
    power = F.length(F.bin(F.col("size"))) - 1
    base = docs.select(
        F.struct(*held).alias("doc"), key("lang").alias("lang"), key("source").alias("source"), docs["doc_id"].alias("id"), F.xxhash64(*every).alias("tie"),
        (F.octet_length(text_of(docs)).cast("long") + 1).alias("size"), F.crc32(text_of(docs).cast("binary")).alias("text_crc32"), spread(docs["doc_id"], blocks).alias("block"),
    ).withColumn("x2", F.least(F.greatest(power - FIRST_POWER, F.lit(0)), F.lit((1 << bits) - 1)).cast("int"))
    cells = F.broadcast(curve(spark, bits))  # 2^(3 * bits) rows at most
    placed = base.join(levels(base, "lang", "x0", bits), "lang").join(levels(base, "source", "x1", bits), "source").join(cells, ["x0", "x1", "x2"])
    placed = placed.select("doc", "id", "tie", "size", "text_crc32", "h", "block")
    counts = placed.groupBy("h", "block").agg(F.count("*").alias("rows")).withColumn("part", F.floor(F.col("h") / (1 << (2 * bits - 2))))
    parts = counts.groupBy("part").agg(F.sum("rows").alias("rows"))
    first = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("rows").over(first), F.lit(0)).alias("above"), F.sum("rows").over(Window.partitionBy()).alias("total"))
    inner = Window.partitionBy("part").orderBy("h", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("inside", F.coalesce(F.sum("rows").over(inner), F.lit(0))).join(parts, "part")
    offsets = offsets.select("h", "block", (F.col("above") + F.col("inside")).alias("before"), "total")
    rank = F.row_number().over(Window.partitionBy("h", "block").orderBy("id", "tie")) - 1 + F.col("before")
    ranked = placed.join(offsets, ["h", "block"]).withColumn("rank", rank)
    ranked = ranked.withColumn("shard", F.expr(f"rank * {shards} div total"))
    slot = F.col("rank") - F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.select("doc", "size", "text_crc32", F.col("h").alias("curve"), F.col("shard").cast("int").alias("shard"), slot.alias("slot"))


def write(sharded: DataFrame, folder: str) -> None:
    """One folder per shard, rows sorted along the curve, so that readers can skip files and row groups by metadata."""
    rows = sharded.select("shard", "slot", "doc.*") if not {"shard", "slot"} & {*sharded.schema["doc"].dataType.names} else sharded
    rows.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def digest(rows: DataFrame) -> tuple[Column, ...]:
    """Columns of the query."""
    return (rows["doc.doc_id"].alias("doc_id"), rows["size"], rows["text_crc32"], F.lit("rows").alias("law"), rows["shard"], rows["slot"].cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
