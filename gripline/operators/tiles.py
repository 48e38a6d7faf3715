"""Pixels in square tiles, so that a search around a pixel meets a few tiles of its image.

Pixel tables have episode_id, frame_index, x and y. Tables that search carry their own pixel as pu and pv, and `step`
where frame numbers may repeat: joins with pixels use (episode, frame, tile), results keep (episode, frame, step).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripline.operators.blocks import KEY

TILE = 32  # pixels on a side
FAR = 2**52  # a pixel at or beyond this is outside of every image

FRAME = [KEY, "frame_index"]
PLACE = ["tile_x", "tile_y"]


def frame_key(rows: DataFrame) -> list[str]:
    """Columns that name a row: the frame, and its step where there is one."""
    return [*FRAME, "step"] if "step" in rows.columns else FRAME


def tile_of(pixel: Column) -> Column:
    return F.floor(pixel / F.lit(TILE))


def tiled(pixels: DataFrame) -> DataFrame:
    return pixels.withColumns({"tile_x": tile_of(F.col("x")), "tile_y": tile_of(F.col("y"))})


def searching(rows: DataFrame) -> DataFrame:
    """Rows with a pixel that may lie in an image."""
    inside = lambda c: F.col(c).between(-FAR, FAR)
    return rows.where(inside("pu") & inside("pv"))


def around(wanted: DataFrame, pixels: DataFrame, before: int, after: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Pixels with pu - before <= x < pu + after, and y likewise, of every wanted row, with its pu and pv.

    A wanted row meets the tiles that its square touches and no others. Its rows are multiplied by their tiles, which Spark's
    estimate of sizes leaves out, so both sides are shuffled: neither is sent to the driver and to every executor.
    """
    touched = lambda c: F.sequence(tile_of(F.col(c) - before), tile_of(F.col(c) + after - 1))
    asked = searching(wanted).select(*frame_key(wanted), "pu", "pv", *carry)
    asked = asked.withColumn("tile_x", F.explode(touched("pu"))).withColumn("tile_y", F.explode(touched("pv")))
    inside = lambda c, p: (F.col(c) >= F.col(p) - before) & (F.col(c) < F.col(p) + after)
    return tiled(pixels).join(asked.hint("merge"), [*FRAME, *PLACE]).where(inside("x", "pu") & inside("y", "pv")).drop(*PLACE)


def squared_gap() -> Column:
    """Squared distance from the wanted pixel, as a double."""
    dx, dy = (F.col("x") - F.col("pu")).cast("double"), (F.col("y") - F.col("pv")).cast("double")
    return dx * dx + dy * dy


def tiles_in_reach(wanted: DataFrame, pixels: DataFrame, keep: int) -> DataFrame:
    """For every wanted row, the tiles that may hold one of its `keep` nearest pixels: rows of the frame key, pu, pv and tile.

    Tiles are counted with the box of their pixels. In order of their farthest corner, the tile that brings the count to
    `keep` gives the reach; tiles that begin beyond it cannot help. Where an image has fewer pixels, all its tiles stay.
    """
    bounds = [F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("y").alias("y1"), F.max("y").alias("y2")]
    counts = pixels.groupBy(*FRAME, *PLACE).agg(F.count(F.lit(1)).alias("n"), *bounds)
    who = frame_key(wanted)
    asked = searching(wanted).select(*who, "pu", "pv")
    square = lambda x, y: x.cast("double") * x + y.cast("double") * y
    outside = lambda c: F.greatest(F.col(f"{c}1") - F.col(f"p{'u' if c == 'x' else 'v'}"), F.col(f"p{'u' if c == 'x' else 'v'}") - F.col(f"{c}2"), F.lit(0).cast("bigint"))
    farthest = lambda c: F.greatest(F.abs(F.col(f"{c}1") - F.col(f"p{'u' if c == 'x' else 'v'}")), F.abs(F.col(f"p{'u' if c == 'x' else 'v'}") - F.col(f"{c}2")))
    met = asked.join(counts, FRAME).withColumns({"near": square(outside("x"), outside("y")), "far": square(farthest("x"), farthest("y"))})
    ordered = Window.partitionBy(*who).orderBy("far").rangeBetween(Window.unboundedPreceding, 0)
    reach = F.min(F.when(F.col("upto") >= keep, F.col("far"))).over(Window.partitionBy(*who))
    met = met.withColumn("upto", F.sum("n").over(ordered)).withColumn("reach", reach)
    return met.where(F.col("reach").isNull() | (F.col("near") <= F.col("reach"))).select(*who, "pu", "pv", *PLACE)
