"""Geometry from depth pixels: error of a contact point, patch, normal, crop and point cloud.

`depth` rows: episode_id, frame_index, x, y (whole pixels), depth_m. Only tiles near a wanted contact
pixel meet it, on (episode_id, frame_index, tile). Where frame numbers repeat, contacts carry `step`, and so do results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gripline.functions.geometry import lift_pixel, project_pinhole, whole_pixel
from gripline.operators.blocks import BLOCK, KEY, block_number
from gripline.operators.tiles import FRAME, PLACE, around, frame_key, squared_gap, tiled, tiles_in_reach

PATCH_POINTS = 32  # fixed values
PATCH_SIZE = 32
MAX_POINTS = 8192
SPREAD_RANGE = 4096  # values of the spread order counted together: 245 ranges


def contact_point(frames: DataFrame, x: str = "x", y: str = "y", z: str = "z") -> DataFrame:
    """3D position and pixel of each frame: contact_x/y/z, u, v (exact) and pu, pv (whole pixel).

    Needs K and T columns, null where the episode has no calibration.
    """
    pixel = project_pinhole(F.col(x), F.col(y), F.col(z), F.col("K"), F.col("T"))
    return frames.withColumn("_pixel", pixel).select(
        *frames.columns,
        F.col(x).alias("contact_x"),
        F.col(y).alias("contact_y"),
        F.col(z).alias("contact_z"),
        F.col("_pixel")["u"].alias("u"),
        F.col("_pixel")["v"].alias("v"),
        whole_pixel(F.col("_pixel")["u"]).alias("pu"),
        whole_pixel(F.col("_pixel")["v"]).alias("pv"),
    )


def deprojection_error(contacts: DataFrame, depth: DataFrame) -> DataFrame:
    """Distance in millimetres between the kinematic point and the one lifted from depth at its pixel.

    -1 where there is no pixel, no depth or no calibration.
    """
    pixels = depth.select(*FRAME, F.col("x").alias("pu"), F.col("y").alias("pv"), "depth_m")
    asked = pixels.join(contacts.select(*FRAME, "pu", "pv").distinct(), [*FRAME, "pu", "pv"], "left_semi")
    at_pixel = asked.groupBy(*FRAME, "pu", "pv").agg(F.min("depth_m").alias("depth_m"))
    joined = contacts.join(at_pixel, [*FRAME, "pu", "pv"], "left")
    lifted = lift_pixel(F.col("pu").cast("double"), F.col("pv").cast("double"), F.col("depth_m"), F.col("K"), F.col("T"))
    gaps = [F.col(f"contact_{a}") - p for a, p in zip("xyz", lifted)]
    error = F.sqrt(gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2]) * 1000
    return joined.withColumn("deprojection_err_mm", F.coalesce(error, F.lit(-1.0))).drop("depth_m")


GROUP_LIMIT = 1000  # Spark applies a limit on a rank before the shuffle up to this number
SALTS = 4096


def nearest_first(group: list[str], order: list[Column], keep: int, rows: DataFrame, out: str) -> DataFrame:
    """The first `keep` rows of every group, ranked in `out`.

    A small limit is applied by Spark before the shuffle as well, so a large group sends at most `keep`
    rows per input partition. For a larger one the group is first cut to `keep` rows in each of many
    salted parts; the first rows of the group are among those.
    """
    if keep > GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]), F.lit(SALTS))
        part = F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order))
        rows = rows.withColumn("_salt", salt).withColumn("_part", part).where(F.col("_part") <= keep).drop("_salt", "_part")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn(out, rank).where(F.col(out) <= keep)


def contact_patch(contacts: DataFrame, depth: DataFrame, mask: DataFrame | None = None, points: int = PATCH_POINTS) -> DataFrame:
    """The `points` depth pixels closest to the contact pixel (inside the mask if given), lifted to 3D.

    Only the tiles in reach of a contact pixel are ranked. Without calibration the points have null coordinates. With a mask, depth
    meets it first, by pixel, as depth often lies already; frames that are not wanted drop out with their tiles.
    """
    wanted = contacts.where("pu is not null")
    if mask is None:
        pixels = tiled(depth.join(wanted.select(*FRAME).distinct(), FRAME, "left_semi"))
    else:
        pixels = tiled(depth.join(mask.select(*FRAME, "x", "y"), [*FRAME, "x", "y"], "left_semi"))
    who = frame_key(contacts)
    near = pixels.join(tiles_in_reach(wanted, pixels, points), [*FRAME, *PLACE])
    chosen = nearest_first(who, [F.col("_gap"), F.col("y"), F.col("x"), F.col("depth_m")], points, near.withColumn("_gap", squared_gap()), "rank")
    # cameras meet only the pixels that were kept
    chosen = chosen.select(*who, "rank", "x", "y", "depth_m").join(wanted.select(*who, "K", "T"), who)
    px, py, pz = lift_pixel(F.col("x").cast("double"), F.col("y").cast("double"), F.col("depth_m"), F.col("K"), F.col("T"))
    return chosen.select(*who, "rank", "x", "y", px.alias("px"), py.alias("py"), pz.alias("pz"), "T")


def smallest_eigenvector(rows: DataFrame, cov: tuple[str, ...]) -> DataFrame:
    """Unit eigenvector (ex, ey, ez) of the smallest eigenvalue of symmetric 3x3 matrices; null when not unique.

    `cov` names the columns xx, xy, xz, yy, yz, zz. The eigenvalue comes from the trigonometric form
    of the cubic, the vector is the longest cross product of two rows of (A - eigenvalue * I). Each
    stage is a column of its own, so that no expression is written out twice.
    """
    xx, xy, xz, yy, yz, zz = cov
    stages = [
        {"_q": f"({xx} + {yy} + {zz}) / 3"},
        {"_p": f"sqrt((pow({xx} - _q, 2) + pow({yy} - _q, 2) + pow({zz} - _q, 2) + 2 * ({xy} * {xy} + {xz} * {xz} + {yz} * {yz})) / 6)"},
        {
            "_det": f"({xx} - _q) * (({yy} - _q) * ({zz} - _q) - {yz} * {yz}) - {xy} * ({xy} * ({zz} - _q) - {xz} * {yz})"
            f" + {xz} * ({xy} * {yz} - {xz} * ({yy} - _q))"
        },
        {"_r": "least(1D, greatest(-1D, try_divide(_det, 2 * _p * _p * _p)))"},
        {"_low": "_q + 2 * _p * cos(acos(_r) / 3 + 2 * pi() / 3)"},
        {"_a": f"{xx} - _low", "_d": f"{yy} - _low", "_f": f"{zz} - _low"},
        {
            "_v": f"array_max(array({_cross(('_a', xy, xz), (xy, '_d', yz))}, {_cross(('_a', xy, xz), (xz, yz, '_f'))}, {_cross((xy, '_d', yz), (xz, yz, '_f'))}))"
        },
        {"_len": "case when _p > 0 and _v.n > 1e-24 then sqrt(_v.n) end"},
        {"ex": "_v.x / _len", "ey": "_v.y / _len", "ez": "_v.z / _len"},
    ]
    out = rows
    for stage in stages:
        out = out.selectExpr("*", *[f"{text} as {name}" for name, text in stage.items()])
    return out.select(*rows.columns, "ex", "ey", "ez")


def _cross(m: tuple[str, ...], n: tuple[str, ...]) -> str:
    x, y, z = (f"({m[i]} * {n[j]} - {m[j]} * {n[i]})" for i, j in ((1, 2), (2, 0), (0, 1)))
    return f"named_struct('n', {x} * {x} + {y} * {y} + {z} * {z}, 'x', {x}, 'y', {y}, 'z', {z})"


def patch_summary(patch: DataFrame) -> DataFrame:
    """Per frame: the number of points, the points in order of rank, and the direction of least spread (nx, ny, nz).

    The direction is turned toward the camera and null when it is not defined.
    """
    pairs = ("px", "py", "pz")
    who = frame_key(patch)
    cov = {f"c{i}{j}": F.covar_pop(pairs[i], pairs[j]) for i in range(3) for j in range(i, 3)}
    listed = F.sort_array(F.collect_list(F.struct("rank", F.array(*pairs).alias("p"))))
    sums = patch.groupBy(*who).agg(
        F.count(F.lit(1)).alias("points"), listed.alias("_listed"), F.first("T").alias("T"), *[F.avg(p).alias(f"m{p}") for p in pairs], *[c.alias(n) for n, c in cov.items()]
    )
    found = smallest_eigenvector(sums, tuple(cov))
    # camera position in robot axes: -R^T t
    t = lambda r, c: F.get(F.get(F.col("T"), r), c)
    camera = [-(t(0, c) * t(0, 3) + t(1, c) * t(1, 3) + t(2, c) * t(2, 3)) for c in range(3)]
    toward = sum((F.col(e) * (c - F.col(m)) for e, c, m in zip(("ex", "ey", "ez"), camera, ("mpx", "mpy", "mpz"))), F.lit(0.0))
    sign = F.when(toward < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    turned = found.withColumn("_sign", sign)
    return turned.select(*who, "points", F.col("_listed")["p"].alias("xyz"), *[(F.col(f"e{a}") * F.col("_sign")).alias(f"n{a}") for a in "xyz"])


def surface_normal(patch: DataFrame) -> DataFrame:
    """Direction of least spread of each patch, turned toward the camera; null when it is not defined."""
    return patch_summary(patch).drop("xyz")


def depth_patch(contacts: DataFrame, depth: DataFrame, size: int = PATCH_SIZE) -> DataFrame:
    """Depth rows of a size x size crop around the contact pixel, with their place in the crop."""
    half = size // 2
    near = around(contacts, depth, half, size - half)
    return near.select(
        *frame_key(contacts), (F.col("y") - F.col("pv") + half).alias("row"), (F.col("x") - F.col("pu") + half).alias("col"), "depth_m"
    )


def crop_grid(crop: DataFrame, size: int = PATCH_SIZE) -> DataFrame:
    """Crops as rows of cells (`grid`): null where a cell has no depth, the smallest where it has several.

    Rows are built first, then stacked, so no group has more than `size` members.
    """
    who = frame_key(crop)
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(size - 1).cast("bigint"))
    cells = crop.groupBy(*who, "row", "col").agg(F.min("depth_m").alias("depth_m"))
    at = F.map_from_entries(F.collect_list(F.struct("col", "depth_m")))
    rows = cells.groupBy(*who, "row").agg(at.alias("_at")).select(*who, "row", F.transform(numbers, lambda c: F.try_element_at("_at", c)).alias("_cells"))
    stacked = rows.groupBy(*who).agg(F.map_from_entries(F.collect_list(F.struct("row", "_cells"))).alias("_rows"))
    empty = F.transform(numbers, lambda _: F.lit(None).cast("double"))
    return stacked.select(*who, F.transform(numbers, lambda r: F.coalesce(F.try_element_at("_rows", r), empty)).alias("grid"))


def spread_order(x: Column, y: Column) -> Column:
    """A fixed shuffle of pixels that both Spark and SQL can compute: used to thin a cloud evenly."""
    return F.pmod(x * F.lit(7919) + y * F.lit(104729), F.lit(1000003))


def point_cloud(depth: DataFrame, calibration: DataFrame, max_points: int = MAX_POINTS, extra: tuple[str, ...] = ()) -> DataFrame:
    """Depth pixels as 3D points, at most `max_points` per frame, the first in a fixed spread order.

    The order's values are counted in ranges. Ranges that begin beyond the limit are left out by an inner join, and pixels are
    ranked inside their range only, so no frame is sorted as a whole. Cameras meet blocks of frames; frames of an
    episode without a camera have no points.
    """
    order = spread_order(F.col("x"), F.col("y"))
    ranged = depth.withColumn("_order", order).withColumn("_range", F.floor(order / F.lit(SPREAD_RANGE)))
    group = [*FRAME, "_range"]
    counts = ranged.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*FRAME).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    kept = counts.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < max_points)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_order", "y", "x", "depth_m"))
    thin = ranged.join(kept.drop("_n"), group).withColumn("_rank", rank).where(F.col("_before") + F.col("_rank") <= max_points)
    blocked = thin.withColumn("_blk", block_number(F.col("frame_index"), BLOCK))
    blocks = counts.select(KEY, block_number(F.col("frame_index"), BLOCK).alias("_blk")).distinct().join(calibration, KEY)
    px, py, pz = lift_pixel(F.col("x").cast("double"), F.col("y").cast("double"), F.col("depth_m"), F.col("K"), F.col("T"))
    return blocked.join(blocks, [KEY, "_blk"]).select(*FRAME, "x", "y", px.alias("px"), py.alias("py"), pz.alias("pz"), *extra)
