"""Column expressions for points, cameras and boxes. A point is three double columns (x, y, z)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE_WIDTH = 320  # fixed values: image size used when no camera is known
IMAGE_HEIGHT = 180
Z_EPS = 1e-6


def cell(matrix: Column, row: int, col: int) -> Column:
    return F.get(F.get(matrix, row), col)


def affine_row(matrix: Column, row: int, x: Column, y: Column, z: Column) -> Column:
    """One row of [R | t] applied to a point."""
    return cell(matrix, row, 0) * x + cell(matrix, row, 1) * y + cell(matrix, row, 2) * z + cell(matrix, row, 3)


def transform_point(matrix: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    return tuple(affine_row(matrix, r, x, y, z) for r in range(3))


def uv(u: Column, v: Column) -> Column:
    return F.struct(u.alias("u"), v.alias("v"))


def project_pinhole(x: Column, y: Column, z: Column, k: Column, t: Column) -> Column:
    """Pixel {u, v} of a robot point; null behind the camera.

    Without calibration the unit square of (x, y) is spread over the default image.
    """
    cx, cy, cz = transform_point(t, x, y, z)
    row = [cell(k, r, 0) * cx + cell(k, r, 1) * cy + cell(k, r, 2) * cz for r in range(3)]
    seen = F.when(cz > 0, uv(F.try_divide(row[0], row[2]), F.try_divide(row[1], row[2])))
    plain = uv((x + 1) / 2 * IMAGE_WIDTH, (y + 1) / 2 * IMAGE_HEIGHT)
    return F.when(k.isNotNull() & t.isNotNull(), seen).otherwise(plain)


def camera_rows(k: Column, e: Column, robot_to_world: Column | None = None) -> Column:
    """A camera as one flat array of 18: the world-to-camera matrix by rows, then the two pixel rows of K.

    Made once per camera. `robot_to_world` is applied to the points first.
    """
    columns = range(4)
    if robot_to_world is None:
        world = [cell(e, r, c) for r in range(3) for c in columns]
    else:
        world = [
            sum((cell(e, r, i) * cell(robot_to_world, i, c) for i in range(3)), cell(e, r, 3) if c == 3 else F.lit(0.0))
            for r in range(3)
            for c in columns
        ]
    return F.array(*world, *[cell(k, r, c) for r in range(2) for c in range(3)])


def camera_point(x: Column, y: Column, z: Column, rows: Column) -> Column:
    """Position {x, y, z} in the camera's axes."""
    at = lambda r: F.get(rows, 4 * r) * x + F.get(rows, 4 * r + 1) * y + F.get(rows, 4 * r + 2) * z + F.get(rows, 4 * r + 3)
    return F.struct(at(0).alias("x"), at(1).alias("y"), at(2).alias("z"))


def camera_pixel(point: Column, rows: Column) -> Column:
    """Pixel {u, v} of a position in the camera's axes; null at or behind the image plane."""
    nx, ny = point["x"] / point["z"], point["y"] / point["z"]
    at = lambda i: F.get(rows, i) * nx + F.get(rows, i + 1) * ny + F.get(rows, i + 2)
    return F.when(point["z"] > Z_EPS, uv(at(12), at(15)))


def project_camera(x: Column, y: Column, z: Column, rows: Column) -> Column:
    return camera_pixel(camera_point(x, y, z, rows), rows)


def project_trace(trace: Column, rows: Column) -> Column:
    """Project every point of a trace; points without a pixel stay in place as null."""
    seen = F.transform(trace, lambda p: camera_point(p["x"], p["y"], p["z"], rows))
    return F.transform(seen, lambda c: camera_pixel(c, rows))


def affordance_box(u: Column, v: Column, half: int = 20) -> Column:
    """Square around a whole pixel, clipped at zero on the low side only; empty without a pixel."""
    low = lambda c: F.greatest(F.lit(0).cast("bigint"), c - half)
    box = F.array(low(u), low(v), u + half, v + half)
    return F.when(u.isNotNull() & v.isNotNull(), box).otherwise(F.array().cast("array<bigint>"))


def whole_pixel(value: Column) -> Column:
    """Truncate toward zero."""
    return value.try_cast("bigint")


def l2_error(a: Column, b: Column, first: int, last: int) -> Column:
    """Distance of two vectors over dimensions first..last-1; null when either is missing or lengths differ."""
    left, right = F.slice(a, first + 1, last - first), F.slice(b, first + 1, last - first)
    squares = F.zip_with(left, right, lambda p, q: (p - q) * (p - q))
    total = F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s)
    return F.when(F.size(left) == F.size(right), F.sqrt(total))


def lift_pixel(u: Column, v: Column, depth: Column, k: Column, t: Column) -> tuple[Column, Column, Column]:
    """Pixel with depth -> robot point: undo K in closed form, then undo the rigid transform."""
    yc = (v - cell(k, 1, 2)) / cell(k, 1, 1)
    xc = (u - cell(k, 0, 2) - cell(k, 0, 1) * yc) / cell(k, 0, 0)
    camera = [xc * depth, yc * depth, depth]
    moved = [camera[r] - cell(t, r, 3) for r in range(3)]
    return tuple(sum((cell(t, r, c) * moved[r] for r in range(3)), F.lit(0.0)) for c in range(3))
