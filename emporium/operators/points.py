"""Point-cloud table operators over ``(point_id, x, y, z)``.

The reference runs these steps in NumPy on one machine.  Here each one is
a column job: bounds are one global aggregate (a partial aggregate per
partition, then one row), used by the following step as ONE scalar subquery
returning a struct,
so nothing but that single row is shared and no point leaves its partition
except in the voxel count, which is a regular partially-aggregated group-by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
VOXEL_SIZE = 0.05
SCALE = 1.02
COLOR_EPS = 1e-8


def points_bbox(points: DataFrame) -> DataFrame:
    """min, max and centre per axis (one row)."""
    aggs = []
    for a in AXES:
        aggs += [F.min(a).alias(f"{a}_min"), F.max(a).alias(f"{a}_max")]
    box = points.agg(*aggs)
    return box.select("*", *[((F.col(f"{a}_min") + F.col(f"{a}_max")) / 2).alias(f"{a}_center")
                             for a in AXES])


def _scalar_row(row: DataFrame) -> dict:
    """Fields of a one-row DataFrame as columns of ONE scalar subquery (a
    struct), so all of them cost a single aggregate job."""
    sub = row.select(F.struct(*row.columns)).scalar()
    return {c: sub[c] for c in row.columns}


def _bounds(points: DataFrame) -> dict:
    """Scalar-subquery columns for the bounds of ``points`` (one scan)."""
    aggs = []
    for a in AXES:
        aggs += [F.min(a).alias(f"{a}_min"), F.max(a).alias(f"{a}_max")]
    return _scalar_row(points.agg(*aggs))


def points_crop(points: DataFrame, z_fraction: float = 1.0) -> DataFrame:
    """Keep points inside the bbox whose top is zmin + (zmax − zmin)·f.

    The reference comments "top 35 %" but uses f = 1, i.e. keeps everything.
    """
    b = _bounds(points)
    top = b["z_min"] + (b["z_max"] - b["z_min"]) * F.lit(z_fraction)
    cond = F.col("z").between(b["z_min"], top)
    for a in ("x", "y"):
        cond = cond & F.col(a).between(b[f"{a}_min"], b[f"{a}_max"])
    return points.where(cond)


def scaled_box(points: DataFrame, factor: float = SCALE) -> DataFrame:
    """The bbox scaled by ``factor`` about its centre (one row)."""
    box = points_bbox(points)
    cols = []
    for a in AXES:
        c, lo, hi = F.col(f"{a}_center"), F.col(f"{a}_min"), F.col(f"{a}_max")
        cols += [(c + (lo - c) * F.lit(factor)).alias(f"{a}_min"),
                 (c + (hi - c) * F.lit(factor)).alias(f"{a}_max"),
                 c.alias(f"{a}_center")]
    return box.select(*cols)


def points_scaled_crop(points: DataFrame, factor: float = SCALE) -> DataFrame:
    """Keep the points inside the bbox scaled by ``factor`` about its centre."""
    b = _scalar_row(scaled_box(points, factor))
    cond = F.lit(True)
    for a in AXES:
        cond = cond & F.col(a).between(b[f"{a}_min"], b[f"{a}_max"])
    return points.where(cond)


def points_voxels(points: DataFrame, voxel: float = VOXEL_SIZE) -> DataFrame:
    """Occupied cells of edge ``voxel`` (origin at the bbox minimum) and their
    point counts."""
    b = _bounds(points)
    idx = [F.floor((F.col(a) - b[f"{a}_min"]) / F.lit(voxel)).cast("long").alias(f"v{a}")
           for a in AXES]
    return points.groupBy(*idx).agg(F.count(F.lit(1)).alias("n"))


def points_plane(points: DataFrame, factor: float = SCALE) -> DataFrame:
    """Cutting slab next to the cloud (one row).

    Box sizes (1.5·dx, 0.01, 1.5·dy) along x, y, z; the box is created with
    its minimum corner at the origin and moved so its centre lands on
    (cx, cy) with its base at zmin − 0.05, i.e. centre z = zmin − 0.05 + 0.75·dy.
    The bbox is that of the scaled crop box.
    """
    box = scaled_box(points, factor)
    dx = F.col("x_max") - F.col("x_min")
    dy = F.col("y_max") - F.col("y_min")
    width, depth = dx * F.lit(1.5), dy * F.lit(1.5)
    return box.select(F.col("x_center").alias("plane_x"), F.col("y_center").alias("plane_y"),
                      (F.col("z_min") - F.lit(0.05) + depth / 2).alias("plane_z"),
                      width.alias("width"), F.lit(0.01).alias("height"), depth.alias("depth"))


def points_clip(points: DataFrame, plane: DataFrame, normal=(0.0, 1.0, 0.0)) -> DataFrame:
    """Keep points strictly below the plane: dot(p − p0, n) < 0."""
    pl = _scalar_row(plane.select("plane_x", "plane_y", "plane_z"))
    p0 = [pl["plane_x"], pl["plane_y"], pl["plane_z"]]
    dot = None
    for a, c0, n in zip(AXES, p0, normal):
        if n == 0:
            continue
        term = (F.col(a) - c0) * F.lit(float(n))
        dot = term if dot is None else dot + term
    return points.where(dot < 0)


def points_color_by_height(points: DataFrame) -> DataFrame:
    """t = (z − zmin)/(zmax − zmin + 1e-8); colour (r, g, b) = (t, 0, 1 − t)."""
    zb = _scalar_row(points.agg(F.min("z").alias("zmin"), F.max("z").alias("zmax")))
    zmin, zmax = zb["zmin"], zb["zmax"]
    t = (F.col("z") - zmin) / (zmax - zmin + F.lit(COLOR_EPS))
    return points.select("*", t.alias("r"), F.lit(0.0).alias("g"), (F.lit(1.0) - t).alias("b"))


def points_extremes(points: DataFrame) -> DataFrame:
    """Lowest and highest point (ties → smallest point_id) and the height range."""
    p = F.struct("point_id", "x", "y", "z")
    lo = F.min_by(p, F.struct(F.col("z"), F.col("point_id")))
    hi = F.max_by(p, F.struct(F.col("z"), -F.col("point_id")))
    row = points.agg(lo.alias("lo"), hi.alias("hi"))
    rng = F.col("hi.z") - F.col("lo.z")
    # one aggregate, two output rows
    both = F.array(F.struct(F.lit("min").alias("extreme"), F.col("lo").alias("p"), rng.alias("height_range")),
                   F.struct(F.lit("max").alias("extreme"), F.col("hi").alias("p"), rng.alias("height_range")))
    return (row.select(F.inline(both))
            .select("extreme", "p.point_id", "p.x", "p.y", "p.z", "height_range"))
