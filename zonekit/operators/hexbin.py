"""Hexagonal binning of two coordinates (C11, C12), as a grouped aggregate.

Two offset lattices; each point goes to the nearer centre. The bounds are read as
one row (min/max), so the whole thing is a scan for them and one for the aggregation
keyed by ``(lattice, ix, iy)`` with map-side partial aggregation.
Semantics follow the common plotting convention: ``ny = int(nx / sqrt(3))``,
x extent padded by ``1e-9`` of its span, round-half-even to the first lattice,
points outside a lattice's index range dropped, cells kept when
``count >= mincnt``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hex_bin(df: DataFrame, x: str, y: str, value: str | None = None, gridsize: int = 50,
            mincnt: int = 1) -> DataFrame:
    """Returns ``lattice, ix, iy, n`` and ``mean_value`` when ``value`` is given."""
    nx = int(gridsize)
    ny = int(nx / math.sqrt(3))
    # the bounds are read as one row: as subqueries they would be planned again in each of the nested expressions below
    a, b, c, d = (float(v) if v is not None else None for v in df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first())
    if a is None or c is None:
        a = b = c = d = 0.0  # no point with both coordinates: the lattices stay empty
    pad = 1e-9 * (b - a)
    xmin, xmax = a - pad, b + pad
    sx, sy = (xmax - xmin) / float(nx), (d - c) / float(ny)
    px = F.try_divide(F.col(x) - F.lit(xmin), F.lit(sx))
    py = F.try_divide(F.col(y) - F.lit(c), F.lit(sy))
    p = df.select(px.alias("px"), py.alias("py"), (F.col(value) if value else F.lit(1.0)).alias("v"))
    # rint rounds doubles half to even; each step is a column of its own that the next ones read, so a row's terms are computed once
    p = p.withColumns({"ix1": F.rint("px"), "iy1": F.rint("py"),
                       "ix2": F.floor("px").cast("double"), "iy2": F.floor("py").cast("double")})
    x1, y1 = F.col("px") - F.col("ix1"), F.col("py") - F.col("iy1")
    x2, y2 = F.col("px") - F.col("ix2") - F.lit(0.5), F.col("py") - F.col("iy2") - F.lit(0.5)
    p = p.withColumn("first", x1 * x1 + F.lit(3.0) * (y1 * y1) < x2 * x2 + F.lit(3.0) * (y2 * y2))
    first = F.col("first")
    lat = F.when(first, F.lit(1)).otherwise(F.lit(2))
    ix = F.when(first, F.col("ix1")).otherwise(F.col("ix2")).cast("long")
    iy = F.when(first, F.col("iy1")).otherwise(F.col("iy2")).cast("long")
    c = p.select(lat.alias("lattice"), ix.alias("ix"), iy.alias("iy"), "v")
    lim_x = F.when(F.col("lattice") == 1, F.lit(nx + 1)).otherwise(F.lit(nx))
    lim_y = F.when(F.col("lattice") == 1, F.lit(ny + 1)).otherwise(F.lit(ny))
    # taken as an aggregate: a filter on the keys would be pushed below them, with their nested expressions written out for every use
    inside = (F.col("ix") >= 0) & (F.col("ix") < lim_x) & (F.col("iy") >= 0) & (F.col("iy") < lim_y)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.avg("v").alias("mean_value"))
    cells = c.groupBy("lattice", "ix", "iy").agg(F.max(inside).alias("_zk_inside"), *aggs)
    return cells.where(F.col("_zk_inside") & (F.col("n") >= mincnt)).drop("_zk_inside")
