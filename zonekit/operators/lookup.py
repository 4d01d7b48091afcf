"""Joins and lookups.

Lookups are equi joins; AQE turns them into broadcast joins when the map side
measures small, and into skew-split sort-merge joins otherwise. Scalars are
attached as scalar subqueries, never by a cross join.

The nearest-known-cell fallback (D5) is an exact tiled ring search: cells are
bucketed into square tiles; an unseen cell meets only the known cells of its
own and the 8 neighbouring tiles (an equi join on tile ids). A best match at
distance ``d < T + 1`` (``T`` the tile side) is provably the nearest, because
every cell outside the 3x3 block is at least ``T + 1`` away on one axis.
Cells not resolved after ``rings`` levels of doubled tiles go down a pyramid of
occupied tiles instead: from the few tiles that cover everything, each cell keeps
only tiles whose nearest point may still beat the farthest point of another, and
follows them to their halves. So a cell meets a few tiles a level, however many known cells a far
cluster holds. Only distinct cells take part, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir, stored
from .encode import apply_encoding


def lookup(df: DataFrame, enc: DataFrame, key: str, out: str, te_col: str = "te") -> DataFrame:
    """Left lookup of ``key`` in an encoding map; unseen -> null."""
    return apply_encoding(df, enc, key, out, te_col)


def join_stats(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Left join of group statistics on ``key``."""
    return df.join(stats, on=key, how="left")


def unseen_keys(test: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """D3: keys present in ``test`` but not in ``train`` with their test row counts."""
    tk = test.groupBy(key).agg(F.count(F.lit(1)).alias("test_rows"))
    return tk.join(train.select(key).distinct(), on=key, how="left_anti")


def semi(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``keys`` (left semi join)."""
    return df.join(keys.select(key), on=key, how="left_semi")


def coalesce_chain(cols: Sequence) -> Column:
    """First non-null of the fallback chain."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols])


def with_scalars(df: DataFrame, one_row: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Attach the columns of a one-row result to every row (scalar subqueries)."""
    cols = list(cols or one_row.columns)
    return df.withColumns({c: one_row.select(c).scalar() for c in cols})


def align(preds: DataFrame, models: Sequence[str], key: str = "row_id", model: str = "model",
          value: str = "pred") -> DataFrame:
    """Predictions of several models side by side on the row key.

    ``models`` is given explicitly so the pivot needs no extra distinct job.
    """
    return preds.groupBy(key).pivot(model, list(models)).agg(F.max(value))


def _tiles(df: DataFrame, x: str, y: str, size: int) -> DataFrame:
    return df.withColumns({"_zk_tx": F.floor(F.col(x) / F.lit(size)), "_zk_ty": F.floor(F.col(y) / F.lit(size))})


_NEIGHBOURS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]


def _descend(pending: DataFrame, known: DataFrame, x: str, y: str, payload: Sequence[str]) -> DataFrame:
    """The nearest known cell of each pending one, by branch and bound over occupied tiles."""
    span = known.agg(F.min("_zk_kx"), F.max("_zk_kx"), F.min("_zk_ky"), F.max("_zk_ky")).first()
    top = 1
    while top <= max(span[1] - span[0], span[3] - span[2]):
        top *= 2

    def occupied(size: int) -> DataFrame:
        return _tiles(known, "_zk_kx", "_zk_ky", size).select("_zk_tx", "_zk_ty").distinct()

    def kept(cand: DataFrame, size: int) -> DataFrame:
        def gap(c: str, t: str) -> tuple[Column, Column]:
            low, high = F.col(t) * F.lit(size), F.col(t) * F.lit(size) + F.lit(size - 1)
            near = F.greatest(low - F.col(c), F.col(c) - high, F.lit(0)).cast("double")
            return near, F.greatest(F.abs(F.col(c) - low), F.abs(F.col(c) - high)).cast("double")
        (nx, fx), (ny, fy) = gap(x, "_zk_tx"), gap(y, "_zk_ty")
        cand = cand.withColumns({"_zk_near": nx * nx + ny * ny, "_zk_far": fx * fx + fy * fy})
        least = Window.partitionBy(x, y)
        return cand.withColumn("_zk_best", F.min("_zk_far").over(least)).where("_zk_near <= _zk_best").select(x, y, "_zk_tx", "_zk_ty")

    # at most four tiles of a size beyond the span hold all known cells: as one bounded list for every cell
    first = [(r[0], r[1]) for r in occupied(top).collect()]
    items = F.array(*[F.struct(F.lit(a).cast("long").alias("_zk_tx"), F.lit(b).cast("long").alias("_zk_ty")) for a, b in first])
    cand = kept(pending.select(x, y, F.explode(items).alias("_zk_t")).select(x, y, "_zk_t.*"), top)
    halves = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    size, level = top, 0
    while size > 1:
        size //= 2
        down = cand.select(x, y, "_zk_tx", "_zk_ty", F.explode(halves).alias("_zk_h")).select(
            x, y, (F.col("_zk_tx") * 2 + F.col("_zk_h.a")).alias("_zk_tx"), (F.col("_zk_ty") * 2 + F.col("_zk_h.b")).alias("_zk_ty"))
        cand = kept(down.join(occupied(size), ["_zk_tx", "_zk_ty"], "left_semi"), size)
        level += 1
        if level % 4 == 0:
            cand = cand.checkpoint(eager=True)
    near = cand.join(known, (F.col("_zk_tx") == F.col("_zk_kx")) & (F.col("_zk_ty") == F.col("_zk_ky")), "inner")
    return _best(near, x, y, payload)


def _best(cand: DataFrame, x: str, y: str, payload: Sequence[str]) -> DataFrame:
    """Of all candidates of a cell the nearest, ties to the smallest packed id."""
    cand = cand.withColumn("_zk_d2", (F.col(x) - F.col("_zk_kx")) ** 2 + (F.col(y) - F.col("_zk_ky")) ** 2)
    order = F.struct(F.col("_zk_d2"), F.col("_zk_kx") * F.lit(100000) + F.col("_zk_ky"))
    best = cand.groupBy(x, y).agg(F.min_by(F.struct("_zk_kx", "_zk_ky", "_zk_d2", *payload), order).alias("_zk_b"))
    return best.select(x, y, "_zk_b.*")


def nearest_known(unseen: DataFrame, known: DataFrame, x: str = "grid_lon", y: str = "grid_lat",
                  payload: Sequence[str] = (), tile: int = 4, rings: int = 3) -> DataFrame:
    """For each distinct unseen cell ``(x, y)`` the nearest known cell (Euclidean).

    Ties go to the smallest packed id ``x * 100000 + y``. Returns
    ``x, y, near_x, near_y, dist, payload...``. ``known`` must hold one row per
    cell. Every unseen cell gets one, however far; with no known cell at all the result is empty.
    """
    payload = list(payload)
    u = unseen.select(x, y).distinct()
    k = known.select(F.col(x).alias("_zk_kx"), F.col(y).alias("_zk_ky"), *payload)
    if k.limit(1).count() == 0:
        return u.limit(0).select(x, y, F.lit(None).cast("long").alias("near_x"),
                                 F.lit(None).cast("long").alias("near_y"), F.lit(None).cast("double").alias("dist"),
                                 *[F.lit(None).alias(p) for p in payload])
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _NEIGHBOURS])
    results, pending, size = [], u, tile
    for _ in range(rings):
        ut = _tiles(pending, x, y, size).select(x, y, "_zk_tx", "_zk_ty", F.explode(offsets).alias("_zk_o"))
        ut = ut.select(x, y, (F.col("_zk_tx") + F.col("_zk_o.dx")).alias("_zk_tx"),
                       (F.col("_zk_ty") + F.col("_zk_o.dy")).alias("_zk_ty"))
        kt = _tiles(k, "_zk_kx", "_zk_ky", size)
        best = _best(ut.join(kt, on=["_zk_tx", "_zk_ty"], how="inner"), x, y, payload)
        done = best.where(F.col("_zk_d2") < F.lit(float((size + 1) ** 2)))
        results.append(done)
        pending = pending.join(done.select(x, y), on=[x, y], how="left_anti")
        if pending.limit(1).count() == 0:
            break
        size *= 2
    else:
        shared_dir(pending.sparkSession)
        results.append(_descend(pending.checkpoint(eager=True), k, x, y, payload))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out.select(x, y, F.col("_zk_kx").alias("near_x"), F.col("_zk_ky").alias("near_y"),
                      F.sqrt(F.col("_zk_d2").cast("double")).alias("dist"), *payload)


def fill_from_nearest(df: DataFrame, enc: DataFrame, key: str, out: str, x: str = "grid_lon",
                      y: str = "grid_lat", te_col: str = "te", cells: DataFrame | None = None,
                      tile: int = 4) -> DataFrame:
    """D5 + D6: rows whose ``key`` is missing from ``enc`` take the encoding of the
    nearest known cell. ``cells`` maps known keys to ``(x, y)``.
    """
    known = cells.join(enc.select(key, te_col), on=key, how="inner").select(x, y, te_col)
    # a row a cell each, read several times below
    known = stored(known, "known_cells")
    un = stored(df.join(enc.select(key), on=key, how="left_anti").select(x, y).distinct(), "unseen_cells")
    near = nearest_known(un, known, x, y, payload=[te_col], tile=tile) \
        .select(x, y, F.col(te_col).alias("_zk_near_te"))
    base = apply_encoding(df, enc, key, "_zk_own_te", te_col)
    return base.join(near, on=[x, y], how="left") \
        .withColumn(out, F.coalesce("_zk_own_te", "_zk_near_te")).drop("_zk_own_te", "_zk_near_te")

