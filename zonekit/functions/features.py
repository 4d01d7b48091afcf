"""Scalar feature functions (Column -> Column), all JVM-side expressions.

Every function here compiles into whole-stage codegen; none uses a Python UDF.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Count bins (right-closed edges) and their codes.
COUNT_BIN_EDGES = [0, 1, 3, 10, 30, math.inf]
COUNT_BIN_LABELS = [0, 1, 2, 3, 4]
# Hour period cut points (first match wins: <7, <9, <12, <14, <17, else).
PERIOD_CUTS = [7, 9, 12, 14, 17]
PERIOD_NAMES = ["early_morn", "morning_rush", "late_morning", "lunch_peak", "afternoon", "evening"]
# Grid cell size and packing multiplier.
GRID_SIZE = 5e-5
GRID_MULT = 100000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_count(c="total_count") -> Column:
    """``log1p(total_count)``."""
    return F.log1p(_c(c).cast("double"))


def cut(c, edges: Sequence[float] = COUNT_BIN_EDGES, labels: Sequence = COUNT_BIN_LABELS) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]`` -> ``labels[i]``; outside -> null."""
    x = _c(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = x > F.lit(float(lo))
        if not math.isinf(hi):
            cond = cond & (x <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def cyclical(c, period: float, shift: float = 0.0) -> tuple[Column, Column]:
    """``(sin, cos)`` of ``2*pi*(c - shift)/period``."""
    ang = F.lit(2.0) * F.pi() * (_c(c).cast("double") - F.lit(float(shift))) / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


def grid_axis(c, size: float = GRID_SIZE) -> Column:
    """C4: cell index along one axis, ``trunc(coord / size)`` as LONG."""
    return (_c(c) / F.lit(size)).cast("long")  # a cast truncates towards zero


def grid_id(lon_cell, lat_cell, mult: int = GRID_MULT) -> Column:
    """C4: packed cell id ``lon_cell * mult + lat_cell`` (LONG arithmetic)."""
    return _c(lon_cell) * F.lit(mult) + _c(lat_cell)


def cross_key(a, b, mult: int) -> Column:
    """Packed cross key ``a * mult + b``."""
    return _c(a).cast("long") * F.lit(mult) + _c(b).cast("long")


def time_period(c="hour", cuts: Sequence[int] = PERIOD_CUTS) -> Column:
    """First-match period code 0..len(cuts)."""
    x = _c(c)
    expr = F.when(x < F.lit(cuts[0]), F.lit(0))
    for i, cut_at in enumerate(cuts[1:], start=1):
        expr = expr.when(x < F.lit(cut_at), F.lit(i))
    return expr.otherwise(F.lit(len(cuts)))


def indicator(c) -> Column:
    """``(c > 0)`` as INT (null stays null)."""
    return (_c(c) > F.lit(0)).cast("int")


def sample_weight(c="total_count") -> Column:
    """``log1p(total_count)``; see :func:`normalised_weight` for mean-1 form."""
    return F.log1p(_c(c).cast("double"))


def normalised_weight(df: DataFrame, c: str = "total_count", out: str = "weight") -> DataFrame:
    """``log1p(tc) / avg(log1p(tc))`` (mean 1); the mean is a scalar subquery."""
    w = sample_weight(c)
    mean_w = df.select(F.avg(w)).scalar()
    return df.withColumn(out, w / mean_w)


def av_weight(tc="total_count", p_test="p_test") -> Column:
    """``log1p(tc) * P(test-like)``."""
    return sample_weight(tc) * _c(p_test)


def blend(cols: Sequence, weights: Sequence[float]) -> Column:
    """Fixed-weight linear blend."""
    expr = None
    for c, w in zip(cols, weights):
        term = _c(c) * F.lit(float(w))
        expr = term if expr is None else expr + term
    return expr


def clip01(c) -> Column:
    """Clip to [0, 1]."""
    return F.least(F.greatest(_c(c), F.lit(0.0)), F.lit(1.0))


def verdict(c, rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """First matching (predicate, label); ``default`` otherwise."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def stars(p) -> Column:
    """Significance markers for |rho|: >0.3 '***', >0.1 '**', else ''."""
    a = F.abs(_c(p))
    return verdict(a, [(a > F.lit(0.3), "***"), (a > F.lit(0.1), "**")], "")


def label_map(c, mapping: dict) -> Column:
    """C14: code -> label through a literal map."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(c)]


def period_label(c="time_period") -> Column:
    return label_map(c, dict(enumerate(PERIOD_NAMES)))


def fold_of(c="row_id", k: int = 5, seed: int = 0) -> Column:
    """Fold from a 32-bit multiplicative hash of the row key.

    ``floor((((key + seed) mod 2^31) * 2654435761 mod 2^32) / 2^16) mod k``;
    the first modulo keeps the product inside a long. Same value in DuckDB.
    """
    key = (_c(c) + F.lit(seed)) % F.lit(2147483648)
    h = (key * F.lit(2654435761)) % F.lit(4294967296)
    return (F.floor(h / F.lit(65536)).cast("long") % F.lit(k)).cast("int")


def mix32(c="row_id", seed: int = 0) -> Column:
    """Deterministic 32-bit order key for sampling, independent of the folds.

    A second multiplication follows the fold's first one, after its halves change places, so rows with
    near order keys are spread over all folds; ``seed`` enters both rounds. Same value in DuckDB.
    """
    h = (((_c(c) + F.lit(seed)) % F.lit(2147483648)) * F.lit(2654435761)) % F.lit(4294967296)
    swapped = (h % F.lit(65536)) * F.lit(65536) + F.floor(h / F.lit(65536)).cast("long")
    return (((swapped + F.lit(seed * 40503)) % F.lit(2147483648)) * F.lit(2246822519)) % F.lit(4294967296)


def round_half_away(c, digits: int) -> Column:
    """``round(x * 10^d) / 10^d`` with halves away from zero, in plain double
    arithmetic (codegen; no per-value BigDecimal). Equals the usual C library
    rounding used by SQL engines on doubles."""
    scale = F.lit(float(10 ** digits))
    v = _c(c).cast("double") * scale
    return F.signum(v) * F.floor(F.abs(v) + F.lit(0.5)) / scale
