"""Registry of named queries and their DuckDB oracles.

``@query(name, sql=...)`` registers a ``(spark, sf_dir) -> DataFrame``
callable; the oracle text (if any) is the bound-view prefix plus ``sql``.
A query registered without SQL is checked on rows only (INV operators).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.features import round_half_away
from . import sqltext

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sqltext.oracle(sql)
        return fn
    return deco


def r6(c, alias: str | None = None) -> Column:
    """Round a computed double to 6 digits (both engines sum in other orders).

    Computed as ``round(x * 1e6) / 1e6`` - the same double arithmetic as the
    oracle engine's ``round(x, 6)`` - so exact ties round the same way.
    """
    col = F.col(c) if isinstance(c, str) else c
    out = round_half_away(col, 6)
    return out.alias(alias or (c if isinstance(c, str) else "value"))


def r6f(c, alias: str | None = None) -> Column:
    """Float32 storage then :func:`r6`: for means of discrete values that can
    sit on an exact 6-digit tie, where summation order decides the side."""
    col = F.col(c) if isinstance(c, str) else c
    return r6(col.cast("float").cast("double"), alias or (c if isinstance(c, str) else "value"))


def load_all() -> None:
    """Import every query module so its registrations run."""
    from . import (q_features, q_lookup, q_profile, q_ranks, q_stats, q_encode,  # noqa: F401
                   q_split, q_ensemble, q_checks, q_io, q_models)
