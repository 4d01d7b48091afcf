"""Feature path: raw observations -> tier-1 -> tier-2 features (one lazy plan).

Every step is a column expression or a keyed join, so Catalyst fuses the
projections into one codegen stage and prunes columns that a caller drops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import encode, transform
from ..session import stored

EXCLUDE = ["invalid_ratio", "grid_lon", "grid_lat", "grid_id", "grid_period"]

# Incremental feature groups (each adds to the previous ones), as in the ablation.
FEATURE_GROUPS = {
    "base": ["total_count", "lon", "lat", "precip", "snow", "temp", "wind", "hour", "dow", "month"],
    "count": ["log_total_count", "count_bin"],
    "cyclical": ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"],
    "spatial": ["grid_te"],
    "temporal_spatial": ["grid_period_te", "time_period"],
    "weather": ["is_raining", "has_snow"],
    "grid_stats": ["grid_avg_count", "grid_violation_std", "grid_sample_count"],
}
# Features dropped in the pruned set.
WEAK_FEATURES = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_raining", "has_snow"]


def cumulative_groups(groups: dict[str, list[str]] = FEATURE_GROUPS) -> dict[str, list[str]]:
    """Each named set holds its group plus all earlier ones."""
    out, acc = {}, []
    for name, cols in groups.items():
        acc = acc + list(cols)
        out[name] = list(acc)
    return out


def with_keys(df: DataFrame, folds: int = 5, fold_col: str = "fold") -> DataFrame:
    """Cell keys, fold, count bin, period and cross key."""
    return df.withColumns({
        "grid_lon": fx.grid_axis("lon"),
        "grid_lat": fx.grid_axis("lat"),
    }).withColumns({
        "grid_id": fx.grid_id("grid_lon", "grid_lat"),
        "count_bin": fx.cut("total_count"),
        "time_period": fx.time_period("hour"),
        fold_col: fx.fold_of("row_id", folds),
    }).withColumn("grid_period", fx.cross_key("grid_id", "time_period", 10))


def tier1_columns(df: DataFrame) -> DataFrame:
    """C1 + C3: log count and the six cyclical terms."""
    hs, hc = fx.cyclical("hour", 24)
    ds, dc = fx.cyclical("dow", 7)
    ms, mc = fx.cyclical("month", 12, shift=1)
    return df.withColumns({"log_total_count": fx.log_count("total_count"),
                           "hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc,
                           "month_sin": ms, "month_cos": mc})


def fill_missing(train: DataFrame, test: DataFrame, wind_median: Column | None = None):
    """B6 + B7: snow -> 0; wind -> train median (fitted on train only)."""
    med = transform.MedianFill("wind").fit(train) if wind_median is None else None
    out = []
    for d in (train, test):
        d = transform.fill_const(d, {"snow": 0.0})
        d = med.apply(d) if med is not None else d.withColumn("wind", F.coalesce("wind", wind_median))
        out.append(d)
    return out[0], out[1]


def features(train: DataFrame, test: DataFrame, folds: int = 5, cell_smooth: float = 30.0,
             period_smooth: float = 50.0, y: str = "invalid_ratio"):
    """Tier-2 features for train (OOF encodings) and test (full-train encodings).

    Returns ``(train_features, test_features)``.
    """
    train, test = fill_missing(train, test)
    train = tier1_columns(with_keys(train, folds))
    test = tier1_columns(with_keys(test, folds))
    tr, te = encodings(train, test, cell_smooth, period_smooth, y)
    ind = {"is_raining": fx.indicator("precip"), "has_snow": fx.indicator("snow")}
    tr, te = tr.withColumns(ind), te.withColumns(ind)
    stats = stored(transform.cell_stats(train, "grid_id", y), "cell_stats")  # its size is known then: a small one is broadcast, no row is shuffled
    glob = transform.global_stats(train, "grid_id", y, sizes=stats.select(F.col("grid_sample_count").alias("_zk_sz")))
    tr = tr.join(stats, on="grid_id", how="left")
    te = transform.fill_unseen(te.join(stats, on="grid_id", how="left"), glob)
    return tr, te


def encodings(train: DataFrame, test: DataFrame, cell_smooth: float = 30.0, period_smooth: float = 50.0, y: str = "invalid_ratio"):
    """Cell and period-cell encodings of keyed rows: out of fold for train, of all train rows for test, both from one table of sums."""
    stats = encode.stored_stats(train, ["grid_id", "grid_period"], y)
    mu = encode.mean_of(stats)
    tr, te = train, test
    for key, smooth, out in (("grid_id", cell_smooth, "grid_te"), ("grid_period", period_smooth, "grid_period_te")):
        tr = encode.kfold_encode(tr, key, y, "fold", smooth, out, mu, stats=stats)
        te = encode.apply_encoding(te, encode.full_table(stats, key, smooth, mu), key, out, fill=encode.as_stored(mu))
    return tr, te


def feature_columns(df: DataFrame, exclude=EXCLUDE, extra_exclude=("row_id", "fold", "split")) -> list[str]:
    """B2: every column except target, helper keys and bookkeeping columns."""
    drop = set(exclude) | set(extra_exclude)
    return [c for c in df.columns if c not in drop]
