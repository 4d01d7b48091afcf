"""11. Mixing sources to target weights: a curriculum whose weights change over training time.

1. Sizes are word counts. ``targets`` numbers the sources by code point (null last), deals them the classes of
   ``CLASSES`` in turn and shares ``share`` of all words by class weight; a source stops at ``most`` times its own
   words and the excess goes to the others by weight. That is one water level, found from running totals over
   the sources in the order in which they fill up.
2. A class has a weight schedule: weights at times from 0 to 1, linear between them. Its integral is the share of a source's
   words that training has asked for by a time. Documents of a source stand in hash order; running totals
   tell how many words stand before each, and the inverse of the integral tells when the first of them is asked
   for: the document's time. What a source owes beyond its words starts its documents again (``epoch``), and the
   last document of a source is cut where its target ends.
3. Rows are range-sorted by time, and running totals give ``position``, the words of the mix before each.

No step needs a source in one task: running totals go by ranges of (source, hash), and targets join by ``lookup``.

Null text and texts without words have size 0 and aren't taken; null source is a source like any other, a null id an id.
Repeated rows are documents of their own: rows equal in source, id, size and text may change places, which no result shows.
An empty table gives none. Result columns replace columns of their names. Runs on equal rows agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import row_position, running_totals
from .common import lookup, stored, text_or_empty

#: (weight, schedule) of the classes: heavy sources early, light ones late. A schedule lists (time, weight) from time 0 to 1.
CLASSES = ((5.0, ((0.0, 1.5), (1.0, 0.5))), (2.0, ((0.0, 1.0), (1.0, 1.0))), (1.0, ((0.0, 0.5), (1.0, 1.5))))
#: Words of the mix against all words, and words that a source gives at most against its own.
SHARE, MOST = 1.5, 2.0
MADE = ["size", "source_size", "target", "epoch", "words", "time", "position"]


def measured(df: DataFrame, text: str, source: str, doc_id: str, keep: Sequence[str]) -> DataFrame:
    """A row a document, written once: _row, _own (columns ``keep``), source, hash order, size."""
    own = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    return stored(df.select(
        F.monotonically_increasing_id().alias("_row"), own.alias("_own"), F.col(f"`{source}`").alias("source"),
        F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")).alias("_h"),
        F.regexp_count(text_or_empty(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(F.col(f"`{text}`")).alias("_x")), "sized")


def targets(rows: DataFrame, classes=CLASSES, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, rows, source_size, class, target) of the rows (source, size)."""
    sources = rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    sources = sources.withColumn("_last", F.col("source").isNull())
    placed = row_position(sources, ["_last", "source"], out="_at")
    weights = F.array(*[F.lit(float(w)) for w, _ in classes])
    placed = placed.withColumn("class", ((F.col("_at") - 1) % len(classes)).cast("int"))
    placed = placed.withColumn("_w", F.element_at(weights, F.col("class") + 1)).withColumn("_cap", F.col("source_size") * F.lit(most))
    placed = stored(placed.withColumn("_full", F.col("_cap") / F.col("_w")), "sources")
    # the level at which a source is full; those with smaller ones are full before it
    levels = placed.groupBy("_full").agg(F.sum("_cap").alias("c"), F.sum("_w").alias("w"), F.sum("source_size").cast("double").alias("s"))
    run = running_totals(levels, ["_full"], ["c", "w", "s"])
    level = (F.lit(share) * F.col("s_all") - (F.col("c_cum") - F.col("c"))) / (F.col("w_all") - (F.col("w_cum") - F.col("w")))
    found = run.withColumn("_level", level).where("_level <= _full").select(F.min_by("_level", "_full")).scalar()
    return placed.select("source", "rows", "source_size", "class", F.least("_cap", F.coalesce(F.col("_w") * found, F.col("_cap"))).alias("target"))


def asked(schedule: Sequence[tuple[float, float]], share: Column) -> Column:
    """Time at which the integral of the schedule reaches ``share`` of itself."""
    pieces, total = [], 0.0
    for (a, x), (b, y) in zip(schedule, schedule[1:]):
        pieces.append((a, b, x, y, total))
        total += (b - a) * (x + y) / 2
    if not total > 0 or any(w < 0 for _, w in schedule):
        raise ValueError("a schedule needs weights of 0 or more with a positive integral")
    want, out = share * F.lit(total), F.lit(float(schedule[-1][0]))
    for a, b, x, y, before in reversed(pieces):
        # x * t + slope / 2 * t * t = rest, in the form that also holds for slope 0
        rest, slope = want - F.lit(before), (y - x) / (b - a)
        root = F.lit(x) + F.sqrt(F.greatest(F.lit(x * x) + F.lit(2 * slope) * rest, F.lit(0.0)))
        inside = F.lit(a) + F.when(root > 0, F.lit(2.0) * rest / root).otherwise(F.lit(0.0))
        end = before + (b - a) * (x + y) / 2
        out = F.when(want <= F.lit(end), F.least(inside, F.lit(float(b)))).otherwise(out)
    return out


def placed(rows: DataFrame, goals: DataFrame, classes=CLASSES, most: float = MOST) -> DataFrame:
    """The mix of ``measured`` rows and their ``targets``: _row and MADE."""
    run = running_totals(rows.drop("_own"), ["_h", "size", "_x", "_row"], ["size"], ["source"])
    run = stored(run.select("_row", "source", "_h", "size", (F.col("size_cum") - F.col("size")).alias("_before")), "in_order")
    run = lookup(run, goals, ["source"], "rows", run.count()).withColumn("_goal", F.floor("target").cast("long"))
    turns = run.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max(1, math.ceil(most)) - 1))))
    start = F.col("epoch").cast("long") * F.col("source_size") + F.col("_before")
    turns = turns.withColumn("_start", start).withColumn("words", F.least(F.col("size"), F.col("_goal") - F.col("_start"))).where("words > 0")
    done = F.col("_start") / F.col("_goal")
    time = F.lit(None).cast("double")
    for i, (_, schedule) in reversed(list(enumerate(classes))):
        time = F.when(F.col("class") == i, asked(schedule, done)).otherwise(time)
    turns = turns.withColumn("time", time).select("_row", "_h", "size", "source_size", "target", "epoch", "words", "time")
    out = running_totals(turns, ["time", "_h", "epoch", "_row"], ["words"])
    return out.select("_row", "size", "source_size", "target", "epoch", "words", "time", (F.col("words_cum") - F.col("words")).alias("position"))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", classes=CLASSES, share: float = SHARE,
        most: float = MOST, keep: Sequence[str] | None = None) -> DataFrame:
    """The documents in training order (columns ``keep``, all by default), a row each time one is taken, with the columns MADE.

    ``words`` of the document's first words are taken, all but for the last one of a source.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in MADE]
    rows = measured(df, text, source, doc_id, keep)
    goals = stored(targets(rows, classes, share, most), "targets")
    out = placed(rows, goals, classes, most).join(rows.select("_row", "_own"), "_row")
    out = out.repartitionByRange("position").sortWithinPartitions("position")
    return out.select(*[F.col("_own").getField(c).alias(c) for c in keep], *MADE)


def taken(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", classes=CLASSES, share: float = SHARE,
          most: float = MOST, keep: Sequence[str] | None = None) -> DataFrame:
    """Every row of ``df`` (columns ``keep``) with size, source_size, target and taken: the words that the mix takes of it."""
    made = ["size", "source_size", "target", "taken"]
    keep = [c for c in (df.columns if keep is None else keep) if c not in made]
    rows = measured(df, text, source, doc_id, keep)
    goals = stored(targets(rows, classes, share, most), "targets")
    mixed = placed(rows, goals, classes, most).groupBy("_row").agg(F.sum("words").alias("taken"))
    out = lookup(rows, goals, ["source"], "rows", rows.count()).join(mixed, "_row", "left")
    return out.select(*[F.col("_own").getField(c).alias(c) for c in keep], "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
