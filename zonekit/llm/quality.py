"""8. Quality rules with adaptive thresholds, in DataFrame functions only.

``measure`` counts on each whole text; ``thresholds`` sketches the ratios of the texts that pass the base rules
per language and source (counts over bins of equal relative width, built before the shuffle and merged after it) and sets fences from their
quantiles; ``filtered`` joins the fences to the rows. A group of fewer than ``GROUP_DOCS`` texts takes the merged
sketch of its language, and a language of so few that of all texts.

A ratio is rejected beyond ``median + WIDTH * max(q75 - median, floor)``; mean word length also below the mirrored
fence. The floors only keep a fence apart from the median where the sketch has no spread.

Null text counts as empty: no words, so it fails the base rules. Null language or source is a group like any other.
Repeated rows count each. Columns named like a result are replaced, others kept; an empty table stays empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, packed, stored, text_or_empty, unpacked

#: Texts that a group needs for fences of its own, width of the fences.
GROUP_DOCS, WIDTH = 100, 4.0
#: Bins of the sketches: least value told from zero, growth from bin to bin.
LEAST, GROWTH = 1e-6, 1.005
#: Ratios and the least spread that counts for each (word length in characters).
FLOORS = {"symbol_ratio": 0.005, "dup_line_ratio": 0.005, "repeat_ratio": 0.005, "word_length": 0.125}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SPACES = " \t\n\x0b\x0c\r"


def _without(text: str, chars: str) -> Column:
    out = F.col(text)
    for c in chars:
        out = F.replace(out, F.lit(c))
    return out


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of COUNTS, ``base_failed`` and the ratios of FLOORS."""
    own = [c for c in df.columns if c not in {*COUNTS, *FLOORS, "base_failed"}]
    d = df.select(packed(own).alias("_own"), text_or_empty(f"`{text}`").alias("_t"))  # no name of the caller's meets one of these
    d = d.withColumn("_w", F.expr(r"array_remove(split(_t, '[ \\t-\\r]+'), '')"))
    d = d.withColumn("_l", F.expr(r"filter(split(_t, '\\n'), x -> x rlike '[^ \\t-\\r]')"))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    # a word is its 64-bit hash from here on, a window the hash of three
    d = d.withColumn("_h", F.expr("transform(_w, x -> xxhash64(x))"))
    d = d.withColumn("_x", F.expr("transform(arrays_zip(slice(_h, 1, greatest(size(_h) - 2, 0)), slice(_h, 2, greatest(size(_h) - 2, 0)), "
                                  "slice(_h, 3, greatest(size(_h) - 2, 0))), x -> xxhash64(x))"))
    # only texts in which a window repeats sort their windows; equal ones are then neighbours
    d = d.withColumn("_s", F.expr("case when size(array_distinct(_x)) < size(_x) then "
                                  "sort_array(transform(_x, (x, i) -> struct(x as x, i as i))) else array() end"))
    d = d.withColumn("_p", F.expr("flatten(zip_with(slice(_s, 1, greatest(size(_s) - 1, 0)), slice(_s, 2, greatest(size(_s) - 1, 0)), "
                                  "(a, b) -> if(a.x = b.x, array(a.i, b.i), array())))"))
    d = d.withColumn("n_repeat_words", F.expr("size(array_distinct(flatten(transform(_p, i -> array(i, i + 1, i + 2)))))").cast("long"))
    d = d.withColumn("word_chars", F.length(_without("_t", SPACES)).cast("long"))
    d = d.withColumn("n_symbols", (F.length("_t") - F.length(_without("_t", "#*$%&|<>"))).cast("long"))
    d = d.withColumn("_n", F.size("_l"))
    d = d.withColumn("n_dup_lines", (F.col("_n") - F.size(F.array_distinct("_l"))).cast("long"))
    words = F.greatest(F.col("n_words"), F.lit(1))
    return d.select(
        *unpacked(own), *COUNTS,
        F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        (F.col("n_symbols") / words).alias("symbol_ratio"), (F.col("n_dup_lines") / F.greatest("_n", F.lit(1))).alias("dup_line_ratio"),
        (F.col("n_repeat_words") / words).alias("repeat_ratio"), (F.col("word_chars") / words).alias("word_length"))


def sketches(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, ratio, bin, n): how many passing texts of a group have each ratio in each bin; ratio -1 counts all its texts.

    Bin 0 holds zeros, bin i > 0 values from ``LEAST * GROWTH ** (i - 1)`` on. Counts of bins add up, so sketches merge exactly,
    and equal tables give equal quantiles, within half a bin's growth.
    """
    passing = ~F.col("base_failed")
    at = lambda r: F.when(F.col(r) <= 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.log(F.col(r) / LEAST) / math.log(GROWTH)) + 1)).cast("int")
    items = [F.struct(F.lit(-1).alias("ratio"), F.lit(0).alias("bin"))]
    items += [F.when(passing, F.struct(F.lit(i).alias("ratio"), at(r).alias("bin"))) for i, r in enumerate(FLOORS)]
    rows = measured.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(F.array(*items)).alias("b")).where("b is not null")
    return rows.groupBy("lang", "source", "b.ratio", "b.bin").agg(F.count("*").alias("n"))


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row a language and source: its rows, and a fence for each ratio."""
    found = stored(sketches(measured, lang, source), "sketches")
    groups = found.where("ratio = -1").select("lang", "source", F.col("n").alias("rows"))
    bins = found.where("ratio >= 0")
    nobody = F.lit(None).cast("string")
    level = lambda k, keys: bins.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n")).select(
        F.lit(k).alias("level"), *[(F.col(c) if c in keys else nobody).alias(c) for c in ("lang", "source")], "ratio", "bin", "n")
    merged = level(0, ["lang", "source"]).unionByName(level(1, ["lang"])).unionByName(level(2, []))
    own = Window.partitionBy("level", "lang", "source", "ratio")  # the bins of one sketch
    counted = merged.withColumns({"upto": F.sum("n").over(own.orderBy("bin")), "all": F.sum("n").over(own)})
    value = F.when(F.col("bin") == 0, 0.0).otherwise(LEAST * F.pow(F.lit(GROWTH), F.col("bin") - 0.5))
    quantile = lambda i, q: F.min(F.when((F.col("ratio") == i) & (F.col("upto") >= q * F.col("all")), value))
    wide = counted.groupBy("level", "lang", "source").agg(F.max("all").alias("n"), *[x for i, r in enumerate(FLOORS) for x in (
        quantile(i, 0.5).alias(f"middle_{r}"), quantile(i, 0.75).alias(f"high_{r}"))])
    spread = {r: F.greatest(F.col(f"high_{r}") - F.col(f"middle_{r}"), F.lit(f)) for r, f in FLOORS.items()}
    fences = stored(wide.select("level", "lang", "source", "n", *[(F.col(f"middle_{r}") + WIDTH * spread[r]).alias(f"most_{r}") for r in FLOORS],
                                (F.col("middle_word_length") - WIDTH * spread["word_length"]).alias("least_word_length")), "fences")
    names = [f"most_{r}" for r in FLOORS] + ["least_word_length"]
    side = lambda k: fences.where(F.col("level") == k).select("lang", "source", F.col("n").alias("enough"), F.struct(*names).alias("f")).alias(f"l{k}")
    g = groups.alias("g")
    best = g.join(side(0), F.col("g.lang").eqNullSafe(F.col("l0.lang")) & F.col("g.source").eqNullSafe(F.col("l0.source")), "left")
    best = best.join(side(1), F.col("g.lang").eqNullSafe(F.col("l1.lang")), "left")
    all_texts = fences.where("level = 2").select(F.struct(*names)).scalar()
    chosen = F.when(F.col("l0.enough") >= GROUP_DOCS, F.col("l0.f")).when(F.col("l1.enough") >= GROUP_DOCS, F.col("l1.f")).otherwise(all_texts)
    return best.select("g.lang", "g.source", "g.rows", chosen.alias("f")).select("lang", "source", "rows", "f.*")


def verdict() -> Column:
    """Whether a measured row passes the base rules and its fences."""
    inside = F.col("word_length") >= F.col("least_word_length")
    for r in FLOORS:
        inside &= F.col(r) <= F.col(f"most_{r}")
    return ~F.col("base_failed") & F.coalesce(inside, F.lit(True))


FENCES = [*[f"most_{r}" for r in FLOORS], "least_word_length"]


def judged(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
           keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with counts, ratios, base_failed, the fences of each row and ``kept``."""
    made = {*COUNTS, "base_failed", *FLOORS, *FENCES, "kept"}
    keep = [c for c in (df.columns if keep is None else keep) if c not in made]
    rows = df.select(packed(keep).alias("_own"), F.col(f"`{lang}`").alias("_lang"), F.col(f"`{source}`").alias("_source"), F.col(f"`{text}`").alias("_text"))
    measured = stored(measure(rows, "_text").drop("_text"), "measured")
    limits = thresholds(measured, "_lang", "_source")
    limits = stored(limits, "thresholds").withColumnsRenamed({"lang": "_lang", "source": "_source", "rows": "_rows"})
    out = lookup(measured, limits, ["_lang", "_source"], "_rows", measured.count())
    return out.select(*unpacked(keep), *COUNTS, "base_failed", *FLOORS, *FENCES, verdict().alias("kept"))


def filtered(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``df`` that pass the base rules and the fences of their language and source; all columns as they are.

    Texts are measured twice, for the sketches and for the verdict, so that no copy of them is written.
    """
    own = df.columns
    rows = df.select(F.col(f"`{text}`").alias("_text"), F.col(f"`{lang}`").alias("_lang"), F.col(f"`{source}`").alias("_source"),
                     packed([c for c in own if c != text]).alias("_rest"))
    measured = measure(rows.drop("_rest"), "_text").drop("_text")
    limits = thresholds(measured, "_lang", "_source")
    limits = stored(limits, "thresholds").withColumnsRenamed({"lang": "_lang", "source": "_source", "rows": "_rows"})
    total = limits.agg(F.sum("_rows")).first()[0] or 0
    # fences first: each row is then measured once, behind the join
    fenced = lookup(rows, limits.select("_lang", "_source", "_rows", *FENCES), ["_lang", "_source"], "_rows", total)
    # a filter on the verdict itself would be moved below the counts and compute them once for each use of one
    out = measure(fenced, "_text").select("_text", "_rest", F.explode(F.array(verdict())).alias("_kept")).where("_kept")
    return out.select(*[F.col("_text").alias(c) if c == text else F.col("_rest").getField(c).alias(c) for c in own])
