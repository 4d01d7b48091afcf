"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored  # noqa: F401 (used by the operators)

#: A key that holds more than this share of all rows is "hot". At most 1 / HOT_SHARE keys can be,
#: whatever the data, so a table of hot keys has a proven size and may be broadcast.
HOT_SHARE = 0.001


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def packed(columns: list[str]) -> Column:
    """The caller's columns as one struct, so that none of their names meets a name used here."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.struct(F.lit(0).alias("none"))


def unpacked(columns: list[str], pack: str = "_own") -> list[Column]:
    return [F.col(pack).getField(c).alias(c) for c in columns]


def sampled(df: DataFrame, text: str, most: int, width: int = 4000) -> list[str]:
    """Windows of up to ``width`` characters of the (about) ``most`` texts with the least hashes, in that order.

    The number of texts gives a bound that about twice as many hashes stay below, so tasks send no more than those.
    """
    col = F.col(f"`{text}`").cast("string")
    rows = df.where(F.octet_length(col) > 0).select(col.alias("t"), F.xxhash64(col).alias("h"))
    share = min(1.0, 2 * most / max(1, rows.count()))
    few = rows.where(F.col("h") <= F.lit(min(2**63 - 1, int(-2**63 + share * 2**64))))
    start = F.greatest(F.lit(1), F.pmod(F.col("h"), F.greatest(F.length("t") - width, F.lit(1))).cast("int") + 1)
    return [r["t"] for r in few.select("h", F.substring("t", start, F.lit(width)).alias("t")).orderBy("h", "t").limit(most).collect()]


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], count_col: str, total: int) -> DataFrame:
    """Left join ``rows`` to ``table`` (one row a key, ``count_col``: its number of rows), null-safe, whole.

    Keys with more than ``HOT_SHARE`` of ``total`` rows (at most ``1 / HOT_SHARE`` of them) are broadcast, the
    rest meets in a shuffle in which no key is hot. ``rows`` is read twice, so it should be stored or cheap.
    """
    limit = max(1, int(total * HOT_SHARE))
    hot = table.where(F.col(count_col) > limit)
    cold = table.where(F.col(count_col) <= limit)
    values = [c for c in table.columns if c not in keys]
    on = lambda r, t: [r[k].eqNullSafe(t[k]) for k in keys]

    def joined(part: DataFrame, side: DataFrame, how: str) -> DataFrame:
        r, t = part.alias("r"), side.alias("t")
        cond = [F.col(f"r.`{k}`").eqNullSafe(F.col(f"t.`{k}`")) for k in keys]
        return r.join(t, cond, how).select("r.*", *[F.col(f"t.`{v}`") for v in values])

    few = F.broadcast(hot)
    rest = rows.join(F.broadcast(hot.select(*keys)), on(rows, hot), "left_anti")
    return joined(rows, few, "inner").unionByName(joined(rest, cold, "left"))


def open_folder(uri: str):
    """(pyarrow file system, path) of a folder in the shared store, from driver or executor."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)


def groups(batches, keys: int):
    """(key, rows) of consecutive rows with equal values in the first ``keys`` columns; for sorted partitions."""
    key, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            piece = batch.slice(at, 1000)
            for row in zip(*(piece.column(i).to_pylist() for i in range(piece.num_columns))):
                if row[:keys] != key:
                    if rows:
                        yield key, rows
                    key, rows = row[:keys], []
                rows.append(row)
    if rows:
        yield key, rows


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the connected components of edges (u, v), root the least node; nodes without an edge aren't in it.

    Alternating large and small stars: each round links the neighbours of a node to the least of them, so a chain
    shrinks in a logarithmic number of rounds. Rounds end when the edges stay as they are; each is written to
    the shared folder. A node of many edges is reduced by a partial minimum before the shuffle.
    """
    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("edges"))

    def with_least(df: DataFrame, low: DataFrame) -> DataFrame:
        """Edges with the least neighbour of ``u``; those of a hub meet it by broadcast, on whatever task they are."""
        low = stored(low, "least")
        total = low.agg(F.sum("edges")).first()[0] or 0
        return lookup(df, low, ["u"], "edges", total).drop("edges")

    def mark(df: DataFrame):
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"), "edges")
        large = with_least(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large_star")
        low = least(large)
        joined = with_least(large, low)
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        now = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        if (last := mark(now)) == seen:
            break
        seen = last
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
