"""3. Document fingerprints by locally consistent parsing.

A text is parsed level by level. On each level runs of one name become one name; deterministic coin tossing turns
the names (no two neighbours equal) into a few labels that depend on some names to the left only; a phrase begins
at each local maximum of the labels, and its name is a hash of the names in it. So a substring that stands in two
texts is parsed alike in both, save for a few phrases at its ends, whatever its offset.

A fingerprint keeps, for each of ``BINS`` classes of phrase names of all levels, one byte of the least name; their
share of agreement estimates how many phrases two texts share (0 to 1). Equal texts have equal fingerprints.

``fingerprint`` adds the column to any table. ``neighbours`` compares each text with its next document by ascending
id and with its own edited form. Null text counts as empty (its fingerprint is all zeros; two empty texts are alike,
an empty and another are not). Documents without an id come first, by a hash of their texts; equal ids stand in the
order of such a hash, then of the texts; repeated rows are documents of their own. The id is expected to be a key: rows that
repeat one id go to one task. Extra columns are not read. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import default_parts
from .pieces import in_passes

#: Classes of phrase names, one byte each in the fingerprint (0: no phrase).
BINS = 128
#: Levels of the parse: phrases of a few characters up to those of about a thousand.
LEVELS = 5
#: Mixing constants of a common 64-bit finaliser.
_A, _B, _C = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)

NEIGHBOURS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= _A
    x ^= x >> np.uint64(33)
    x *= _B
    x ^= x >> np.uint64(33)
    return x


def toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing: twice the lowest bit in which a name differs from the one before, plus that bit."""
    differ = names[1:] ^ names[:-1]
    differ &= ~differ + differ.dtype.type(1)
    at = np.bitwise_count(differ - differ.dtype.type(1))
    labels = np.empty(len(names), np.uint8)
    labels[1:] = 2 * at + ((names[1:] >> at.astype(names.dtype)) & names.dtype.type(1)).astype(np.uint8)
    labels[first] = (names[first] & names.dtype.type(1)).astype(np.uint8)
    return labels


def level(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of the next level, and where each text starts in them. ``starts``: of texts that have names."""
    # runs of one name become a name of their own
    new = np.empty(len(names), bool)
    new[0] = True
    np.not_equal(names[1:], names[:-1], out=new[1:])
    new[starts] = True
    heads = np.flatnonzero(new)
    if len(heads) < len(names):
        lengths = np.diff(np.append(heads, len(names)))
        starts = np.searchsorted(heads, starts)
        names = names[heads]
        long = lengths > 1
        names[long] = mix(names[long].astype(np.uint64) * _C + lengths[long].astype(np.uint64)).astype(names.dtype)
    labels = names
    for _ in range(4):
        labels = toss(labels, starts)
    peak = np.zeros(len(names), bool)
    peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
    peak[starts[1:] - 1] = False  # a text's last name is beside another text only here
    peak[starts] = True
    heads = np.flatnonzero(peak)
    offset = np.arange(len(names)) - np.repeat(heads, np.diff(np.append(heads, len(names))))
    parts = mix(names.astype(np.uint64) + (offset.astype(np.uint64) + np.uint64(1)) * _C)
    return mix(np.add.reduceat(parts, heads)), np.searchsorted(heads, starts)


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of ``BINS`` bytes a text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    least = np.full(len(texts) * BINS, np.iinfo(np.uint64).max, np.uint64)
    some = np.flatnonzero(lengths)
    if len(some):
        names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        starts = (np.cumsum(lengths) - lengths)[some]
        for _ in range(LEVELS):
            names, starts = level(names, starts)
            owner = np.repeat(some, np.diff(np.append(starts, len(names))))
            np.minimum.at(least, owner * BINS + (names % np.uint64(BINS)).astype(np.int64), names)
    empty = least == np.iinfo(np.uint64).max
    out = ((least >> np.uint64(24)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    out[empty] = 0
    return out.reshape(len(texts), BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common phrases, row by row; chance agreement of bytes is taken off."""
    used = ((a > 0) | (b > 0)).sum(1)
    same = ((a == b) & (a > 0)).sum(1) / np.maximum(used, 1)
    return np.where(used == 0, 1.0, np.clip((same - 1 / 255) / (1 - 1 / 255), 0, 1))


def fingerprint(df: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """``df`` with column ``to``: the fingerprint of ``text`` as hexadecimal digits."""

    @F.arrow_udf("string")
    def prints(column: pa.Array) -> pa.Array:
        texts = [t or "" for t in column.to_pylist()]
        return pa.array([row.tobytes().hex() for part in in_passes(texts) for row in fingerprints(texts[part])], pa.string())

    return df.withColumn(to, prints(F.col(text).cast("string")))


def in_order(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (part, look, k, t) sorted in partitions by (part, look, k, t): part after part in the order of the ids,
    and at the end of each part, marked ``look``, the row that follows it (after the last the first)."""
    spark = df.sparkSession
    rows = df.select(F.col(doc_id).cast("long").alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    parts = 3 * default_parts(spark)
    shares = [i / parts for i in range(1, parts)] or [0.5]
    # a bound a part, and below the first id of each part: both as many as there are parts
    bounds = rows.agg(F.percentile_approx("k", shares, 100 * parts)).first()[0] or []
    edges = np.unique(np.array(bounds, np.int64))

    @F.arrow_udf("int")
    def part(k: pa.Array, h: pa.Array) -> pa.Array:
        ids = k.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.searchsorted(edges, ids, "right").astype(np.int64)
        spread = ((h.to_numpy(zero_copy_only=False).astype(np.float64) / 2**64 + 0.5) * parts).astype(np.int64).clip(0, parts - 1)
        return pa.array(np.where(k.is_null().to_numpy(zero_copy_only=False), spread - parts, at), pa.int32())

    placed = rows.withColumn("part", part("k", "h"))
    firsts = sorted((r["part"], r["f"]["k"], r["f"]["h"]) for r in placed.groupBy("part").agg(
        F.min(F.struct((F.col("k").isNotNull()).alias("n"), "k", "h")).alias("f")).select("part", "f.*").select(
        "part", F.struct("k", "h").alias("f")).collect())
    before = {(k, h): firsts[i - 1][0] for i, (_, k, h) in enumerate(firsts)}

    @F.arrow_udf("int")
    def ahead(k: pa.Array, h: pa.Array) -> pa.Array:
        return pa.array([before.get(x) for x in zip(k.to_pylist(), h.to_pylist())], pa.int32())

    both = placed.withColumn("ahead", ahead("k", "h")).select("k", "t", "h", F.explode(F.expr(
        "if(ahead is null, array(struct(part as part, false as look)), "
        "array(struct(part as part, false as look), struct(ahead as part, true as look)))")).alias("x"))
    order = ["part", "look", F.col("k").asc_nulls_first(), "h", "t"]
    return both.select("x.*", "k", "t", "h").repartition(default_parts(spark), "part").sortWithinPartitions(*order).select("part", "look", "k", "t")


def neighbours(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text (the last quarter of its code points replaced by the
    first as many of the next document), and the likeness of both and of the next document's to its own."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the rows from the last one on that still needs its next

        def results(rows: list[tuple]) -> pa.RecordBatch:
            """For all but the last of the rows; look-ahead rows give none."""
            import hashlib
            texts = [r[3] for r in rows]
            edited = []
            for a, b in zip(texts, texts[1:]):
                n = len(a)
                edited.append(a[:n - n // 4] + b[:n // 4])
            own, made = fingerprints(texts), fingerprints(edited)
            near_edited, near_next = likeness(own[:-1], made), likeness(own[:-1], own[1:])
            keep = [i for i, r in enumerate(rows[:-1]) if not r[1]]
            return pa.RecordBatch.from_arrays([
                pa.array([rows[i][2] for i in keep], pa.int64()), pa.array([len(texts[i]) for i in keep], pa.int64()),
                pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in keep]),
                pa.array([own[i].tobytes().hex() for i in keep]), pa.array([made[i].tobytes().hex() for i in keep]),
                pa.array(near_edited[keep]), pa.array(near_next[keep])], names=[c.split()[0] for c in NEIGHBOURS.split(", ")])

        def flow(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal held
            for row in rows:
                if held and held[-1][1] and row[0] == held[-1][0]:
                    continue  # one look-ahead row is enough
                held.append(row)
            for part in in_passes(held[:-1], lambda r: len(r[3])):
                if part.stop < len(held):
                    yield results(held[part.start:part.stop + 1])
            held = held[-1:]

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                piece = batch.slice(at, 1000)
                yield from flow(list(zip(*(piece.column(i).to_pylist() for i in range(4)))))

    return in_order(df, doc_id, text).mapInArrow(compare, NEIGHBOURS)
