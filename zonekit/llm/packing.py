"""4. Best-fit packing by the sum of squares.

A piece goes where the sum of N(g)^2 over all residual gaps g becomes smallest, N(g) being the open sequences
with g tokens left; it opens a sequence only if it fits in none. Pieces come in decreasing length, which leaves
the short ones for the gaps. Pieces of full length are sequences of their own.

All pieces are dealt evenly to shards of about ``SHARD`` pieces (their number follows from the count of pieces),
each packed by itself, so that no task grows with the input; a shard wastes some sequences at its end only.
The shard of a row follows from its place in the stored piece table: repeated rows spread evenly.

``pieces``: null text counts as empty; every document, also an empty or repeated one or one without an id, ends
with ``end_id``, so no piece is empty. Only documents longer than ``capacity`` are cut, into pieces of that length,
of which the first takes the rest. ``pack``: adds ``sequence_id`` and ``offset``; lengths must lie in 1..capacity.
Columns of these names are replaced, all others are kept; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .pieces import in_passes, whole_texts

#: Pieces that one task packs; bounds its memory, and what a shard's last open sequences waste.
SHARD = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def pieces(df: DataFrame, path: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece (from 0), start, length, ids (packed little-endian unsigned 32-bit)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = whole_texts(path).encode_all
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in in_passes(texts):
                out = []
                for key, ids in zip(keys[part], encode_all(texts[part])):
                    ids += end
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    bounds = [0, *range(first, n + 1, capacity)]
                    out += [(key, i, a, b - a, ids[4 * a:4 * b]) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["doc_id", "piece", "start", "length", "ids"])

    return df.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each piece, for lengths in decreasing order."""
    open_with = np.zeros(capacity + 1, np.int64)  # N(g)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # the sequences with gap g
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    never, used = np.iinfo(np.int64).max, 0
    for i, n in enumerate(lengths.tolist()):
        at, gap = -1, capacity
        if n < capacity:
            here = open_with[n:capacity]  # gaps n .. capacity - 1; change of the sum when a piece goes there:
            change = np.where(here > 0, 2 * (open_with[:capacity - n] - here) + 2, never)
            change[0] = 1 - 2 * here[0] if here[0] else never  # gap n closes
            at = int(change.argmin())
        if at >= 0 and change[at] != never:
            gap = n + at
            open_with[gap] -= 1
            number[i] = waiting[gap].pop()
        else:
            number[i] = used
            used += 1
        offset[i] = capacity - gap
        if gap > n:
            open_with[gap - n] += 1
            waiting[gap - n].append(int(number[i]))
    return number, offset


def pack(df: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``df`` with sequence_id and offset: sequences of at most ``capacity`` tokens, gapless from 0.

    Tasks pack lengths alone, whatever else a row holds (ids are a hundred times as large), and the places are joined back.
    """
    df = df.drop("sequence_id", "offset")
    fixed = stored(df.withColumn("_row", F.monotonically_increasing_id()), "pieces", "zstd")
    shards = max(1, -(-fixed.count() // SHARD))
    keys = [c for c in ("doc_id", "piece") if c in df.columns]

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("_length", "descending"), *[(c, "ascending") for c in keys], ("_row", "ascending")])
        number, offset = sum_of_squares(table.column("_length").to_numpy(), capacity)
        return pa.table({"_row": table.column("_row"), "sequence_id": pa.array(number * shards + key[0].as_py()), "offset": pa.array(offset)})

    slim = fixed.select("_row", F.col(length).cast("long").alias("_length"), *[k for k in keys if k != length],
                        F.pmod("_row", F.lit(shards)).alias("_shard"))
    places = slim.groupBy("_shard").applyInArrow(place, "_row long, sequence_id long, offset long")
    return fixed.join(places, "_row").drop("_row")
