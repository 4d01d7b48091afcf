"""9. Token-ID output: flat unsigned integer files with 64-bit document offsets, memory-mapped.

``write`` sorts the documents by id over range partitions; each task writes one shard: ``.bin`` holds the ids, two
bytes each if every id of the vocabulary fits, else four; ``.idx`` is int64: documents, documents without an id,
then the offset of each document and the end, then the ids of the documents. A task names its files by itself and
returns their names; only the rows of tasks that succeed reach the manifest, so files of lost attempts are not read.
The place of a shard in the whole (``base``) is the sum of the tokens in the shards before it.

Null text counts as empty and has the end id only. Documents without an id come first; documents with equal ids
stand in the order of their texts; repeated rows are all written. Other columns are not read. An empty table makes
an empty manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import open_folder, stored
from .pieces import in_passes, whole_texts

MANIFEST = "part int, bin string, idx string, documents long, tokens long, width int"
DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def write(df: DataFrame, path: str, end_id: int, folder: str | None = None, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Write all documents; returns the stored manifest, one row a shard, with its ``base``."""
    folder = folder or scratch_path(df.sparkSession, "tokens")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = whole_texts(path)
        top = max(end_id, encoder.pieces.library.get_vocab_size(True) - 1)
        kind = np.dtype("<u2" if top < 1 << 16 else "<u4")
        store, place = open_folder(folder)
        part = TaskContext.get().partitionId()
        name = f"{place}/{part:06d}-{uuid.uuid4().hex[:12]}"
        out, counts, ids_of, nulls = None, [], [], 0
        for batch in batches:
            keys = batch.column(0)
            nulls += keys.null_count
            ids_of.append(keys.fill_null(0).to_numpy(zero_copy_only=False))
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for chunk in in_passes(texts):
                for ids in encoder.encode_all(texts[chunk]):
                    if out is None:
                        store.create_dir(place, recursive=True)
                        out = store.open_output_stream(f"{name}.bin")
                    out.write(np.append(np.frombuffer(ids, "<u4"), end_id).astype(kind).tobytes())
                    counts.append(len(ids) // 4 + 1)
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        with store.open_output_stream(f"{name}.idx") as index:
            index.write(np.concatenate([[len(counts), nulls], offsets, *ids_of]).astype("<i8").tobytes())
        row = {"part": part, "bin": f"{name}.bin", "idx": f"{name}.idx", "documents": len(counts), "tokens": int(offsets[-1]),
               "width": kind.itemsize}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("bin", pa.string()), ("idx", pa.string()),
                                                           ("documents", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32())]))

    rows = df.select(F.col(doc_id).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    order = [F.col("k").asc_nulls_first(), F.xxhash64("t"), F.col("t")]
    manifest = stored(rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(shard, MANIFEST), "manifest")
    # one row a shard: a running sum over the manifest, not over data
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return manifest.select("*", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long").alias("base"), F.lit(folder).alias("folder"))


def mapped(store, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where the store is a mounted folder, else read."""
    if store.type_name == "local":
        return np.memmap(path, kind, "r")
    with store.open_input_stream(path) as f:
        return np.frombuffer(f.read(), kind)


def read(manifest: DataFrame) -> DataFrame:
    """One row a document of the shards: doc_id, start (ids of all documents before it), n_tokens, ids."""
    files = max(1, manifest.count())

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, _ = open_folder(row["folder"])
                index = mapped(store, row["idx"], "<i8")
                tokens = mapped(store, row["bin"], f"<u{row['width']}")
                n, nulls = int(index[0]), int(index[1])
                offsets, keys = index[2:n + 3], index[n + 3:]
                for a in range(0, n, 1000):
                    b = min(n, a + 1000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[a:b], pa.int64(), mask=np.arange(a, b) < nulls), pa.array(offsets[a:b] + row["base"], pa.int64()),
                         pa.array(np.diff(offsets[a:b + 1]), pa.int64()),
                         pa.array([tokens[x:y].astype("<u4").tobytes() for x, y in zip(offsets[a:b], offsets[a + 1:b + 1])], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    return manifest.repartition(files).mapInArrow(load, DOCUMENT)
