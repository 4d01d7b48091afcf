"""12. Prefix trie of conversations by truncation peeling.

A conversation is the sequence of its turns (role, text); every distinct sequence of first turns is a node.

1. ``sequences`` orders the turns of each conversation and keeps of a turn a 128-bit name and the bytes of its text.
2. Equal sequences are counted before anything else (``gathered``), so copies weigh one row each.
3. Distinct sequences are range-sorted: those with common first turns are neighbours, whatever part of all shares them.
4. A task peels its range (``peel``): it descends from the deepest turn; sequences that end at a depth join the nodes that
   survived from below, the last turn is stripped and survivors of one prefix become one node, which sums up what
   its children bring. A node is complete when its depth is reached, so one pass finds and aggregates all.
5. Only the first turns that a range shares with the range before it are in both. A task gets the sequence that ends the
   range before, counts such nodes (as child, as bytes) no second time and takes back the leaf if that sequence goes
   on here. What is left are sums, which a grouping by node puts together.

A task holds a range of about ``PART_BYTES`` of names; a sequence (24 bytes a turn) is never split. Ids of the sequences that
end at a node are hashed in order as a stream of blocks, never gathered.

Null turns come first, equal ones by role and name; null role or text is empty. Null id: a conversation of its own, after all
ids; it counts as a member, isn't the smallest one unless alone, and isn't among the ids hashed. Repeated rows are
turns of their own. Other columns don't matter. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parts
from .common import lookup, stored

#: Bytes of names that a task peels; ids of a block that is hashed at a time.
PART_BYTES, BLOCK_IDS = 16 << 20, 4096
NAME = 16
ROOT = bytes(NAME)
_NODES = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("convs", pa.int64()), ("first", pa.int64()),
                    ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.binary())])


def sequences(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): of each conversation the ordered turns (turn, role, name, bytes)."""
    who, what = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    name = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what), 256), 1, 2 * NAME))
    one = F.struct(F.col(f"`{turn}`").alias("turn"), who.alias("role"), name.alias("name"), F.octet_length(what).cast("long").alias("bytes"))
    return df.groupBy(F.col(f"`{conv_id}`").alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def gathered(seqs: DataFrame) -> DataFrame:
    """(seq, path, bytes, convs, first) of each distinct sequence; seq is its name, path the names of its turns."""
    return seqs.groupBy("seq").agg(F.first("path").alias("path"), F.first("bytes").alias("bytes"), F.count("*").alias("convs"), F.min("conv_id").alias("first"))


def chain(path: bytes) -> bytes:
    """Names of all nodes on a path, from the root."""
    out = [ROOT]
    for i in range(0, len(path), NAME):
        out.append(hashlib.blake2b(out[-1] + path[i:i + NAME], digest_size=NAME).digest())
    return b"".join(out)


def peel(rows: list[tuple], before: bytes | None) -> Iterator[tuple]:
    """Nodes of a range of distinct sequences (path, bytes, convs, first, seq) in order, as rows of ``_NODES``; ``before`` is the path that
    ends the range before."""
    chains = [chain(r[0]) for r in rows]
    ended = defaultdict(list)
    for i, r in enumerate(rows):
        ended[len(r[0]) // NAME].append(i)
    common, goes_on = -1, False
    if before is not None:
        first = rows[0][0]
        common = 0
        while before[common * NAME:(common + 1) * NAME] == first[common * NAME:(common + 1) * NAME] != b"":
            common += 1
        goes_on = common * NAME == len(before)
    alive: dict[bytes, list] = {}  # node -> [a sequence below, convs, first, own children, all children, leaves, tokens, bytes, ends]
    for depth in range(max(ended), -1, -1):
        at = depth * NAME
        for i in ended[depth]:
            _, _, convs, least, seq = rows[i]
            node = alive.setdefault(chains[i][at:at + NAME], [i, 0, None, 0, 0, 0, 0, 0, None])
            node[1] += convs
            node[2] = least if node[2] is None else node[2] if least is None else min(node[2], least)
            node[8] = seq
        above: dict[bytes, list] = {}
        for name, (i, convs, least, children, below, leaves, tokens, distinct, ends) in alive.items():
            shared = depth <= common and name == chains[0][at:at + NAME]
            here = rows[i][1][depth - 1] if depth else 0
            leaves += not below
            if shared and goes_on and depth == common:
                leaves -= 1
            tokens += convs * here
            distinct += 0 if shared else here
            up = chains[i][at - NAME:at] if depth else None
            yield name, up, depth, convs, least, children, leaves, tokens - distinct, ends
            if depth:
                node = above.setdefault(up, [i, 0, None, 0, 0, 0, 0, 0, None])
                node[1] += convs
                node[2] = least if node[2] is None else node[2] if least is None else min(node[2], least)
                node[3] += not shared
                node[4] += 1
                node[5] += leaves
                node[6] += tokens
                node[7] += distinct
        alive = above


def _peeled(table: pa.Table) -> pa.Table:
    rows, before = [], None
    columns = [table.column(c).to_pylist() for c in ("mark", "path", "bytes", "convs", "first", "seq")]
    for mark, *row in zip(*columns):
        if mark:
            before = row[0]
        else:
            rows.append(tuple(row))
    if not rows:
        return _NODES.empty_table()
    rows.sort(key=lambda r: r[0])
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*peel(rows, before)), _NODES.types)], schema=_NODES)


def ends_hashed(seqs: DataFrame, parts: int) -> DataFrame:
    """(seq, ends_sha256): SHA-256 of the ids of each sequence in ascending order, joined by commas."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, ids = None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([seq], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))], pa.string())],
                                              names=["seq", "at", "ids"])
        for batch in batches:
            made = []
            for s, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s != seq or len(ids) == BLOCK_IDS:
                    if ids:
                        made.append(out())
                    seq, ids = s, []
                ids.append(k)
            if made:
                yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]
        if ids:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, state = None, None
        names = ["seq", "ends_sha256"]
        for batch in batches:
            done = []
            for s, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if s != seq:
                    if state:
                        done.append((seq, state.hexdigest()))
                    seq, state = s, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.binary(), pa.string()))], names=names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([seq], pa.binary()), pa.array([state.hexdigest()])], names=names)

    known = seqs.where("conv_id is not null").select("seq", F.col("conv_id").cast("long").alias("at"))
    packed = known.repartitionByRange(parts, "seq", "at").sortWithinPartitions("seq", "at").mapInArrow(blocks, "seq binary, at long, ids string")
    return packed.repartition("seq").sortWithinPartitions("seq", "at").mapInArrow(hashed, "seq binary, ends_sha256 string")


def trie(seqs: DataFrame) -> DataFrame:
    """A row a node of the sequences (conv_id, turns): node, parent (names), conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (below and with the node, each node's convs but one times the bytes of its last text), ends_sha256."""
    spark = seqs.sparkSession
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["name"])), ""))
    flat = seqs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"))
    flat = stored(flat.select("conv_id", F.unhex(F.substring(F.sha2("path", 256), 1, 2 * NAME)).alias("seq"), "path", "bytes"), "sequences")
    distinct = stored(gathered(flat), "distinct")
    total = distinct.agg(F.sum(F.length("path").cast("long"))).first()[0] or 0
    parts = max(default_parts(spark), -(-total // PART_BYTES))
    ranged = stored(distinct.repartitionByRange(parts, "path").withColumn("part", F.spark_partition_id()), "ranges")
    last = ranged.groupBy("part").agg(F.max("path").alias("path"))
    follows = Window.orderBy("part")  # one row a range
    marks = last.select(F.lead("part").over(follows).alias("part"), "path").where("part is not null").select(
        F.lit(True).alias("mark"), "part", "path", F.lit(None).cast("array<bigint>").alias("bytes"), F.lit(0).cast("long").alias("convs"),
        F.lit(None).cast("long").alias("first"), F.lit(None).cast("binary").alias("seq"))
    rows = ranged.select(F.lit(False).alias("mark"), "part", "path", "bytes", "convs", F.col("first").cast("long").alias("first"), "seq")
    kinds = "node binary, parent binary, depth long, convs long, first long, children long, leaves long, saved long, ends binary"
    found = rows.unionByName(marks).groupBy("part").applyInArrow(_peeled, kinds)
    nodes = found.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("first").alias("conv_id"), F.sum("convs").alias("n_convs"),
        F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("ends").alias("ends"))
    nodes = stored(nodes, "nodes")
    above = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_rows"))
    named = lookup(nodes, above, ["parent"], "_rows", nodes.count()).drop("_rows")
    ended = ends_hashed(flat.select("conv_id", "seq"), parts)
    out = named.join(ended.withColumnRenamed("seq", "ends"), "ends", "left")
    return out.select("node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
