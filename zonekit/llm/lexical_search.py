"""13. Ranked lexical search: exact inner products on sparse vectors, by ball trees.

A document's vector holds the impact of each of its terms, (10^9 tf) div (1000 tf + 12 m); an item's vector the number of times it
holds a term by the term's weight. A score is their inner product, in 64-bit integers.

1. Items go in blocks of about ``BLOCK_TERMS`` terms; each block meets all documents, whose vectors keep only its terms (others
   add nothing to a score). One pass over the texts writes them; counts of documents, terms and term frequencies follow.
2. The top of the tree is fitted on a bounded sample of ``SAMPLE`` vectors: balls are halved by the line between two far
   ends, ``TOP`` times. Every document goes down its splits to a cell; a cell of more than ``SUBTREE`` terms in all is dealt
   to several subtrees by hash, so copies or one kind of document never grow a subtree.
3. A task builds one subtree (``Tree``): balls halved down to ``LEAF`` documents, each with its centroid and radius, the
   largest distance of a document from the centroid as stored.
4. No document of a ball scores more than <q, centroid> + |q'| radius, q' the item's terms that stand in the ball. Bounds are
   computed in doubles and raised by more than all rounding (``SLACK``). An item visits balls best bound first and
   stops at a bound below the score of its last place (equal bounds are visited: ids decide ties); leaves are scored exactly.
5. The first subtree of every cell is searched at first; the last place so reached is a floor for the others.
   The best of all subtrees are the answer, which no choice of sample, cells or floors changes.

Null text has no terms. Documents without terms count nowhere. Null ids stand after all others in ties. Repeated documents rank each;
rows of one item id and text are one item, and texts that share an id rank each for itself under it. Items without
terms and empty tables give no rows. Other columns don't matter.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Terms of a block of items; vectors that fit the top of the tree, its levels; stored terms of a subtree, documents of a leaf.
BLOCK_TERMS, SAMPLE, TOP, SUBTREE, LEAF = 20_000, 4096, 4, 1_000_000, 24
#: Raises a bound by far more than the relative error of sums of that many doubles.
SLACK = 1e-9
K1, B_PART, BASE = 12, 25, 100
NO_ID = np.iinfo(np.int64).max

_TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+").findall
_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text: str | None) -> list[str]:
    """Runs of letters, digits and characters beyond ASCII, A to Z lower-cased."""
    if not text:
        return []
    return _TERMS(text.lower() if text.isascii() else text.translate(_LOWER))


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """Impact of tf occurrences in a document of n terms, of ``docs`` with ``length`` terms in all."""
    m = (BASE - B_PART) + (B_PART * n * docs) // max(length, 1)
    return (1_000_000_000 * tf) // (1000 * tf + K1 * m)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Vectors:
    """Sparse rows: terms and impacts of document i at ptr[i]:ptr[i + 1]."""

    def __init__(self, ptr: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.ptr, self.term, self.value = ptr, term, value

    def take(self, rows: np.ndarray) -> Vectors:
        n = self.ptr[rows + 1] - self.ptr[rows]
        ptr = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.ptr[rows] - ptr[:-1], n) + np.arange(ptr[-1])
        return Vectors(ptr, self.term[at], self.value[at])

    def sums(self, values: np.ndarray, a: int = 0, b: int | None = None) -> np.ndarray:
        """Sum of ``values`` (one a stored term of rows a to b) by row."""
        ptr = self.ptr[a:(len(self.ptr) - 1 if b is None else b) + 1] - self.ptr[a]
        out = np.zeros(len(ptr) - 1, values.dtype)
        some = ptr[1:] > ptr[:-1]
        if some.any():
            out[some] = np.add.reduceat(values, ptr[:-1][some])
        return out

    def dot(self, dense: np.ndarray, a: int = 0, b: int | None = None) -> np.ndarray:
        x, y = self.ptr[a], self.ptr[len(self.ptr) - 1 if b is None else b]
        return self.sums(dense[self.term[x:y]] * self.value[x:y], a, b)


def split(x: Vectors, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """(direction, place of each row on it): the line from the row farthest from the mean to the row farthest from that."""
    square = x.sums(x.value.astype(np.float64) ** 2)
    mean = np.bincount(x.term, x.value, wide) / max(1, len(square))
    far = int(np.argmax(square - 2 * x.dot(mean)))

    def row(i: int) -> np.ndarray:
        out = np.zeros(wide)
        out[x.term[x.ptr[i]:x.ptr[i + 1]]] = x.value[x.ptr[i]:x.ptr[i + 1]]
        return out
    one = row(far)
    other = row(int(np.argmax(square - 2 * x.dot(one))))
    line = other - one
    return line, x.dot(line)


def fit_top(x: Vectors, wide: int, levels: int = TOP) -> dict[int, tuple[np.ndarray, float]]:
    """Splits of the top of the tree from sampled vectors: node (1 the root, 2i and 2i + 1 below i) -> (line, place that halves it)."""
    splits, rows = {}, {1: np.arange(len(x.ptr) - 1)}
    for node in range(1, 1 << levels):
        own = rows.pop(node, np.empty(0, np.int64))
        if len(own) < 2:
            continue
        line, place = split(x.take(own), wide)
        cut = float(np.median(place))
        right = place > cut
        if right.any():
            splits[node] = (line, cut)
            rows[2 * node], rows[2 * node + 1] = own[~right], own[right]
    return splits


def cells(x: Vectors, splits: dict) -> np.ndarray:
    """Cell of each row: the last node on its way down."""
    out = np.ones(len(x.ptr) - 1, np.int64)
    for node in sorted(splits):
        here = np.flatnonzero(out == node)
        if len(here):
            line, cut = splits[node]
            out[here] = 2 * node + (x.take(here).dot(line) > cut)
    return out


class Tree:
    """Ball tree over sparse rows; ``order`` are the rows as leaves have them."""

    def __init__(self, x: Vectors, wide: int, leaf: int = LEAF):
        count = len(x.ptr) - 1
        order, spans, below, todo = np.arange(count), [(0, count)], {}, [0]
        while todo:
            node = todo.pop()
            a, b = spans[node]
            if b - a <= leaf:
                continue
            own = order[a:b]
            _, place = split(x.take(own), wide)
            middle = (b - a) // 2
            order[a:b] = own[np.argpartition(place, middle)]
            below[node] = (len(spans), len(spans) + 1)
            todo += below[node]
            spans += [(a, a + middle), (a + middle, b)]
        self.order, self.spans, self.below = order, spans, below
        self.x = x = x.take(order)
        self.square = x.sums(x.value.astype(np.float64) ** 2)
        self.centroid = np.zeros((len(spans), wide), np.float32)
        self.radius = np.zeros(len(spans))
        for node, (a, b) in enumerate(spans):
            at = slice(x.ptr[a], x.ptr[b])
            self.centroid[node] = np.bincount(x.term[at], x.value[at], wide) / max(1, b - a)
            c = self.centroid[node].astype(np.float64)
            cross, own = x.dot(c, a, b), float(c @ c)
            far = self.square[a:b] - 2 * cross + own
            self.radius[node] = math.sqrt(max(0.0, float((far + SLACK * (self.square[a:b] + 2 * cross + own)).max(initial=0.0))))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the score of any row of each ball (rows) for each query (columns of doubles)."""
        out = np.empty((len(self.spans), queries.shape[1]))
        squares = queries ** 2
        for a in range(0, len(out), 256):
            c = self.centroid[a:a + 256].astype(np.float64)
            inside = np.sqrt((c > 0).astype(np.float64) @ squares)
            out[a:a + 256] = (c @ queries + inside * self.radius[a:a + 256, None]) * (1 + SLACK) + 1
        return out

    def search(self, query: np.ndarray, bound: np.ndarray, ids: np.ndarray, k: int, floor: int) -> tuple[list, int]:
        """The k best (score, id) of the rows with ``ids`` in leaf order, best first, all of ``floor`` (at least 1) or more; and leaves visited."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the last place first
        least, leaves = max(1, floor), 0
        todo = [(-bound[0], 0)]
        while todo:
            high, node = heapq.heappop(todo)
            if -high < least:
                break
            if node in self.below:
                for child in self.below[node]:
                    if bound[child] >= least:
                        heapq.heappush(todo, (max(high, -bound[child]), child))
                continue
            leaves += 1
            a, b = self.spans[node]
            score = self.x.dot(query, a, b)
            for i in np.flatnonzero(score >= least):
                entry = (int(score[i]), -int(ids[a + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                if len(best) == k:
                    least = max(least, best[0][0])
        return sorted(best, key=lambda e: (-e[0], -e[1])), leaves


def vectors(docs: DataFrame, vocabulary: dict[str, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, term, tf): of each document its number of terms and those of the vocabulary, in order."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            ns, term, tf = [], [], []
            for t in batch.column(1).to_pylist():
                own = terms(t)
                ns.append(len(own))
                found = Counter(map(get, own))
                found.pop(None, None)
                keys = sorted(found)
                term.append(keys)
                tf.append([found[i] for i in keys])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(ns, pa.int64()), pa.array(term, schema.field(2).type),
                                              pa.array(tf, schema.field(3).type)], schema=schema)

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(read, "doc_id long, n long, term array<int>, tf array<int>")


def _sparse(table, docs: int, length: int) -> Vectors:
    """Impacts of the rows of an Arrow table or batch (n, term, tf)."""
    def flat(name: str) -> np.ndarray:
        col = table.column(name)
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.array([len(t) for t in table.column("term")], np.int64)
    n = np.array(table.column("n").to_pylist(), np.int64)
    return Vectors(np.concatenate([[0], np.cumsum(sizes)]), flat("term"), impacts(flat("tf"), np.repeat(n, sizes), docs, length))


def block_ranked(docs: DataFrame, items: list, doc_id: str, text: str, k: int, name: str) -> DataFrame:
    """(number of the item, doc_id, score) of the k best documents of each item of a block."""
    asked = [Counter(terms(i)) for _, i in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    wide = len(vocabulary)
    rows = stored(vectors(docs, vocabulary, doc_id, text), name)
    found = rows.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    count, length = int(found[0]), int(found[1] or 0)
    rows = rows.where("size(term) > 0")
    df = dict(rows.select(F.explode("term").alias("t")).groupBy("t").count().collect())  # at most a row a term of the block
    queries = np.zeros((wide, len(items)), np.int64)
    for j, own in enumerate(asked):
        for t, times in own.items():
            queries[vocabulary[t], j] = times * weight(df.get(vocabulary[t], 0), count)
    hashed = rows.withColumn("h", F.xxhash64("doc_id", "n", "term", "tf"))
    total = hashed.agg(F.count("*")).first()[0]
    # a share of all hashes that holds about SAMPLE rows
    share = min(1.0, SAMPLE / max(total, 1))
    sample = hashed.where(F.col("h") <= F.lit(min(2**63 - 1, int(-2**63 + share * 2**64)))).select("n", "term", "tf").limit(2 * SAMPLE).toArrow()
    splits = fit_top(_sparse(sample, count, length), wide) if sample.num_rows else {}

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells(_sparse(part, count, length), splits), pa.int64())],
                                                 names=[*part.schema.names, "cell"])

    kind = "doc_id long, n long, term array<int>, tf array<int>"
    dealt = stored(rows.mapInArrow(descend, kind + ", cell long"), name + "_cells")
    sizes = dealt.groupBy("cell").agg(F.sum(F.size("term").cast("long"))).collect()  # a row a cell
    trees = {cell: max(1, -(-n // SUBTREE)) for cell, n in sizes}
    if not trees:
        return dealt.select(F.lit(0).alias("item"), "doc_id", F.lit(0).cast("long").alias("score")).limit(0)
    number = F.create_map(*[x for c, n in trees.items() for x in (F.lit(c), F.lit(n))])[F.col("cell")]
    spread = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), number)
    dealt = stored(dealt.withColumn("tree", spread), name + "_trees")

    def searched(part: DataFrame, floors: np.ndarray) -> DataFrame:
        def search(table: pa.Table) -> pa.Table:
            ids = table.column("doc_id").fill_null(NO_ID).combine_chunks().to_numpy(zero_copy_only=False)
            tree = Tree(_sparse(table, count, length), wide)
            ids, item, doc, score = ids[tree.order], [], [], []
            for a in range(0, len(items), 64):
                bound = tree.bounds(queries[:, a:a + 64].astype(np.float64))
                for j in range(bound.shape[1]):
                    best, _ = tree.search(queries[:, a + j], bound[:, j], ids, k, int(floors[a + j]))
                    item += [a + j] * len(best)
                    score += [s for s, _ in best]
                    doc += [None if -d == NO_ID else -d for _, d in best]
            return pa.table([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])
        return part.groupBy("cell", "tree").applyInArrow(search, "item int, doc_id long, score long")

    first = stored(searched(dealt.where("tree = 0"), np.zeros(len(items), np.int64)), name + "_first")
    if max(trees.values()) == 1:
        return first
    floors = np.zeros(len(items), np.int64)
    for item, score in best_of(first, k).where(F.col("rank") == k).select("item", "score").collect():  # at most a row an item
        floors[item] = score
    return first.unionByName(searched(dealt.where("tree > 0"), floors))


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item, with their rank."""
    places = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(places)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text")).distinct()
    asked = stored(asked.withColumn("size", F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))).where("size > 0"), "items")
    total = asked.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-int(total) // block_terms))
    out = None
    for b in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select("item_id", "text").collect()
        own = sorted(map(tuple, own), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if not own:
            continue
        found = best_of(block_ranked(docs, own, doc_id, text, k, f"vectors_{b}"), k)
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(own)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        part = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # the items of a block
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = asked.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out
