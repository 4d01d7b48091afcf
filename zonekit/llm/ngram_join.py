"""7. Similarity join on word n-grams: MinHash banding, verified on the full n-gram sets.

1. Texts of one n-gram set are a class; only classes go on, so copies are never compared with each other.
2. Band and row counts follow from the threshold and the recall that banding must reach at it (``banding``). Classes
   are shuffled on band hashes; those that share one are candidates, and candidates that hang together a block.
3. A block of up to ``BLOCK`` classes and ``BLOCK_GRAMS`` n-grams meets in one task, which compares the full n-gram sets of all its pairs (also of
   those that share no band). A larger one is split by set size, of which similar sets can't differ by more than the
   threshold, and by hash; only parts of equal or neighbouring sizes meet, so no task gets more than two parts.
   Tasks return counts of links and a spanning forest, never the pairs, and nothing is left out.

``linked`` returns every row with class_id (the least id of all documents that links join, copies included), text_class
(the least id with an equal n-gram set), copies (rows of that class) and n_links (other classes of similarity
``threshold`` or more). Texts of fewer than n words have one n-gram, all their words. Null text counts as empty; a text
without words is similar to nothing and alone in its class. Documents without an id stand after all others in a
class; a class of them alone has a null id. Repeated rows are copies. An empty table stays empty. Result columns replace
columns of their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, groups, lookup, packed, stored

#: Words of an n-gram, similarity of a link, share of such pairs that banding finds at the threshold itself.
WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Hash functions of a signature at most; more rows a band make fewer false candidates.
MOST_HASHES = 256
#: Classes, and n-grams of them, that one task compares (of each of two parts); a longer text is a part by itself.
BLOCK, BLOCK_GRAMS = 800, 2_000_000
#: Words whose hashes a worker keeps; cells of a matrix; both bound memory only.
CACHE_WORDS, CELLS = 400_000, 8 << 20

_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
_ODD = np.random.default_rng(20).integers(1, 2**63, (16,), np.uint64) | np.uint64(1)


def banding(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band with which ``most`` hash functions reach the recall at the threshold."""
    best = (1, 1)
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = _Hashes()


def ngrams(text: str, n: int = WORDS) -> np.ndarray:
    """The set of word n-grams as sorted 64-bit hashes."""
    words = _WORDS(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(_HASHES.__getitem__, words)), np.uint64)
    if len(h) < n:
        n = len(h)
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total = mix(total + h[i:len(h) - n + 1 + i] * _ODD[i % 16])
    return np.unique(total)


def signature(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash a band."""
    r = np.random.default_rng(7)
    a = r.integers(1, 2**32, bands * rows, np.uint32) | np.uint32(1)
    b = r.integers(0, 2**32, bands * rows, np.uint32)
    low = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(bands * rows, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), 8192):
        np.minimum(least, (a[:, None] * low[None, at:at + 8192] + b[:, None]).min(1), out=least)
    parts = least.reshape(bands, rows).astype(np.uint64)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        out = mix(out * _ODD[0] + parts[:, i])
    return out.view(np.int64)


def signed(df: DataFrame, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """``df`` with _row (a number of its own), _c (name of its n-gram set), _n (its size) and _bands."""
    kind = pa.struct([("c", pa.binary()), ("n", pa.int32()), ("bands", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<c binary, n int, bands array<bigint>>")
    def sign(column: pa.Array) -> pa.Array:
        names, sizes, all_bands = [], [], []
        with np.errstate(over="ignore"):
            for t in column.to_pylist():
                g = ngrams(t or "", n)
                name = np.array([mix(g).sum(), mix(g ^ _ODD[1]).sum()], np.uint64)
                names.append(name.tobytes() if len(g) else None)
                sizes.append(len(g))
                all_bands.append(signature(g, bands, rows) if len(g) else np.empty(0, np.int64))
        ends = np.cumsum([0, *map(len, all_bands)]).astype(np.int32)
        flat = np.concatenate(all_bands) if all_bands else np.empty(0, np.int64)
        return pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(sizes, pa.int32()),
                                           pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], fields=list(kind))

    out = df.withColumn("_s", sign(F.col(text).cast("string"))).withColumn("_row", F.monotonically_increasing_id())
    return out.select(*df.columns, "_row", F.col("_s.c").alias("_c"), F.col("_s.n").alias("_n"),
                      F.col("_s.bands").alias("_bands"))


def links(sets: list[np.ndarray], first: int, threshold: float) -> np.ndarray:
    """Boolean matrix of the links; with ``first`` > 0 only those between the first so many sets and the others."""
    m = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, m)
    owner = np.repeat(np.arange(m), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count[code] > 1
    owner, code = owner[common], (np.cumsum(count > 1) - 1)[code[common]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    total = int(code[-1]) + 1 if len(code) else 0
    shared = np.zeros((m, m), np.float32)
    step = max(1, CELLS // m)
    for at in range(0, total, step):
        a, b = np.searchsorted(code, [at, at + step])
        has = np.zeros((m, min(step, total - at)), np.float32)
        has[owner[a:b], code[a:b] - at] = 1
        shared += has @ has.T
    union = sizes[:, None] + sizes[None, :] - shared
    out = shared >= threshold * union - 1e-6
    np.fill_diagonal(out, False)
    if first:
        out[:first, :first] = False
        out[first:, first:] = False
    return out


def roots(linked: np.ndarray) -> np.ndarray:
    """The least index that links lead to, for each index."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compared(candidates: DataFrame, n: int, threshold: float) -> DataFrame:
    """(_c, links, root) of every class of each pair of parts: ``candidates`` has (task, side, _c, text)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in groups(batches, 1):
            part = key[0].rpartition("/")[2].split(",")
            first = sum(r[1] == 0 for r in rows) if part[:2] != part[2:] and len(part) == 4 else None  # None: one part with itself
            if first in (0, len(rows)):  # the other part is empty
                continue
            sets = [ngrams(r[3] or "", n) for r in rows]
            found = links(sets, first or 0, threshold)
            names = [r[2] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(found.sum(1), pa.int64()),
                 pa.array([names[i] for i in roots(found)], pa.binary())], names=["_c", "links", "root"])

    rows = candidates.select("task", "side", "_c", "text").repartition("task").sortWithinPartitions("task", "side", "_c")
    return rows.mapInArrow(compare, "_c binary, links long, root binary")


MADE = ["class_id", "text_class", "copies", "n_links", "is_first"]


def linked(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD,
           recall: float = RECALL, keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with class_id, text_class, copies, n_links, and ``is_first``: whether the row is
    the one of its class_id that stays when one is to."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in MADE]
    out = classed(df, doc_id, text, n, threshold, recall, keep)
    return out.select(*[F.col("_text").alias(c) if c == text else F.col("_own").getField(c).alias(c) for c in keep], *MADE)


def classed(df: DataFrame, doc_id: str, text: str, n: int, threshold: float, recall: float, keep: list[str]) -> DataFrame:
    """(_own, _text, *MADE): _own has the columns ``keep`` but for the text."""
    bands, rows = banding(threshold, recall)
    whole = text in keep
    df = df.select(packed([c for c in keep if c != text]).alias("_own"), F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    doc_id, text = "_id", "_text"
    base = stored(signed(df, text, n, bands, rows), "signed")
    # a row without words is a class of its own
    named = base.withColumn("_c", F.coalesce("_c", F.encode(F.concat(F.lit("row "), "_row"), "UTF-8")))
    order = F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("id"), F.col("_row").alias("row"))
    classes = stored(named.groupBy("_c").agg(F.min(order).alias("first"), F.count("*").alias("copies"),
                                             F.first("_n").alias("_n"), F.first("_bands").alias("_bands")), "classes")
    member = classes.select("_c", F.explode("_bands").alias("band"))
    buckets = stored(member.groupBy("band").agg(F.min("_c").alias("low"), F.count("*").alias("members")).where("members > 1"), "buckets")
    n_classes = classes.count()
    met = lookup(member, buckets, ["band"], "members", n_classes * bands).where("low is not null and low <> _c")
    blocks = stored(components(met.select(F.col("_c").alias("u"), F.col("low").alias("v"))), "blocks")
    # parts of a block: by size (neighbours only can be similar), then by hash into as many as needed
    size = F.floor(F.log("_n") / math.log(1 / threshold)).cast("int")
    inner = stored(blocks.join(classes, F.col("node") == F.col("_c")).select("root", "_c", "first", "_n", size.alias("size")), "inner")
    grams = F.sum(F.col("_n").cast("long"))
    totals = inner.groupBy("root").agg((F.greatest(F.count("*") / BLOCK, grams / BLOCK_GRAMS) <= 1).alias("whole"))
    counts = inner.groupBy("root", "size").agg(F.count("*").alias("here"), F.ceil(F.greatest(F.count("*") / BLOCK, grams / BLOCK_GRAMS)).cast("int").alias("parts"))
    parts = counts.join(totals, "root")
    up = parts.select("root", (F.col("size") - 1).alias("size"), F.col("parts").alias("up"))
    down = parts.select("root", (F.col("size") + 1).alias("size"), F.col("parts").alias("down"))
    plan = stored(parts.join(up, ["root", "size"], "left").join(down, ["root", "size"], "left")
                  .select("root", "size", "whole", "here", "parts", F.coalesce("up", F.lit(0)).alias("up"), F.coalesce("down", F.lit(0)).alias("down")), "parts")
    placed = lookup(inner, plan, ["root", "size"], "here", inner.count())
    placed = placed.withColumn("h", F.expr("cast(pmod(xxhash64(_c), parts) as int)"))
    task = F.expr("""case when whole then array(struct('' as task, 0 as side)) else concat(
        transform(sequence(0, parts - 1), i -> struct(concat_ws(',', size, least(h, i), size, greatest(h, i)) as task, if(h > i, 1, 0) as side)),
        if(up > 0, transform(sequence(0, up - 1), i -> struct(concat_ws(',', size, h, size + 1, i) as task, 0 as side)), array()),
        if(down > 0, transform(sequence(0, down - 1), i -> struct(concat_ws(',', size - 1, i, size, h) as task, 1 as side)), array())) end""")
    tasks = placed.select("root", "_c", F.col("first.row").alias("_row"), F.explode(task).alias("t"))
    tasks = tasks.select(F.concat_ws("/", F.hex("root"), "t.task").alias("task"), F.col("t.side").alias("side"), "_c", "_row")
    texts = base.select("_row", F.col(text).alias("text"))
    found = stored(compared(texts.join(tasks, "_row"), n, threshold).where("links > 0"), "links")
    per_class = found.groupBy("_c").agg(F.sum("links").alias("n_links"))
    joined = components(found.select(F.col("_c").alias("u"), F.col("root").alias("v")))
    top = classes.drop("_bands").join(joined, F.col("_c") == F.col("node"), "left").withColumn("root", F.coalesce("root", "_c"))
    top = top.join(per_class, "_c", "left")
    firsts = top.groupBy("root").agg(F.min("first").alias("lead"))
    result = stored(top.join(firsts, "root").select(
        "_c", "copies", F.col("lead.id").alias("class_id"), F.col("first.id").alias("text_class"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("lead.row").alias("lead_row")), "text_classes")
    own = ["_own", "_text"] if whole else ["_own"]
    out = lookup(named.select(*own, "_row", "_c"), result, ["_c"], "copies", base.count())
    return out.select("_own", F.col("_text") if whole else F.lit(None).alias("_text"), "class_id", "text_class", "copies", "n_links",
                      (F.col("_row") == F.col("lead_row")).alias("is_first"))


def deduplicated(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD,
                 recall: float = RECALL) -> DataFrame:
    """One row of each class_id: the one with the least id. All columns stay as they are."""
    out = classed(df, doc_id, text, n, threshold, recall, df.columns).where("is_first")
    return out.select(*[F.col("_text").alias(c) if c == text else F.col("_own").getField(c).alias(c) for c in df.columns])
