"""1. BPE encoding and decoding by a segment tree over the ranks of adjacent pairs.

A leaf holds ``rank * leaves + position`` of the pair that starts there, an inner node the smaller of its two
children, so the root is the leftmost pair of lowest rank. A merge changes at most three leaves; each is carried
up in as many steps as the tree has levels. It ends when the root holds no rank.

Pieces of up to 64 symbols are merged many at a time (one tree a row of a numpy matrix), longer ones one by one
with the same tree in a list: a piece of a million letters takes n log n steps.

``encode`` adds the ids of a text column (binary, little-endian unsigned 32-bit integers), ``decode`` turns such a
column into text as the tokenizer file's decoder does. Null text counts as empty and has no ids; null ids decode to
the empty text. Rows, their order, repeated rows and all other columns stay as they are; an empty table stays empty.
A result column replaces a column of its name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import ChunkEncoder, Pieces, byte_chars, in_passes

#: Symbols of the longest piece that has its tree in a matrix row, and cells of a matrix (about a CPU's cache).
LONGEST_ROW, ROW_CELLS = 64, 1 << 16
_NONE = np.iinfo(np.int32).max


class Merges:
    """Ranks and results of the merges of a tokenizer file."""

    def __init__(self, pieces: Pieces):
        model = pieces.spec["model"]
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        #: prefix of continuing symbols is unused in both files; a merged token is its parts joined
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        code = left << 32 | right
        order = np.argsort(code, kind="stable")
        self.codes, self.ranks = code[order], order.astype(np.int64)
        self.by_code = dict(zip(code.tolist(), range(len(pairs))))
        chars = byte_chars()
        self.first = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + pieces.suffix] for c in chars], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it doesn't merge."""
        code = a << 32 | b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], _NONE)


def merge_one(symbols: list[int], merges: Merges) -> list[int]:
    """One segment tree in a list; for long pieces."""
    n = len(symbols)
    size = 1 << max(0, (n - 1).bit_length())
    none = len(merges.result) * size + size
    by_code, result = merges.by_code, merges.result

    def leaf(i: int, j: int) -> int:
        r = by_code.get(symbols[i] << 32 | symbols[j])
        return none if r is None else r * size + i

    tree = [none] * (2 * size)
    tree[size:size + n - 1] = [leaf(i, i + 1) for i in range(n - 1)]
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]

    def put(i: int, value: int) -> None:
        i += size
        tree[i] = value
        i >>= 1
        while i:
            low = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == low:
                return
            tree[i] = low
            i >>= 1

    while (root := tree[1]) < none:
        rank, i = divmod(root, size)
        j = after[i]
        k = after[j]
        symbols[i], symbols[j], after[i] = int(result[rank]), -1, k
        put(j, none)
        put(i, leaf(i, k) if k < n else none)
        if k < n:
            before[k] = i
        if (h := before[i]) >= 0:
            put(h, leaf(h, i))
    return [s for s in symbols if s >= 0]


def merge_many(sym: np.ndarray, lengths: np.ndarray, merges: Merges) -> np.ndarray:
    """Segment trees side by side: a word a row of ``sym``, its columns (a power of two and a spare one) the symbols.

    Returns the matrix after all merges, -1 where no symbol is left.
    """
    m, wide = sym.shape
    size = wide - 1
    cols = np.arange(wide, dtype=np.int32)
    after = np.tile(cols + 1, (m, 1))
    after[cols[None, :] >= lengths[:, None] - 1] = size  # past the last symbol: the spare column
    before = np.tile(cols - 1, (m, 1))
    rank = merges.rank(sym[:, :size].ravel(), sym[:, 1:].ravel()).reshape(m, size)
    tree = np.full((m, 2 * size), _NONE, np.int32)
    tree[:, size:] = np.where(rank == _NONE, _NONE, rank * size + cols[None, :size])
    level = size
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2
    flat, after, before, tree = sym.ravel(), after.ravel(), before.ravel(), tree.ravel()
    rows = np.arange(m)

    def put(base: np.ndarray, pos: np.ndarray, value) -> None:
        at = pos + size
        tree[base + at] = value
        for _ in range(size.bit_length() - 1):
            at = at >> 1
            two = base + 2 * at
            tree[base + at] = np.minimum(tree[two], tree[two + 1])

    while True:
        root = tree[rows * (2 * size) + 1]
        some = root != _NONE
        rows, root = rows[some], root[some]
        if not len(rows):
            return sym
        at, i = root // size, root % size
        base, top = rows * wide, rows * (2 * size)
        j = after[base + i]
        k = after[base + j]
        new = merges.result[at]
        flat[base + i] = new
        flat[base + j] = -1
        after[base + i] = k
        before[base + k] = i
        put(top, j, _NONE)
        r = merges.rank(new, flat[base + k])
        put(top, i, np.where((k < size) & (r != _NONE), r * size + i, _NONE))
        h = before[base + i]
        has = np.flatnonzero(h >= 0)
        if len(has):
            h = h[has]
            r = merges.rank(flat[base[has] + h], new[has])
            put(top[has], h, np.where(r != _NONE, r * size + h, _NONE))


def solver(merges: Merges):
    """Ids of pieces for :class:`pieces.ChunkEncoder`."""

    def solve(wanted: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(wanted), np.uint8)
        lengths = np.fromiter(map(len, wanted), np.int64, len(wanted))
        ends = np.cumsum(lengths)
        symbols = merges.first[data]
        symbols[ends - 1] = merges.last[data[ends - 1]]
        starts, counts, parts = ends - lengths, np.ones(len(wanted), np.int64), []
        group = np.where(lengths == 1, 0, np.where(lengths > LONGEST_ROW, LONGEST_ROW + 1, 0))
        size = 2
        while size <= LONGEST_ROW:
            group[(lengths > size // 2) & (lengths <= size) & (lengths > 1)] = size
            size *= 2
        for size in np.unique(group):
            members = np.flatnonzero(group == size)
            if size == 0:
                parts.append((members, symbols[starts[members]], counts[members]))
            elif size > LONGEST_ROW:
                for x in members:
                    ids = merge_one(symbols[starts[x]:ends[x]].tolist(), merges)
                    parts.append((members[members == x], np.array(ids, np.int64), np.array([len(ids)])))
            else:
                step = max(1, ROW_CELLS // int(size))
                for at in range(0, len(members), step):
                    x = members[at:at + step]
                    cells = np.arange(size + 1)
                    full = cells[None, :] < lengths[x][:, None]
                    sym = np.full((len(x), size + 1), -1, np.int64)
                    sym[full] = symbols[(starts[x][:, None] + cells[None, :])[full]]
                    sym = merge_many(sym, lengths[x], merges)
                    left = sym >= 0
                    parts.append((x, sym[left], left.sum(1)))
        for x, _, n in parts:
            counts[x] = n
        first = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int64)
        for x, ids, n in parts:
            flat[np.repeat(first[x] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return flat, counts

    return solve


class Codec:
    """Encoding and decoding by a tokenizer file."""

    def __init__(self, path: str):
        pieces = Pieces(path)
        self.encode_all = ChunkEncoder(pieces, solver(Merges(pieces))).encode_all
        names = {i: t for t, i in pieces.spec["model"]["vocab"].items()} | {i: t for t, i in pieces.added.items()}
        self.joins = pieces.spec["decoder"] is None  # no decoder: tokens joined by spaces
        if self.joins:
            self.names = names
        else:
            self.names = {i: t.encode() if i in pieces.added.values() else bytes(map(pieces.byte_of.__getitem__, t))
                          for i, t in names.items()}

    def decode(self, ids: bytes) -> str:
        tokens = (self.names[i] for i in np.frombuffer(ids, "<u4").tolist() if i in self.names)
        return " ".join(tokens) if self.joins else b"".join(tokens).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec (and cache) a Python worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(df: DataFrame, path: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with column ``to``: ids of ``text`` by the tokenizer file at ``path``, packed as binary."""

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        values = [t or "" for t in texts.to_pylist()]
        encode_all, out = codec(path).encode_all, []
        for part in in_passes(values):
            out += encode_all(values[part])
        return pa.array(out, pa.binary())

    return df.withColumn(to, ids(F.col(text).cast("string")))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with column ``to``: the text of the packed ids, special tokens included."""

    @F.arrow_udf("string")
    def texts(packed: pa.Array) -> pa.Array:
        plain = codec(path).decode
        return pa.array([plain(b or b"") for b in packed.to_pylist()], pa.string())

    return df.withColumn(to, texts(F.col(ids)))
