"""Prefix trie against a plain version, over many ranges, and on odd tables."""

import collections
import hashlib
import random
import zlib

from conftest import SF_SMALL

from zonekit.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(rows):
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(ts)] for c, ts in convs.items()}


def plain(convs):
    """Sorted rows of all nodes of {conv_id: [(role, text), ...]}."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    least = {p: min((c for c in cs if c is not None), default=None) for p, cs in members.items()}
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, cs in members.items():
        cost = (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += cost
            leaves[p[:d]] += not children[p]
    known = lambda p: ",".join(str(c) for c in sorted(c for c in ends[p] if c is not None))
    return sorted(((least[p], len(p), least[p[:-1]] if p else None, len(cs), children[p], leaves[p], saved[p],
                    hashlib.sha256(known(p).encode()).hexdigest()) for p, cs in members.items()), key=repr)


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9 if c is not None else 0
        out[c] = (convs.get(c - c % 5, [])[:h] if c is not None else []) + own[h:]
    return out


def table(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def branching(seed, n=400):
    r = random.Random(seed)
    rows, base = [], [("user", "hello"), ("assistant", "hi é there")]
    for c in range(n):
        ts = list(base[:r.randint(0, 2)]) + [(r.choice("ua"), r.choice(["x", "yy", "zzz", ""])) for _ in range(r.choice([0, 1, 2, 5, 9]))]
        rows += [(c * 3, i, *t) for i, t in enumerate(ts)]
    return rows


ODD = [(1, None, None, None), (1, None, "user", "b"), (1, 0, "user", None), (2, 5, "user", "b"), (2, 5, "user", "b"), (None, 0, "user", "b"),
       (None, 1, None, "c"), (10, 0, "a", "x" * 100_000), (11, 0, "a", "x" * 100_000), (-7, 0, "user", "b"), (3, 0, "ab", "c"), (4, 0, "a", "bc")]


def test_trie(spark):
    for rows in (ODD, branching(1), [(i, j, "user", f"turn {j}") for i in (7, 8, 9) for j in range(300)]):
        got = prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA)))
        assert table(got) == plain(turns_of(rows))


def test_rebuilt(spark):
    rows = [(k, *x) for k, *x in ODD if k is None or k >= 0] + [(500 + k, *x) for k, *x in branching(2)]
    got = prefix_trie.trie(queries.rebuilt(prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA))))
    assert table(got) == plain(rebuilt(turns_of(rows)))


def test_peeling_of_any_ranges():
    """Ranges of any sizes, peeled apart and put together, give the nodes of one range."""
    r = random.Random(4)
    paths = {b""} if r.random() < 0.5 else set()
    while len(paths) < 60:
        paths.add(b"".join(bytes([r.randint(0, 1)]) * 16 for _ in range(r.randint(0, 7))))
    rows = [(p, [r.randint(0, 9) for _ in range(len(p) // 16)], r.randint(1, 4), r.randint(0, 99), bytes([i])) for i, p in enumerate(sorted(paths))]
    lengths = {}
    rows = [(p, [lengths.setdefault(p[:16 * (i + 1)], n) for i, n in enumerate(ns)], *x) for p, ns, *x in rows]

    def together(cuts):
        out = {}
        for a, b in zip(cuts, cuts[1:]):
            for name, up, depth, convs, least, children, leaves, saved, ends in prefix_trie.peel(rows[a:b], rows[a - 1][0] if a else None):
                now = out.setdefault(name, [up, depth, 0, least, 0, 0, 0, None])
                now[2] += convs
                now[3] = min(now[3], least)
                now[4] += children
                now[5] += leaves
                now[6] += saved
                now[7] = now[7] or ends
        return out
    whole = together([0, 60])
    for _ in range(40):
        cuts = sorted({0, 60, *r.sample(range(1, 60), r.randint(1, 59))})
        assert together(cuts) == whole


def test_many_ids_end_at_one_node(spark):
    """More ids than a block holds, over several partitions."""
    n = 3 * prefix_trie.BLOCK_IDS + 5
    seqs = spark.range(n).selectExpr("id as conv_id", "unhex('00') as seq").union(spark.createDataFrame([(5, b"\1")], "a long, b binary"))
    got = {bytes(r.seq): r.ends_sha256 for r in prefix_trie.ends_hashed(seqs, 4).collect()}
    assert got == {b"\0": hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest(), b"\1": hashlib.sha256(b"5").hexdigest()}


def test_empty_and_clashing(spark):
    assert prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame([], SCHEMA))).count() == 0
    clash = spark.createDataFrame([(1, 0, "u", "t", 5, "p")], SCHEMA + ", part int, node string")
    assert table(prefix_trie.trie(prefix_trie.sequences(clash))) == plain({1: [("u", "t")]})


def test_registered(spark):
    import oracle_check

    import __spark_entry__ as entry
    done = oracle_check.compare(spark, "op12_prefix_trie", entry.queries()["op12_prefix_trie"], entry.oracle_sql()["op12_prefix_trie"], SF_SMALL,
                                oracle_check.duck_conn(SF_SMALL))
    assert done["ok"], done
