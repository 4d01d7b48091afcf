"""Ranked lexical search against scoring every document, bounds against scores, and odd tables."""

import collections
import math
import random
import re

import numpy as np
from conftest import SF_SMALL

from zonekit.llm import lexical_search as ls

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k=20):
    """{(item_id, text): [(doc_id, score), ...]} by scoring all."""
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    count, length = len(bags), sum(n for _, _, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = {}
    for item, text in set(items):
        found = []
        for d, b, n in bags:
            m = 100 - 25 + (25 * n * count) // length
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out[item, text] = [(None if none else d, -s) for s, none, d in sorted(found)[:k]]
    return {key: rows for key, rows in out.items() if rows}


def table(df):
    rows = collections.defaultdict(list)
    for r in df.collect():
        rows[r.item_id].append((r["rank"], r.doc_id, r.score))
    return {k: sorted(v) for k, v in rows.items()}


def numbered(want):
    return {item: [(i + 1, d, s) for i, (d, s) in enumerate(rows)] for (item, _), rows in want.items()}


def sample_docs(seed=3, n=700):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé7") for _ in range(r.randint(1, 3))) for _ in range(300)]
    docs = [(i, " ".join(r.choice(words[(i % 3) * 100:(i % 3) * 100 + 120]).title() for _ in range(r.choice([1, 5, 40, 200])))) for i in range(n)]
    docs += [(10_000 + i, docs[7][1]) for i in range(60)]  # ties over a whole last place
    docs += [(20_000, None), (20_001, ""), (20_002, "-- !"), (None, docs[7][1]), docs[9], docs[9], (20_003, "x " * 50_000 + words[5])]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 3, 30])))) for i in range(25)]
    return docs, items + [(100, docs[7][1]), (101, None), (102, ""), (103, "nowhere"), items[3], (104, (words[5] + " ") * 400), (None, words[9])]


def test_against_all_scores(spark, monkeypatch):
    docs, items = sample_docs()
    want = numbered(plain(docs, items))
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert table(ls.ranked(d, i)) == want
    monkeypatch.setattr(ls, "SUBTREE", 3000)  # several subtrees a cell
    monkeypatch.setattr(ls, "SAMPLE", 100)
    assert table(ls.ranked(d.repartition(5), i, block_terms=500)) == want  # and several blocks


def test_one_id_with_several_texts(spark):
    docs, _ = sample_docs(n=40)
    d = spark.createDataFrame(docs, DOCS)
    both = [(1, docs[3][1]), (1, docs[4][1])]
    want = plain(docs, both)
    got = sorted((r["rank"], r.doc_id, r.score) for r in ls.ranked(d, spark.createDataFrame(both, ITEMS)).collect())
    assert got == sorted((i + 1, doc, s) for rows in want.values() for i, (doc, s) in enumerate(rows))


def sparse(r, n, wide, most):
    rows = [np.sort(r.choice(wide, r.integers(1, most), replace=False)) for _ in range(n)]
    return ls.Vectors(np.cumsum([0, *map(len, rows)]), np.concatenate(rows), r.integers(1, 900_000, sum(map(len, rows))))


def test_bounds_hold_and_prune():
    """No row of a ball scores more than its bound; clustered rows leave most balls unvisited."""
    r = np.random.default_rng(1)
    x = sparse(r, 600, 80, 30)
    tree = ls.Tree(x, 80, leaf=5)
    queries = r.integers(0, 12_000, (80, 9)) * (r.random((80, 9)) < 0.2)
    bounds = tree.bounds(queries.astype(float))
    for j in range(9):
        scores = tree.x.dot(queries[:, j])
        for node, (a, b) in enumerate(tree.spans):
            assert scores[a:b].max() <= bounds[node, j]
        best, _ = tree.search(queries[:, j], bounds[:, j], tree.order, 20, 0)
        want = sorted(((int(s), -int(d)) for s, d in zip(scores, tree.order) if s > 0), reverse=True)[:20]
        assert best == want
        cut, _ = tree.search(queries[:, j], bounds[:, j], tree.order, 20, want[9][0])
        assert cut[:10] == want[:10]
    kinds = [np.arange(10) + 10 * i for i in range(8)]
    rows = [np.sort(r.choice(kinds[i % 8], 6, replace=False)) for i in range(2000)]
    x = ls.Vectors(np.arange(0, 12_001, 6), np.concatenate(rows), r.integers(400_000, 420_000, 12_000))
    tree = ls.Tree(x, 80)
    q = np.zeros(80, np.int64)
    q[kinds[2][:5]] = 5000
    best, leaves = tree.search(q, tree.bounds(q[:, None].astype(float))[:, 0], tree.order, 20, 0)
    assert len(best) == 20 and leaves < len(tree.spans) / 4


def test_largest_values():
    """A score near 2^62 keeps its last digit; bounds stay above it."""
    x = ls.Vectors(np.array([0, 2, 4]), np.array([0, 1, 0, 1]), np.array([999_999, 999_998, 999_999, 999_999]))
    q = np.array([2**41, 2**41 + 1])
    tree = ls.Tree(x, 2, leaf=1)
    best, _ = tree.search(q, tree.bounds(q[:, None].astype(float))[:, 0], tree.order, 1, 0)
    assert best == [(999_999 * (2**42 + 1), -1)]


def test_empty_and_clashing(spark):
    docs, items = sample_docs(n=20)
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert ls.ranked(d.limit(0), i).count() == 0 and ls.ranked(d, i.limit(0)).count() == 0
    clash = d.selectExpr("*", "1 as n", "2 as term", "3 as cell", "4 as item_id"), i.selectExpr("*", "1 as size", "2 as doc_id")
    assert table(ls.ranked(*clash)) == numbered(plain(docs, items))


def test_registered(spark):
    import __spark_entry__ as entry
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert table(entry.queries()["op13_search"](spark, SF_SMALL)) == numbered(plain(docs, items))


def test_oracle(spark):
    import oracle_check

    import __spark_entry__ as entry
    done = oracle_check.compare(spark, "op13_search", entry.queries()["op13_search"], entry.oracle_sql()["op13_search"], SF_SMALL, oracle_check.duck_conn(SF_SMALL))
    assert done["ok"], done
