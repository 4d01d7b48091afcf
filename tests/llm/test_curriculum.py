"""Mixing: targets, cuts, epochs and positions against a plain version, and odd tables."""

import hashlib
import math
import re

from conftest import SF_SMALL

from zonekit.llm import curriculum

SCHEMA = "doc_id long, text string, source string"


def plain_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Reshare by weight until no source is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > most * sizes[s]}
        if not full:
            return out | {s: w[s] * level for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def odd_rows():
    rows = [(i, "w " * (i * 7 % 23 + 1), f"s{i % 5}" if i % 3 else "s0") for i in range(200)]
    return rows + [(300, None, "s1"), (301, "", None), (302, "a b c", None), (None, "x y", "s2"), (303, "only", "tiny"), (304, " \t\n", "blank"),
                   (305, "v " * 30_000, "big"), rows[5], rows[5], (306, "one", "\U0001F600"), (307, "one two", "￮")]


def test_targets_and_words(spark):
    rows = odd_rows()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = plain_targets(sizes)
    df = spark.createDataFrame(rows, SCHEMA)
    out = curriculum.taken(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.size) for r in out) == sorted((k is None, k or 0, t or "", words(t)) for k, t, _ in rows)
    got = {}
    for r in out:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        got[r.source] = got.get(r.source, 0) + r.taken
    assert all(want[s] - 1 <= n <= want[s] for s, n in got.items())
    again = curriculum.taken(df.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.size, r.taken, r.target)
    assert sorted(map(key, out), key=repr) == sorted(map(key, again), key=repr)


def test_mix_follows_the_schedules(spark):
    r = spark.createDataFrame([(i, "w " * 10, f"s{i % 3}") for i in range(900)], SCHEMA)
    out = curriculum.mix(r).collect()
    assert [x.position for x in out] == [sum(y.words for y in out[:i]) for i in range(len(out))]
    assert [x.time for x in out] == sorted(x.time for x in out)
    parts = {}
    for x in out:
        done = parts.setdefault(x.source, [])
        # integral of the schedule up to the time, against the words asked for before
        schedule = curriculum.CLASSES[int(x.source[1])][1]
        (_, a), (_, b) = schedule
        share = (a * x.time + (b - a) / 2 * x.time ** 2) / ((a + b) / 2)
        assert math.isclose(share, sum(done) / math.floor(x.target), abs_tol=1e-9)
        done.append(x.words)
    half = [x for x in out if x.time < 0.5]
    assert sum(x.source == "s0" for x in half) > 1.5 * sum(x.source == "s0" for x in out if x.time >= 0.5)
    assert sum(x.source == "s2" for x in half) < 0.7 * sum(x.source == "s2" for x in out if x.time >= 0.5)
    first = {}
    for x in out:  # a document's second turn comes after all first ones of its source
        first.setdefault((x.source, x.epoch), []).append(x.time)
    for s in ("s0", "s1", "s2"):
        if (s, 1) in first:
            assert max(first[s, 0]) <= min(first[s, 1])
    order = [x.doc_id for x in out if x.source == "s1" and x.epoch == 0]
    assert order == sorted(order, key=lambda k: hashlib.md5(str(k).encode()).hexdigest())


def test_schedules_of_several_pieces(spark):
    """Against bisection on the integral."""
    from pyspark.sql import functions as F
    for schedule in (((0.0, 0.0), (0.3, 2.0), (0.6, 2.0), (1.0, 0.5)), ((0.0, 1.0), (0.5, 0.0), (1.0, 3.0))):
        def integral(t):
            total = 0.0
            for (a, x), (b, y) in zip(schedule, schedule[1:]):
                u = min(max(t, a), b) - a
                total += x * u + (y - x) / (b - a) / 2 * u * u
            return total
        got = spark.range(101).select((F.col("id") / 100).alias("u")).withColumn("t", curriculum.asked(schedule, F.col("u"))).collect()
        for r in got:
            assert 0 <= r.t <= 1 and math.isclose(integral(r.t), r.u * integral(1.0), abs_tol=1e-9)


def test_empty_and_clashing(spark):
    assert curriculum.taken(spark.createDataFrame([], SCHEMA)).count() == 0
    assert curriculum.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = spark.createDataFrame([(1, "", "a"), (2, None, None)], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in curriculum.taken(nothing).collect()] == [(0, 0.0, 0)] * 2
    clash = spark.createDataFrame([(i, "a b", "s", 9, 9, 9, 9) for i in range(4)],
                                  SCHEMA + ", _row int, size int, class int, rows int")
    out = curriculum.taken(clash)
    assert out.columns == ["doc_id", "text", "source", "_row", "class", "rows", "size", "source_size", "target", "taken"]
    assert {(r._row, r["class"], r["rows"], r.size) for r in out.collect()} == {(9, 9, 9, 2)}
    assert "position" in curriculum.mix(clash).columns and curriculum.mix(clash).count() > 0


def test_registered(spark):
    import oracle_check

    import __spark_entry__ as entry
    done = oracle_check.compare(spark, "op11_mixing", entry.queries()["op11_mixing"], entry.oracle_sql()["op11_mixing"], SF_SMALL, oracle_check.duck_conn(SF_SMALL))
    assert done["ok"], done
