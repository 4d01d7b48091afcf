"""Corpus operators against plain versions, and on odd tables: nulls, empty and long texts, repeated rows, no rows, clashing columns."""

import collections
import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from zonekit.llm import (bpe, common, fingerprints, licenses, ngram_join, packing, pieces, pii, quality, suffix_dedup,  # noqa: E402
                         token_files, warc)

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def odd_texts():
    r = random.Random(5)
    base = sentence(r, 80)
    return ["", None, "x", "a  b\n\nc", "é" * 30, base, base, base + " and more", base.replace("a", "b", 3), "Σ ΑΣ İ́ <|endoftext|> end",
            "w" * 30_000, sentence(r, 4000), "\x00 \x1c\t\r\n", "of the " * 40, "mail a.b@c.example.org or 10.0.0.1, +49 (30) 1234-5678"]


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with every kind of null, two of them equal."""
    rows = [(i, t, ["en", None][i % 2], ["s", "t", None][i % 3], 1) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows + [rows[5], (None, None, None, None, None), (None, rows[5][1], None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_every_merged_token_merges_back(path):
    """What WholeTexts rests on; also a test of the segment tree on 48,894 or 50,000 words."""
    p = pieces.Pieces(path)
    m = bpe.Merges(p)
    vocab = p.spec["model"]["vocab"]
    for pair in p.spec["model"]["merges"]:
        name = "".join(pair.split(" ") if isinstance(pair, str) else pair)
        end = bool(p.suffix) and name.endswith(p.suffix)
        data = [p.byte_of[c] for c in (name.removesuffix(p.suffix) if end else name)]
        symbols = [int(m.first[b]) for b in data]
        if end:
            symbols[-1] = int(m.last[data[-1]])
        assert bpe.merge_one(symbols, m) == [vocab[name]]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_equal_the_library(path):
    r = random.Random(2)
    texts = [t or "" for t in odd_texts()]
    texts += ["".join(r.choice("ab'é \n\t.1<Σ́　A$中") for _ in range(r.randint(1, 60))) for _ in range(1500)]
    texts += ["a" + chr(c) + "b1" + chr(c) * 2 + " x\n" + chr(c) for c in [*range(0x400), 0x2028, 0x3000, 0x1F600]]
    t = library(path)
    want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    codec = bpe.Codec(path)
    assert codec.encode_all(texts) == want
    assert pieces.WholeTexts(path).encode_all(texts) == want
    assert [codec.decode(x) for x in want] == [t.decode(np.frombuffer(x, "<u4").tolist(), skip_special_tokens=False) for x in want]


def test_bpe_columns(odd, none):
    out = bpe.decode(bpe.encode(odd.withColumn("ids", odd.doc_id), WORD), WORD).collect()
    t = library(WORD)
    assert len(out) == odd.count()
    for r in out:
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes()
        assert r.decoded == t.decode(ids, skip_special_tokens=False)
    assert bpe.encode(none, WORD).collect() == []


def test_packing(odd, none):
    cut = packing.pieces(odd, BYTE, 2, 64)
    out = packing.pack(cut.withColumn("offset", cut.start), 64).collect()
    t = library(BYTE)
    want = collections.Counter((r.doc_id, tuple([*t.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in odd.collect())
    found, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        found[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for (k, ids), n in want.items():
        if n == 1 and k is not None:
            own = sorted(found[k], key=lambda r: r.piece)
            assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
            assert all(r.length == 64 for r in own[1:])
    assert sum(r.length for r in out) == sum(len(ids) * n for (_, ids), n in want.items())
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.pieces(none, BYTE, 2, 64), 64).collect() == []


def test_sum_of_squares_is_the_least_at_each_step():
    r = np.random.default_rng(1)
    lengths = np.sort(r.integers(1, 33, 400))[::-1]
    number, offset = packing.sum_of_squares(lengths, 32)
    gaps, seen = {}, set()
    for n, i, o in zip(lengths.tolist(), number.tolist(), offset.tolist()):
        count = collections.Counter(g for g in gaps.values() if g)
        cost = {}
        for g in {g for g in gaps.values() if g >= n}:
            after = count.copy()
            after[g] -= 1
            after[g - n] += g > n
            cost[g] = sum(v * v for v in after.values())
        if i in seen:
            assert cost[gaps[i]] == min(cost.values()) and o == 32 - gaps[i]
        else:
            assert not cost and o == 0
        seen.add(i)
        gaps[i] = gaps.get(i, 32) - n


def test_token_files(odd, none):
    manifest = token_files.write(odd, WORD, 2)
    out = token_files.read(manifest).collect()
    t = library(WORD)
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == [r.doc_id for r in rows]
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    want = collections.Counter((r.doc_id, np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for r in rows)
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in out) == want
    assert {r.width for r in manifest.collect()} == {2}
    assert token_files.read(token_files.write(none, WORD, 2)).collect() == []


def test_lost_attempts_leave_no_rows(odd, spark):
    """Files beside those of the manifest, as a lost task leaves them, are not read."""
    manifest = token_files.write(odd, WORD, 2)
    folder = manifest.first()["folder"]
    store, place = common.open_folder(folder)
    with store.open_output_stream(f"{place}/000000-lost.bin") as f:
        f.write(b"\1\2\3")
    assert token_files.read(manifest).count() == odd.count()


def test_warc(spark):
    x, y = "x" * 200, "é" * 80
    pages = spark.createDataFrame([(1, "u", x, 1), (2, None, x, 2), (None, "v\nw", x, 3), (2, "u", "y", 4), (3, "u", "y", 5), (4, "u", None, 6),
                                   (5, "u", y, 7), (5, "u", y, 7), (6, "u", y, 8), (None, "q", "w" * 150, 9), (None, "q", "w" * 150, 9)],
                                  "page_id long, url string, html string, payload int")
    out = collections.Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read(warc.write(warc.plan(pages))).collect())
    d = {h: brute.sha(h) for h in (x, y, "y", "", "w" * 150)}
    assert out == collections.Counter([
        (1, "response", None, 200, d[x]), (2, "revisit", 1, 200, d[x]), (None, "revisit", 1, 200, d[x]), (2, "response", None, 1, d["y"]),
        (3, "response", None, 1, d["y"]), (4, "response", None, 0, d[""]), (5, "response", None, 160, d[y]), (5, "response", None, 160, d[y]),
        (6, "revisit", 5, 160, d[y]), (None, "response", None, 150, d["w" * 150]), (None, "response", None, 150, d["w" * 150])])
    assert warc.read(warc.write(warc.plan(pages.where("1 = 0")))).collect() == []


def test_warc_dictionary_and_frames(tmp_path, monkeypatch):
    import zstandard
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 1 << 16)
    store, place = common.open_folder(str(tmp_path))
    archive = warc.Archive(store, place)
    r = random.Random(1)
    rows = [{"page_id": i, "url": "u", "payload": sentence(r, 60).encode(), "record_type": "response", "refers_to": None} for i in range(500)]
    for row in rows:
        archive.add(warc.record(row | {"payload_digest": brute.sha(row["payload"])}))
    path = archive.close()["path"]
    raw = open(path, "rb").read()
    assert int.from_bytes(raw[:4], "little") == 0x184D2A5D
    size = int.from_bytes(raw[4:8], "little")
    assert zstandard.ZstdCompressionDict(raw[8:8 + size]).dict_id()
    assert raw.count(b"\x28\xb5\x2f\xfd") >= 500  # a frame a record
    with open(path, "rb") as f:
        assert [x["payload"] for x in warc.records(f)] == [row["payload"] for row in rows]


def test_quality_counts(odd, none):
    out = quality.judged(odd.withColumn("n_words", odd.doc_id).withColumn("kept", odd.doc_id)).collect()
    assert len(out) == odd.count()
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(r.text or "")
        assert not (r.base_failed and r.kept)
    assert quality.judged(none).collect() == []
    assert quality.filtered(odd).columns == odd.columns


def test_quality_fences(spark):
    """A source with more symbols has a higher fence; small groups take that of their language."""
    r = random.Random(3)

    def text(symbols):
        words = sentence(r, 100).split()
        for i in r.sample(range(100), symbols):
            words[i] += "#"
        return " ".join(words)

    rows = [(i, text(0), "en", "clean") for i in range(300)] + [(1000 + i, text(r.randint(10, 40)), "en", "noisy") for i in range(300)]
    rows += [(2000, text(45), "en", "clean"), (2001, text(45), "en", "noisy"), (2002, text(0), "en", "tiny"), (2003, text(0), None, None)]
    out = {x.doc_id: x for x in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not out[2000].kept and out[2001].kept and out[2002].kept and out[2003].kept
    assert all(out[i].kept for i in range(300))
    exact = np.median([out[1000 + i].symbol_ratio for i in range(300)] + [out[2001].symbol_ratio])
    upper = np.quantile([out[1000 + i].symbol_ratio for i in range(300)] + [out[2001].symbol_ratio], 0.75)
    assert abs(out[2001].most_symbol_ratio - (exact + 4 * max(upper - exact, 0.005))) < 0.01


def test_personal_data():
    r = random.Random(1)
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 50))) for a in ("ab@.-%1 é", "0123.. ", "4 -012345678", "+1 ().-09", "a1@.+ -(0") for _ in range(4000)]
    texts += ["4111 1111 1111 1111 and 4111-1111-1111-1112", "x" * 50_000 + "@", "1" * 50_000, "a@b.c@d.e", "+1 (555) 010-9999 00"]
    for t in texts:
        assert pii.base_spans(t) == brute.personal(t)


def test_personal_data_model(odd, none):
    model = pii.train(odd)
    # on forms of strings that the trees haven't seen
    assert model.held_out["accuracy"] > 0.9 and model.held_out["candidates"] > 500
    assert all(0.5 <= t <= pii.HIGHEST for t in model.thresholds) and 0.1 < model.platt[0] < 5
    for name, *_ in pii.GENERATORS:
        assert model.held_out[name]["recall"] > 0.5 and model.held_out[name]["precision"] > 0.8, (name, model.held_out[name])
    texts = ["reach me: joe.doe (at) mail (dot) org today", "version 1.22.3456.78 of it", "call (555) 123-4567 now", "order 1234567890 came"]
    found = [[(k, t[a:b]) for k, a, b, _, _ in s] for t, s in zip(texts, pii.find(texts, model))]
    assert found == [[("email", "joe.doe (at) mail (dot) org")], [], [("phone", "(555) 123-4567")], []]
    out = pii.detect(odd, model).collect()
    assert len(out) == odd.count()
    for r in out:
        assert [(s.kind, s.start, s.end) for s in r.pii if s.base] == brute.personal(r.text or "")
    assert any(r.text and "[EMAIL] or [IP], [PHONE]" in r.text for r in pii.redacted(odd, model).collect())
    assert sum(r.text is None for r in pii.redacted(odd, model).collect()) == sum(r.text is None for r in odd.collect())
    assert pii.detect(none, pii.train(none)).collect() == []


def test_fingerprints_are_local():
    r = random.Random(4)
    a = sentence(r, 600)
    b = sentence(r, 50) + a[7:]
    x, y, z = fingerprints.fingerprints([a, b, sentence(r, 600)])
    alone = fingerprints.fingerprints([a])[0]
    assert (x == alone).all()
    assert fingerprints.likeness(x[None], y[None])[0] > 0.7
    assert fingerprints.likeness(x[None], z[None])[0] < 0.3
    assert fingerprints.likeness(*fingerprints.fingerprints(["", ""])[:, None]) == 1
    assert fingerprints.likeness(*fingerprints.fingerprints(["", "b"])[:, None]) == 0
    assert (fingerprints.fingerprints(["aaaaaaaa" * 500]) > 0).any()


def test_fingerprint_neighbours(odd, none, spark):
    rows = sorted(((r.doc_id, r.text or "") for r in odd.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()))
    out = {r.doc_id: r for r in fingerprints.neighbours(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert sorted(out) == [k for k, _ in rows]
    for (k, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        e = t[:len(t) - len(t) // 4] + u[:len(t) // 4]
        f, g, h = fingerprints.fingerprints([t, e, u])
        assert (out[k].n_chars, out[k].edited_sha256, out[k].fingerprint, out[k].edited_fingerprint) == (len(t), brute.sha(e), f.tobytes().hex(), g.tobytes().hex())
        assert out[k].near_next == pytest.approx(fingerprints.likeness(f[None], h[None])[0])
    assert len(fingerprints.neighbours(odd).collect()) == odd.count()
    assert fingerprints.neighbours(none).collect() == []
    one = fingerprints.neighbours(spark.createDataFrame([(7, "some text")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_banding():
    for threshold in (0.5, 0.8, 0.9):
        b, r = ngram_join.banding(threshold, 0.999)
        assert b * r <= ngram_join.MOST_HASHES and 1 - (1 - threshold ** r) ** b >= 0.999


def corpus(seed=8):
    """Copies, near copies of varying distance and a passage that many share."""
    r = random.Random(seed)
    texts = [sentence(r, 120) for _ in range(12)]
    passage = sentence(r, 60)
    for i in range(60):
        words = r.choice(texts[:12]).split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            words[r.randrange(len(words))] = "edit"
        texts.append(" ".join(words))
    texts += [sentence(r, 40) + " " + passage + " " + sentence(r, r.randint(3, 40)) for _ in range(10)]
    texts += ["one two three", "one two three", "", "", "a b"]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [800, 4])
def test_ngram_join(spark, monkeypatch, block):
    """Also with blocks split into parts of four."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    docs = corpus()
    out = ngram_join.linked(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.class_id, r.text_class, r.copies, r.n_links) for r in out} == brute.near(docs)
    assert len(out) == len(docs) and sum(r.is_first for r in out) == len({r.class_id for r in out})


def test_ngram_join_odd(odd, none):
    out = ngram_join.linked(odd.withColumn("class_id", odd.doc_id)).collect()
    assert len(out) == odd.count()
    by = collections.defaultdict(set)
    for r in out:
        if brute.grams(r.text or ""):
            by[r.text].add((r.class_id, r.text_class, r.copies, r.n_links))
    assert all(len(x) == 1 for x in by.values())
    kept = ngram_join.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sum(r.text == odd_texts()[5] for r in kept.collect()) == 1
    assert ngram_join.linked(none).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (100, 102), (7, 7)]
    out = {r.node: r.root for r in common.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_difference_cover():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


@pytest.mark.parametrize("span", [1 << 20, 50])
def test_suffix_order(monkeypatch, span):
    """The blockwise order against a plain sort, in one range and in several."""
    monkeypatch.setattr(suffix_dedup, "RANGE", span)
    r = random.Random(6)
    for text in (bytes(r.choice(b"ab") for _ in range(900)), b"abcab" * 30 + b"x" + b"abcab" * 30, bytes(range(1, 256)) * 2):
        places = np.arange(len(text) - 88) if len(text) > 88 else np.arange(0)
        s = suffix_dedup.Suffixes(np.frombuffer(text, np.uint8))
        got = [text[p:p + 80] for part in s.sorted(places) for p in part]
        assert got == sorted(got) and len(got) == len(places)


@pytest.mark.parametrize("block", [4 << 20, 3000])
def test_suffix_dedup(spark, monkeypatch, block):
    """Also over many blocks and with passes far shorter than a text."""
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "PASS_BYTES", 1 << 20 if block > 3000 else 700)
    docs = corpus(9) + [(1000, "é" * 200), (1001, "é" * 150), (1002, "ab" * 400), (None, "ab" * 300), (None, "ab" * 300), (1003, "x" * 49), (1004, "x" * 49)]
    df = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, kept int")
    out = suffix_dedup.spans_removed(df).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out)) == \
        sorted(((k is None, k or 0, n, m, s, x) for k, n, m, s, x in brute.repeats(docs)))


def test_suffix_dedup_odd(odd, none):
    out = suffix_dedup.spans_removed(odd).collect()
    want = brute.repeats([(r.doc_id, r.text or "") for r in odd.collect()])
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == collections.Counter(want)
    assert suffix_dedup.spans_removed(none).collect() == []
    text = {r.doc_id: r.text for r in suffix_dedup.deduplicated(odd).where("doc_id is not null").collect()}
    assert text[1] is None and text[5] == odd_texts()[5] and text[6] == ""


def test_licenses(odd, none, spark):
    model = licenses.train(odd)
    assert model.held_out["accuracy"] > 0.97
    lines = ["A line of text.\nReleased under the MIT License.\nmore", "Licensed under the Apache License, Version 2.0.", "The driving license was lost.",
             "words before it, licensed under CC BY-NC 4.0. and after", "This work is licensed under the GNU General Public License, version 3.", ""]
    found = [[f["family"] for f in x if f["confirmed"]] for _, x in licenses.scan_texts(lines, model)]
    assert found == [["MIT"], ["Apache-2.0"], [], ["CC-BY-NC"], ["GPL-3.0"], []]
    out = licenses.scan(odd.withColumn("licences", odd.doc_id), model)
    assert out.count() == odd.count() and out.columns == [*odd.columns, "n_paragraphs", "licences"]
    assert licenses.scan(none, licenses.train(none)).collect() == []


def test_lookup_splits_hot_keys(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else i % 50) for i in range(3000)], "i long, k long")
    table = rows.groupBy("k").count().selectExpr("k", "count as n", "coalesce(k, -1) * 2 as v")
    out = common.lookup(rows, table, ["k"], "n", 3000 * 30).collect()
    assert len(out) == 3000 and all(r.v == (-2 if r.k is None else 2 * r.k) for r in out)


def test_crc(odd):
    from pyspark.sql import functions as F
    out = packing.pieces(odd, BYTE, 2, 64).withColumn("crc", F.crc32("ids")).collect()
    assert all(r.crc == zlib.crc32(bytes(r.ids)) for r in out)
