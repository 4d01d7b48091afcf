"""What the operators once left out."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from conftest import SF_SMALL


def test_pipeline_returns_ids(spark):
    """The ids of each document's pieces, put together, are those of the text that reaches the packing stage."""
    import corpus_pipeline
    from zonekit.llm import queries
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    found, places = collections.defaultdict(bytes), collections.defaultdict(list)
    for r in sorted(out, key=lambda r: (r.doc_id, r.piece)):
        assert len(r.ids) == 4 * r.length
        found[r.doc_id] += bytes(r.ids)
        places[r.sequence_id].append((r.offset, r.length))
    for r in docs.collect():
        assert found[r.doc_id] == np.array([*t.encode(r.text or "", add_special_tokens=False).ids, queries.END_ID], "<u4").tobytes()
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]


def test_run_returns_ids(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert "ids" in out.columns and out.where("ids is null or octet_length(ids) <> 4 * length").count() == 0 and out.count() > 0


def test_packing_digest_is_taken_after_packing(spark, monkeypatch):
    """op4's checksum covers what the packer returns: a packer that loses ids shows in it."""
    from pyspark.sql import functions as F
    from zonekit.llm import packing, queries
    pack = packing.pack
    monkeypatch.setattr(packing, "pack", lambda df, n: pack(df, n).withColumn("ids", F.lit(b"lost")))
    assert {r.ids_crc32 for r in queries.op4_packing(spark, SF_SMALL).collect()} == {zlib.crc32(b"lost")}


def test_fences_reject_outliers_of_every_ratio(spark):
    """Documents that pass the base rules, in a source whose documents hardly differ."""
    from zonekit.llm import quality
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))

    def lines(n=20, length=(3, 4, 5, 6)):
        return [" ".join(word(r.choice(length)) for _ in range(5)) for _ in range(n)]

    plain = lines()
    symbols = [x + "#" if i < 15 else x for i, x in enumerate(" ".join(lines()).split())]  # 0.15
    repeated = lines(11) + 3 * [" ".join(word(4) for _ in range(15))]  # 45 of 100 words
    cases = {1000: "\n".join(plain), 1001: " ".join(symbols),
             1002: "\n".join(lines(13) + [x for i in range(7) for x in ("ab", "cd efg hijk lmno pq" + word(3))]),
             1003: "\n".join(repeated).replace("\n", " "), 1004: "\n".join(lines(length=(1, 2, 3))), 1005: "\n".join(lines(length=(6, 7, 8)))}
    rows = [(i, "\n".join(lines()), "en", "narrow") for i in range(400)] + [(k, t, "en", "narrow") for k, t in cases.items()]
    out = {x.doc_id: x for x in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(out[k].base_failed for k in cases) and out[1000].word_length > 4
    for k, ratio in ((1001, "symbol_ratio"), (1002, "dup_line_ratio"), (1003, "repeat_ratio"), (1005, "word_length")):
        assert out[k][ratio] > out[k][f"most_{ratio}"] and not out[k].kept, ratio
    assert out[1004].word_length < out[1004].least_word_length and not out[1004].kept
    assert sum(out[i].kept for i in range(400)) > 380


JWT = ".".join("eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9"[:36] + "aB3_x-9Z" * 5 for _ in range(3))


def test_generators_propose_whole_strings():
    """Every form by itself, as the only one in its text."""
    from zonekit.llm import pii
    for text, want in [("ask jane at example.com today", "jane at example.com"), ("ask jane @ example.com today", "jane @ example.com"),
                       ("ask jane(AT)example(DOT)com today", "jane(AT)example(DOT)com"), ("ask jane AT example DOT com today", "jane AT example DOT com"),
                       ("x" * 100 + "(at)example.com", "x" * 100 + "(at)example.com"), (f"token={JWT} end", f"token={JWT}"),
                       ("key " + "0a1b2c3d" * 16 + " end", "0a1b2c3d" * 16), ("sk_live_" + "4eC39HqLyjWD" * 9, "sk_live_" + "4eC39HqLyjWD" * 9),
                       ("host 2001:db8::1 is", "2001:db8::1"), ("host fe80::1ff:fe23:4567:890a%eth0", "fe80::1ff:fe23:4567:890a"),
                       ("to ::1 and", "::1"), ("net 2001:db8::/32", "2001:db8::")]:
        assert want in {text[a:b] for _, a, b in pii.candidates(text)}, text
    assert pii.candidates("std::vector and a :: b") == []


def test_generators_are_linear():
    import time
    from zonekit.llm import pii
    for text in ("a" * 300_000 + " at " + "b" * 300_000, "a_" * 300_000, "a1_" * 200_000, "token=" * 100_000, "a at " * 100_000, "b." * 200_000 + "@" * 1000,
                 "1:" * 200_000, "x at " + "b. " * 200_000, "::" * 200_000):
        start = time.process_time()
        pii.candidates(text)
        assert time.process_time() - start < 5


def test_whole_strings_are_redacted(spark):
    from zonekit.llm import pii
    model = pii.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    print(model.held_out, model.thresholds)
    texts = ["please write to jane.doe at example.com today", "contact jane_roe @ example.org for it", f"use token={JWT} here",
             "the key " + "0a1b2c3d" * 16 + " of it", "host 2001:db8::12 is down", "mail joe.doe(AT)example(DOT)org now", "the book is available at example.com today"]
    found = [[t[a:b] for _, a, b, _, _ in s] for t, s in zip(texts, pii.find(texts, model))]
    assert found == [["jane.doe at example.com"], ["jane_roe @ example.org"], [f"token={JWT}"], ["0a1b2c3d" * 16], ["2001:db8::12"],
                     ["joe.doe(AT)example(DOT)org"], []]


def test_wrapped_notices(spark):
    from zonekit.llm import licenses
    model = licenses.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    notices = {"MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""", "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""", "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above""", "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""}
    for family, notice in notices.items():
        for mark in ("", " * ", "# "):
            text = "int x;\n\n" + "\n".join(mark + x for x in notice.split("\n")) + "\n\nint main() {}"
            found = licenses.scan_texts([text], model)[0][1]
            assert [f["family"] for f in found if f["confirmed"]] == [family], (family, mark, found)
    apart = notices["BSD"].replace("\n", "\n\n")
    assert not any(f["confirmed"] for f in licenses.scan_texts([apart], model)[0][1])


def test_numbers_of_any_length_and_time(spark):
    """No number is cut in two, and many spans in one text take time in proportion."""
    import time
    from zonekit.llm import pii
    for digits in ("12345678901234567890123456", "4" * 300, "1234 5678 9012 3456 7890 1234 56"):
        assert [text[a:b] for text in [f"account {digits} here"] for g, a, b in pii.candidates(text) if pii.GENERATORS[g][0].endswith("numbers")] == [digits]
    model = pii.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    for unit in ("a.b@c.org ", "jane at example.com ", "123-45-6789 and more words of it, "):
        seconds = []
        for n in (250_000, 1_000_000):
            start = time.process_time()
            pii.find([unit * (n // len(unit))], model)
            seconds.append(time.process_time() - start)
        assert seconds[1] < 8 and seconds[1] < 8 * max(seconds[0], 0.1), (unit, seconds)


def test_revisits_resolve_by_standard_fields(spark):
    """Another reader finds the response of a revisit by record id, URI and date alone."""
    import struct

    import zstandard

    from zonekit.llm import warc
    pages = spark.createDataFrame([(i, f"http://x/{i}" if i % 4 else None, "<p>" + "same text " * (20 + i % 5)) for i in range(60)], "page_id long, url string, html string")
    found = []
    for row in warc.write(warc.plan(pages.repartition(6))).collect():
        data = open(row.path, "rb").read()
        size = struct.unpack("<II", data[:8])[1]
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])).stream_reader(data[8 + size:], read_across_frames=True).read()
        for head in plain.split(b"WARC/1.1\r\n")[1:]:
            found.append(dict(x.split(": ", 1) for x in head.split(b"\r\n\r\n")[0].decode().split("\r\n")))
    by_id = {f["WARC-Record-ID"]: f for f in found}
    assert len(found) == len(by_id) == 60
    revisits = [f for f in found if f["WARC-Type"] == "revisit"]
    assert len(revisits) == 55
    for f in revisits:
        to = by_id[f["WARC-Refers-To"]]
        assert to["WARC-Type"] == "response" and to["WARC-Payload-Digest"] == f["WARC-Payload-Digest"] and to["WARC-Date"] == f["WARC-Refers-To-Date"]
        assert to.get("WARC-Target-URI") == f.get("WARC-Refers-To-Target-URI")


def test_near_duplicates_in_small_parts(spark, monkeypatch):
    """Blocks cut by classes or by n-grams give the links of whole ones."""
    import os
    import sys
    sys.path.insert(0, os.path.dirname(__file__))
    import brute
    from zonekit.llm import ngram_join
    r = random.Random(8)
    base = [f"w{r.randint(0, 400)}" for _ in range(400)]
    docs = []
    for i in range(60):
        words = base[:r.choice([60, 90, 200, 390])]
        words[r.randrange(len(words))] = f"x{i}"
        docs.append((i, " ".join(words)))
    want = {k: (v[0], v[3]) for k, v in brute.near(docs).items()}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for block, grams in ((800, 2_000_000), (4, 2_000_000), (800, 700)):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", grams)
        assert {x.doc_id: (x.class_id, x.n_links) for x in ngram_join.linked(df, keep=["doc_id"]).collect()} == want, (block, grams)
