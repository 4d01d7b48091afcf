"""The pipeline and the registered queries on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    """Each stage against a plain version, each on what the one before kept."""
    import corpus_pipeline
    from zonekit.llm import pii, quality
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    assert kept <= {k for k, r in rows.items() if not brute.quality(r.text)[-1]}
    state = {k: rows[k].text for k in kept}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF_SMALL)
        if name == "best_fit_packing":
            break
        assert docs.columns == COLUMNS
        docs = docs.cache()
        now = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(now) and all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "near_duplicates":
            classes = brute.near(sorted(state.items()))
            state = {k: t for k, t in state.items() if classes[k][0] == k}
        elif name == "repeated_strings":
            state = {k: x.decode("utf-8", "ignore") for k, _, _, _, x in brute.repeats(sorted(state.items()))}
        elif name == "personal_data":
            model = pii.train(before)
            for k, t in now.items():
                assert all(state[k][a:b] not in t for _, a, b in brute.personal(state[k]))
            state = {k: pii_text(state[k], model) for k in state}
        assert now == state
    packed = docs.collect()
    assert {r.doc_id for r in packed} == set(state)
    assert max(r.offset + r.length for r in packed) <= 1024


def pii_text(text, model):
    from zonekit.llm import pii
    out, end = "", 0
    for kind, a, b, _, _ in pii.find([text], model)[0]:
        if a >= end:
            out += text[end:a] + f"[{kind.upper()}]"
        end = max(end, b)
    return out + text[end:]


def test_run(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"} == set(out.columns) and out.count() > 0


@pytest.mark.parametrize("name", ["op1_bpe", "op2_pii", "op3_fingerprints", "op4_packing", "op5_warc", "op6_licenses", "op7_ngram_join", "op8_quality",
                                  "op9_token_files", "op10_suffix_dedup"])
def test_registered(spark, name):
    import __spark_entry__ as entry
    import oracle_check
    fn = entry.queries()[name]
    table = "pages" if name == "op5_warc" else "documents"
    rows = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    if name in entry.oracle_sql():
        result = oracle_check.compare(spark, name, fn, entry.oracle_sql()[name], SF_SMALL, oracle_check.duck_conn(SF_SMALL))
        assert result["ok"], result
    elif name == "op4_packing":
        assert fn(spark, SF_SMALL).select("doc_id").distinct().count() == rows
    else:
        assert fn(spark, SF_SMALL).count() == rows
