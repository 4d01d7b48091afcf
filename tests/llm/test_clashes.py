"""Columns of any name pass through the filtering stages unchanged; odd tables through all stages."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from conftest import SF_SMALL  # noqa: E402

NAMES = ["rows", "kept", "_row", "_c", "_t", "_w", "_n", "copies", "class_id", "is_first", "_block", "n_bytes", "n_words", "most_symbol_ratio", "_own", "_text",
         "_id", "_lang", "_source", "one", "n", "h", "cell"]


@pytest.fixture(scope="module")
def clashing(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in NAMES}).cache()


@pytest.mark.parametrize("stage", ["quality_rules", "near_duplicates", "repeated_strings", "personal_data"])
def test_stages_keep_columns(spark, clashing, stage):
    import corpus_pipeline
    fn = dict(corpus_pipeline.STAGES)[stage]
    plain = {r.doc_id: r.text for r in fn(spark, clashing.drop(*NAMES), SF_SMALL).collect()}
    out = fn(spark, clashing, SF_SMALL)
    assert out.columns == clashing.columns
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == plain and len(rows) == len(plain)
    assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in NAMES)


def test_all_stages_on_odd_rows(spark):
    """Nulls in any column, empty, repeated and long texts, and no rows at all."""
    import corpus_pipeline
    schema = "doc_id long, text string, lang string, source string, n_chars long, rows string"
    word = "plain words of an ordinary text that goes on for a while without any end in sight "
    rows = [(i, f"{i} " + "".join(f"w{i * 31 + j} " for j in range(60)), ["en", None][i % 2], ["s", None][i % 2], 1, "x") for i in range(12)]
    rows += [(None, None, None, None, None, None), (None, "", None, None, None, None), rows[3], rows[3], (50, word * 3000, "en", "s", 1, None), (51, "", "en", "s", 0, "y")]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_SMALL)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "rows"]
            docs = docs.cache()
            docs.count()
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
