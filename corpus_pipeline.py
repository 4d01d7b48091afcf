"""From raw documents to packed training sequences: STAGES in order, each on all that the one before kept.

Each function takes (spark, docs, sf_dir); all but the last return the columns of documents. ``run`` writes the rows
of each stage to the shared folder and reads them again for the next.

In every stage a null text counts as empty, null id, language and source are values like any other, and columns beyond those of
documents pass through under their names, whatever these are (the last stage has its own columns). An empty table stays empty.
Repeated rows are judged each; as near duplicates they are one class, of which one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.llm import ngram_join, packing, pii, quality, queries, suffix_dedup
from zonekit.llm.common import documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the fences of their language and source go: null and empty texts among them."""
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 or more join, the one with the least id stays (null ids are last). Texts without words link to nothing
    and stay, repeated ones too."""
    return ngram_join.deduplicated(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that a document with a smaller id has go. Null ids count as after all others; equal ids don't touch each other.
    ``n_chars`` is counted anew here and in the next stage."""
    return suffix_dedup.deduplicated(docs).withColumn("n_chars", F.length("text").cast("long"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; a null text stays null."""
    return pii.redacted(docs, pii.train(docs)).withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens, one row a piece, with its ids. Empty texts are one piece of the end id."""
    return packing.pack(packing.pieces(docs, queries.BYTE_BPE, queries.END_ID, queries.SEQUENCE), queries.SEQUENCE)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
          ("personal_data", personal_data), ("best_fit_packing", best_fit_packing)]

#: N-gram links, suffixes and tokens aren't SQL's; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
