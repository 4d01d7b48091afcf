"""Registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, curriculum, fingerprints, lexical_search, licenses, ngram_join, packing, pii, prefix_trie, quality, suffix_dedup, token_files, warc
from .common import documents, stored

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
SEQUENCE = 1024


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and their decoded text, as digests."""
    ids = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), WORD_BPE).select("doc_id", "ids")
    out = bpe.decode(ids, WORD_BPE)
    return out.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts and digest of the base spans, and all spans."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.detect(docs, pii.train(docs)).select("doc_id", "pii")
    counts = [F.expr(f"size(filter(pii, s -> s.base and s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(pii.listed("pii", True), 256).alias("base_sha256"), pii.listed("pii", False).alias("spans"))


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited form, and their likeness."""
    return fingerprints.neighbours(documents(spark, sf_dir))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    out = packing.pack(packing.pieces(documents(spark, sf_dir), BYTE_BPE, END_ID, SEQUENCE), SEQUENCE)
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    manifest = warc.write(warc.plan(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return warc.read(manifest, payloads=False).drop("url", "payload")


ORACLES["op5_warc"] = """
with p as (select page_id, sha256(coalesce(html, '')) payload_digest, octet_length(encode(coalesce(html, ''))) payload_bytes from pages),
g as (select payload_digest, min(page_id) first from p group by payload_digest)
select p.page_id, payload_bytes::bigint payload_bytes, payload_digest,
 case when payload_bytes >= 100 and first <> page_id then 'revisit' else 'response' end record_type,
 case when payload_bytes >= 100 and first <> page_id then first end refers_to
from p join g using (payload_digest)"""


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every text."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = licenses.scan(docs, licenses.train(docs)).drop("text")
    families = F.expr("array_sort(array_distinct(transform(filter(licences, x -> x.confirmed), x -> x.family)))")
    return found.select("doc_id", "n_paragraphs", F.array_join(families, ",").alias("families"),
                        F.expr("size(filter(licences, x -> x.confirmed))").cast("long").alias("n_confirmed"),
                        F.expr("size(filter(licences, x -> not x.confirmed))").cast("long").alias("n_unconfirmed"))


@query
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates by word 5-grams: class and number of links of every document."""
    return ngram_join.linked(documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"]).drop("is_first")


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and adaptive verdict of every text."""
    return quality.judged(documents(spark, sf_dir), keep=["doc_id"])


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as flat token files and read back."""
    manifest = token_files.write(documents(spark, sf_dir), WORD_BPE, END_ID)
    return token_files.read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 50-byte strings removed from every text."""
    out = suffix_dedup.spans_removed(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes of every document."""
    return curriculum.taken(documents(spark, sf_dir), keep=["doc_id"])


ORACLES["op11_mixing"] = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size from documents),
s as (select source, sum(size)::bigint s from d group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5e0 when 1 then 2e0 else 1e0 end w from s),
f as (select *, s * 2e0 cap, s * 2e0 / w as full_at from w),
l as (select full_at, sum(cap) c, sum(w) w from f group by full_at),
r as (select full_at, (1.5e0 * (select sum(s)::double from s) - (sum(c) over (order by full_at) - c)) / ((select sum(w) from f) - (sum(w) over (order by full_at) - w)) lv from l),
t as (select source, s, least(cap, coalesce(w * (select arg_min(lv, full_at) from r where lv <= full_at), cap)) target from f),
o as (select d.*, t.s, t.target, floor(t.target)::bigint goal,
 sum(size) over (partition by d.source order by md5(coalesce(doc_id::varchar, '')), size) - size before
 from d join t on d.source is not distinct from t.source)
select doc_id, size, s source_size, target,
 (greatest(0, least(size, goal - before)) + greatest(0, least(size, goal - s - before)))::bigint taken from o"""


def rebuilt(own: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Sequences whose first turns come from another: the first h of conversation c - c % group, then the own ones after the first h; h is
    the checksum of the decimal id modulo ``most`` (null id: 0)."""
    own = stored(own, "own_turns")
    head = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % most, F.lit(0)).cast("int")
    heads = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most - 1).alias("_head"))
    both = own.withColumn("_h", head).join(heads, F.col("conv_id") - F.col("conv_id") % group == F.col("_base"), "left")
    first = F.expr("slice(coalesce(_head, slice(turns, 1, 0)), 1, _h)")
    return both.select("conv_id", F.concat(first, F.expr("slice(turns, _h + 1, size(turns))")).alias("turns"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the rebuilt conversations."""
    own = prefix_trie.sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.trie(rebuilt(own)).drop("node", "parent")


ORACLES["op12_prefix_trie"] = """
with o as (select conv_id c, coalesce(role, '') role, coalesce(text, '') txt,
 row_number() over (partition by conv_id order by turn nulls first, role, text) p from conversations),
h as (select c, xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(c::varchar, ''), lambda x: ord(x)::bigint)),
 lambda a, b: list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 h from (select distinct c from o)),
r as (select h.c, 0 part, o.p, role, txt from h join o on o.c = h.c - h.c % 5 and o.p <= h.h
 union all select h.c, 1, o.p, role, txt from h join o on o.c = h.c and o.p > h.h),
s as (select c, row_number() over (partition by c order by part, p) d, md5(strlen(role) || ':' || role || txt) k, strlen(txt) b from r),
x as (select c, d, string_agg(k, '') over (partition by c order by d) path, b from s union all select c, 0, '', 0 from h),
n as (select path, any_value(d) depth, min(c) conv_id, count(*) n_convs, any_value(b) b from x group by path),
u as (select left(path, length(path) - 32) path, count(*) n_children from n where depth > 0 group by 1),
m as (select n.*, coalesce(n_children, 0) n_children from n left join u using (path)),
e as (select path, string_agg(c::varchar, ',' order by c) ids from (select c, arg_max(path, d) path from x group by c) group by path),
t as (select a.path, sum(case when b.n_children = 0 then 1 else 0 end) n_leaves, sum((b.n_convs - 1) * b.b) saved_tokens
 from m a join m b on starts_with(b.path, a.path) group by a.path)
select m.conv_id, m.depth::bigint depth, q.conv_id parent_conv_id, m.n_convs, m.n_children::bigint n_children, t.n_leaves::bigint n_leaves,
 t.saved_tokens::bigint saved_tokens, sha256(coalesce(e.ids, '')) ends_sha256
from m join t using (path) left join e using (path) left join m q on m.depth > 0 and q.path = left(m.path, length(m.path) - 32)"""


@query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents of highest score for every benchmark item."""
    return lexical_search.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=20)


ORACLES["op13_search"] = r"""
with t as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) w from documents),
b as (select item_id, w, count(*) times from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) w from benchmark) group by all),
n as (select doc_id, count(*) n from t group by doc_id),
g as (select count(*) docs, sum(n)::bigint len from n),
f as (select doc_id, w, count(*) tf from t where w in (select w from b) group by all),
v as (select w, floor(1000 * ln((2 * (select docs from g) + 2)::double / (2 * count(*) + 1)))::bigint wt from f group by w),
s as (select item_id, doc_id, sum(times * wt * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len))))::bigint score
 from b join f using (w) join v using (w) join n using (doc_id) cross join g group by item_id, doc_id)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int rank, doc_id, score from s where score > 0
qualify rank <= 20"""
