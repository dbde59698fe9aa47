"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from outlay.llm import (
    exact_dedup,
    fingerprints,
    ngram_join,
    packing,
    periodic_runs,
    pieces,
    simple8b,
    spelling,
    substrings,
    suffix_family,
    toxicity,
    transcripts,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, against their edited texts and their successors."""
    return fingerprints.edit_likeness(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that occur more than once, wherever they occur."""
    found = substrings.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "n_words", "removed", "cluster_id", "keep_id")


def op3_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through WARC archives and back."""
    return warc.through_archives(_table(spark, sf_dir, "pages"))


def op4_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents through Simple-8b files and back."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return simple8b.through_files(_table(spark, sf_dir, "documents"), path, end_id=2)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path, end_id=0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.score(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_groups(docs, hash_all=True).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces and back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_and_decode(_table(spark, sf_dir, "documents"), path)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles are alike to 85 %."""
    docs = _table(spark, sf_dir, "documents")
    found = ngram_join.similar_groups(docs, k=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op10_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from raw transcripts of all conversations."""
    return transcripts.canonical(_table(spark, sf_dir, "conversations"))


def op11_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that an earlier one has."""
    found = suffix_family.without_repeated_bytes(_table(spark, sf_dir, "documents"))
    return suffix_family.removal_digests(found)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeat with a period in all documents, some of which are made to."""
    docs = _table(spark, sf_dir, "documents")
    return periodic_runs.run_digests(periodic_runs.word_runs(docs, edit=periodic_runs.repeat_some))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some of which are misspelt, with their more frequent forms."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), change=spelling.misspell_some)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_fingerprints, op2_substring_dedup, op3_warc_segments, op4_simple8b, op5_packing, op6_toxicity,
        op7_exact_dedup, op8_sentencepiece, op9_ngram_join, op10_transcripts,
        op11_suffix_family, op12_periodic_runs, op13_spelling_variants,
    )}


# Base 32 of a SHA-1: every five hex digits are four characters.
_OP3_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
         sha1(coalesce(html, '')) as h
  from pages
), f as (select h, min(page_id) as first_id from p group by h)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int,
         1)), '') as payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from p join f using (h)
"""

_OP7_SQL = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), h as (select doc_id, sha256(t) as text_sha256 from d)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, text_sha256
from h window w as (partition by text_sha256)
"""

# Hex digits, two a byte: windows of 50 bytes, those an earlier document has, and runs of them.
_OP11_SQL = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n
  from documents
), w as (
  select doc_id, i, substr(h, 2 * i + 1, 100) as s
  from (select doc_id, h, unnest(range(0, n - 49)) as i from d)
), f as (select doc_id, i from (select *, min(doc_id) over (partition by s) as first_id from w)
         where first_id < doc_id),
b as (select *, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new
      from f),
g as (select *, sum(new) over (partition by doc_id order by i) as k from b),
r as (select doc_id, k, min(i) as a, max(i) + 50 as z from g group by doc_id, k),
p as (select *, coalesce(lag(z) over (partition by doc_id order by a), 0) as before,
             row_number() over (partition by doc_id order by a desc) as back from r),
t as (
  select doc_id, sum(z - a) as n_removed, count(*) as n_spans,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before))
                    || case when back = 1 then substr(h, 2 * z + 1) else '' end, '' order by a) as kept
  from p join d using (doc_id) group by doc_id
)
select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256
from d left join t using (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_segments": _OP3_SQL,
        "op7_exact_dedup": _OP7_SQL,
        "op11_suffix_family": _OP11_SQL,
    }
