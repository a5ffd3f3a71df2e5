"""The queries opN_<name>: each applies one operator, with production
parameters, to its whole tables.  ORACLE holds DuckDB SQL where it can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (byte_bpe, centroids, decontaminate, hard_negatives, html_text, merkle, quality, repeated_bytes, simhash, substrings, token_counts, token_files,
               toxicity)
from .common import read_table


def op1_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(spark, path, token_files.crc_row, token_files.CRC_SCHEMA)


def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_decontaminate(spark, sf_dir):
    return decontaminate.report(decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), size=10))


def op4_merkle(spark, sf_dir):
    return merkle.edited_pairs(read_table(spark, sf_dir, "documents"))


def op5_substrings(spark, sf_dir):
    return substrings.remove_repeats(read_table(spark, sf_dir, "documents"), substrings.digest_columns, substrings.DIGEST_SCHEMA)


def op6_html_text(spark, sf_dir):
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op7_quality(spark, sf_dir):
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), "source", ["lang"])


def op8_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.classify(docs, docs, read_table(spark, sf_dir, "labels"), "toxic")


def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_byte_bpe(spark, sf_dir):
    return byte_bpe.encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                     public_tokenizers.PATTERN, byte_bpe.digest_row, byte_bpe.DIGEST_SCHEMA)


def op11_repeated_bytes(spark, sf_dir):
    return repeated_bytes.remove_repeats(read_table(spark, sf_dir, "documents"), repeated_bytes.digest_columns, repeated_bytes.DIGEST_SCHEMA, size=200)


def op12_centroids(spark, sf_dir):
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"), clusters=8, rounds=10, seed=3, factor=1024, width=64)


def op13_hard_negatives(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(moved, moved.vec_id % 50 == 0, positives=5, negatives=3, least=50, most=95, factor=256)


QUERIES = {f.__name__: f for f in (op1_token_files, op2_simhash, op3_decontaminate, op4_merkle, op5_substrings, op6_html_text, op7_quality, op8_toxicity,
                                  op9_token_counts, op10_byte_bpe, op11_repeated_bytes, op12_centroids, op13_hard_negatives)}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op3_decontaminate": f"""
with doc as (select doc_id, {_WORDS} as w from documents),
item as (select coalesce(cast(item_id as varchar), '') as item, {_WORDS} as w from benchmark),
win as (select distinct item, least(10, len(w)) as n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') as phrase
        from item, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as u(p) where len(w) > 0),
occ as (select doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') as phrase
        from doc, (select distinct n from win) as lengths, unnest(range(1, len(w) - n + 2)) as u(p)),
hit as (select doc_id, item, n, p from occ join win using (n, phrase)),
covered as (select doc_id, count(distinct q) as n_hit from hit, unnest(range(p, p + n)) as u(q) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hit) as d group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join covered using (doc_id) left join named using (doc_id)""",
    "op5_substrings": r"""
with doc as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) as h from doc, unnest(range(1, len(w) - 48)) as u(p)),
least as (select h, min(doc_id) as first_id from win group by h having min(doc_id) < max(doc_id)),
gone as (select distinct doc_id, q from win join least using (h), unnest(range(p, p + 50)) as u(q) where first_id < doc_id),
kept as (select doc_id, string_agg(w[q], ' ' order by q) as words, count(*) as n
         from (select doc_id, w, unnest(range(1, len(w) + 1)) as q from doc) as d anti join gone using (doc_id, q) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(words, '')) as kept_sha256
from doc left join kept using (doc_id)""",
}
