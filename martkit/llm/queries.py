"""The corpus queries, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import bpe, decontaminate, htmltext, lexical, licenses, nearcopies, neighbours, packing, quality, repeats, tokencount, urlfilter, whitening
from martkit.llm.frames import joined_sha256, ready, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(ready(spark), sf_dir, "pages"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_pages(table(ready(spark), sf_dir, "pages"))


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_copies(table(ready(spark), sf_dir, "documents"))


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_bytes(table(ready(spark), sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(ready(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        joined_sha256("items").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(ready(spark), sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(ready(spark), sf_dir, "embeddings"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(ready(spark), sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(ready(spark), sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(ready(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(ready(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(table(ready(spark), sf_dir, "embeddings"))
    return done.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_documents(table(ready(spark), sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decode=True)
    return done.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filter, op2_html_extraction, op3_near_copies, op4_repeated_bytes, op5_decontamination, op6_packing, op7_neighbours, op8_license_scan, op9_token_counts, op10_quality, op11_lexical_search, op12_whitening, op13_byte_pairs)
}

# Twins in DuckDB, where SQL can express the query.
_URL_SQL = """
with parts as (
    select page_id, coalesce(url, '') as u, strpos(coalesce(url, ''), '://') as mark from pages
), rest as (
    select page_id, case when mark > 0 then substr(u, mark + 3) else '' end as r from parts
), split as (
    select page_id, regexp_extract(r, '^[^/?#]*') as raw, r from rest
), named as (
    select page_id,
        translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') as path
    from split
), rules(verdict, rule_host, rule_path) as (
    values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
)
select page_id, host, path,
    (select arg_max(rule_host || rule_path, length(rule_host || rule_path)) from rules
     where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as rule,
    coalesce(
        (select arg_max(rules.verdict, length(rule_host || rule_path)) from rules
         where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)),
        case when regexp_matches(host, 'casino|free-bets|cheap-pills|ads-track') then 'block' else 'allow' end) as verdict
from named
"""

_SEARCH_SQL = """
with words as (
    select row_number() over () as doc, doc_id,
        unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term
    from documents
), asked as (
    select item_id, term, count(*) as c
    from (
        select item_id,
            unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term
        from benchmark)
    group by item_id, term
), total as (
    select count(distinct doc) as big_n, count(*) as big_l from words
), postings as (
    select doc, doc_id, term, count(*) as tf from words group by doc, doc_id, term
), lengths as (
    select doc, 100 - 25 + ((25 * count(*) * any_value(big_n)) // any_value(big_l)) as m from words, total group by doc
), weights as (
    select term, cast(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) as bigint) as w from postings, total group by term
), scored as (
    select item_id, doc, doc_id, cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
    from asked join postings using (term) join weights using (term) join lengths using (doc)
    where doc_id is not null
    group by item_id, doc, doc_id
), ranked as (
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

ORACLES = {"op1_url_filter": _URL_SQL, "op11_lexical_search": _SEARCH_SQL}
