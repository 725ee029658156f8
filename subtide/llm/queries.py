"""Registered queries of the numbered operators, over whole tables; SQL where it can say
the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.llm import byte_bpe, collision_ann, decontaminate, html_extract, interpolated_lm, packing, sharding, simhash, spelling, token_files, toxicity, url_rules, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return token_files.token_file_digests(files)


def op2_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of texts encoded and decoded again."""
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", byte_bpe.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=40)


def op5_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score(table(spark, sf_dir, "documents"))


def op7_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return collision_ann.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op8_tree_model_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rules_table(spark))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), least_letters=7, omit_every=31)
    return spelling.group_variants(words, ratio=10, least_count=2)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)


def op13_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


QUERIES: dict[str, Query] = {
    "op1_simple8b_tokens": op1_simple8b_tokens,
    "op2_string_kernel_toxicity": op2_string_kernel_toxicity,
    "op3_segment_tree_bpe": op3_segment_tree_bpe,
    "op4_jump_shards": op4_jump_shards,
    "op5_simhash_near_duplicates": op5_simhash_near_duplicates,
    "op6_deleted_interpolation": op6_deleted_interpolation,
    "op7_collision_neighbours": op7_collision_neighbours,
    "op8_tree_model_extraction": op8_tree_model_extraction,
    "op9_fm_index_decontamination": op9_fm_index_decontamination,
    "op10_url_rules": op10_url_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_sum_of_squares_packing": op13_sum_of_squares_packing,
}

ORACLE: dict[str, str] = {
    "op9_fm_index_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM windows))
), hits AS (
  SELECT doc_id, i, n, item FROM places JOIN windows USING (n, phrase)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
), owned AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN owned USING (doc_id)
""",
    "op10_url_rules": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM rest
), parsed AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM cut
), rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN (
  SELECT q.host, q.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parsed) q
  JOIN rules r ON (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path)
  GROUP BY q.host, q.path
) b ON p.host = b.host AND p.path = b.path
""",
}
