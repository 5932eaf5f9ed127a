"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import byte_bpe, decontaminate, dialogue_repair, exact_dedup, html_text, kd_shard, near_dedup, pack, pivot_codes, quality, \
    secret_scan, sql, substring_dedup, url_reputation
from .common import table

# Fixed values of the URL rules.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.lru_cache(1)
def byte_level_definition() -> str:
    import public_tokenizers
    return byte_bpe.definition(byte_bpe.read_ranks(tokenizer_path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def op1_kd_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shard.kd_shards(table(spark, sf_dir, "documents"), ["source", "lang", "n_chars"], shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op3_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    judged = url_reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_block_rule_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


def op10_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_suffix_dawg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.repair(dialogue_repair.damage(table(spark, sf_dir, "conversations")), times_col="times")


def op12_laesa_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = pivot_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = books.digest() if books else hashlib.sha256().hexdigest()
    return coded.select("vec_id", pivot_codes.hex_codes().alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), byte_level_definition(), round_trip=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "split_tokens")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kd_shard": op1_kd_shard,
    "op2_nbsvm_quality": op2_nbsvm_quality,
    "op3_bayes_minhash": op3_bayes_minhash,
    "op4_url_reputation": op4_url_reputation,
    "op5_secret_ownership": op5_secret_ownership,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_nnls_packing": op7_nnls_packing,
    "op8_block_rule_html": op8_block_rule_html,
    "op9_suffix_array_decontamination": op9_suffix_array_decontamination,
    "op10_difference_cover": op10_difference_cover,
    "op11_suffix_dawg_repair": op11_suffix_dawg_repair,
    "op12_laesa_codes": op12_laesa_codes,
    "op13_byte_bpe": op13_byte_bpe,
}

_LOWER = "translate(coalesce({x}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Beta-binomial shrinkage of one level: {a} has n, bad and the parent's mean m.
_STRENGTH = """(SELECT CASE WHEN coalesce(seen, 0) = 0 OR seen <= noise OR most <= noise THEN cap
                             ELSE least(cap, greatest(1.0, (most - noise) / (seen - noise) - 1)) END
                FROM (SELECT sum(n * pow(bad / n - m, 2)) AS seen, sum(m * (1 - m)) AS noise, sum(n * m * (1 - m)) AS most,
                             least(1000.0, greatest(1.0, coalesce(sum(n), 0))) AS cap FROM {a} WHERE n > 0))"""

ORACLE: dict[str, str] = {
    "op4_url_reputation": f"""
        WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        raw AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
        part AS (SELECT page_id, {_LOWER.format(x="h")} AS host, regexp_extract(substring(rest, length(h) + 1), '^[^?#]*') AS path FROM raw),
        ruled AS (SELECT *, CASE
            WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM part),
        seen AS (SELECT host, coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS b, l.doc_id IS NOT NULL AS known
                 FROM part LEFT JOIN labels l ON l.doc_id = page_id),
        cuts AS (SELECT *, string_split(host, '.') AS ls, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS two FROM seen),
        hosts AS (SELECT host, any_value(CASE WHEN two IN {url_reputation.SUFFIXES} THEN array_to_string(list_slice(ls, -3, -1), '.') ELSE two END) AS domain,
                         any_value(CASE WHEN two IN {url_reputation.SUFFIXES} THEN two ELSE ls[-1] END) AS suffix, count(*) FILTER (known) AS n,
                         CAST(coalesce(sum(b::INT) FILTER (known), 0) AS DOUBLE) AS bad FROM cuts GROUP BY host),
        s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad,
                      (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) FROM hosts) AS m FROM hosts GROUP BY suffix),
        s1 AS (SELECT suffix, (bad + k * m) / (n + k) AS mean FROM s0, (SELECT {_STRENGTH.format(a="s0")} AS k)),
        d0 AS (SELECT domain, any_value(h.suffix) AS suffix, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS m
               FROM hosts h JOIN s1 ON s1.suffix = h.suffix GROUP BY domain),
        d1 AS (SELECT domain, (bad + k * m) / (n + k) AS mean FROM d0, (SELECT {_STRENGTH.format(a="d0")} AS k)),
        h0 AS (SELECT host, n, bad, mean AS m FROM hosts h JOIN d1 ON d1.domain = h.domain),
        h1 AS (SELECT host, bad + k * m AS a, n - bad + k * (1 - m) AS b FROM h0, (SELECT {_STRENGTH.format(a="h0")} AS k)),
        h2 AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower FROM h1)
        SELECT page_id, r.host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                    WHEN lower > 0.35 THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled r JOIN h2 ON h2.host = r.host""",
    "op6_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_LOWER.format(x="text")} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op9_suffix_array_decontamination": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format(x="text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER.format(x="text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
        t AS (SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[i:i + 9], ' ') AS g
              FROM (SELECT *, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM b WHERE len(ws) > 0)),
        v AS (SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS g
              FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM t))),
        hit AS (SELECT doc_id, v.size, i, item_id FROM v JOIN t ON t.g = v.g AND t.size = v.size),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
        SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op10_difference_cover": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        v AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
              FROM (SELECT *, unnest(range(1, len(ws) - 11)) AS i FROM d)),
        f AS (SELECT g, min(doc_id) AS first FROM v GROUP BY g),
        gone AS (SELECT DISTINCT doc_id, p FROM (
            SELECT doc_id, unnest(range(i, i + 13)) AS p FROM v JOIN f ON f.g = v.g WHERE first < doc_id)),
        w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
        k AS (SELECT w.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY w.p) FILTER (gone.p IS NULL) AS kept
              FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.p = w.p GROUP BY w.doc_id)
        SELECT d.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
    "op11_suffix_dawg_repair": sql.repair_sql(),
    "op12_laesa_codes": sql.codes_sql(),
}
