"""The registered queries ``opN_<name>`` of the training-data operators: each applies its
operator with production parameters to the whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (byte_bpe, centroid_search, chat_repair, hard_negatives, host_rules, kernel_toxicity, license_scan, order_minhash,
                            prob_minhash, pu_quality, recompression, suffix_decontamination, token_counts)
from ledgerline.llm.common import sha, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs, license_scan.train(docs)).select(
        "doc_id", "n_paragraphs", "n_licensed", F.concat_ws(",", "families").alias("families"), F.round("best", 6).alias("best"),
        "n_units", "n_unconfirmed", F.round("highest", 6).alias("highest"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_sensitivity(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    return byte_bpe.decode(ids, path).select(
        "doc_id", byte_bpe.n_ids("ids").alias("n_tokens"), sha("ids").alias("ids_sha256"), sha("decoded").alias("decoded_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", sha("kept_text").alias("kept_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > 1024).alias("over_limit"))


def op6_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


#: A document whose score reaches this is predicted 1.
PREDICTED_FROM = 0.7


def _fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string")) % folds


def _predicted(scored: DataFrame, held_out) -> DataFrame:
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))


def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    positives = table(spark, sf_dir, "labels").filter((F.col("quality") == 1) & (_fold(4) != 2)).select("doc_id")
    return _predicted(pu_quality.score(docs, pu_quality.train(docs, positives)), _fold(4) == 2)


def toxicity_machine(spark: SparkSession, docs: DataFrame, sf_dir: str) -> kernel_toxicity.Machine:
    return kernel_toxicity.train(docs, table(spark, sf_dir, "labels").filter(_fold(3) != 1))


def op8_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _predicted(kernel_toxicity.score(docs, toxicity_machine(spark, docs, sf_dir)), _fold(3) == 1)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_decontamination.find_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        sha(F.concat_ws(",", "items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prob_minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_centroid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_search.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, seed="2:").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.concat_ws(",", "failed").alias("failed"), F.concat_ws(",", "host_failed").alias("host_failed"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_order_minhash": op2_order_minhash,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_chat_repair": op6_chat_repair,
    "op7_pu_quality": op7_pu_quality,
    "op8_kernel_toxicity": op8_kernel_toxicity,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_centroid_search": op11_centroid_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_host_rules": op13_host_rules,
}

_SPLIT = "regexp_extract_all({text}, '{pattern}')"
_WORDS = _SPLIT.format(text="coalesce(text, '')", pattern=r"[^\x20\x09-\x0D]+")
_TERMS = _SPLIT.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
                       pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_WHOLE = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"
_SOUND = "embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"


def _clustering(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Rounds of nearest centroids and floored means, one CTE each."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (SELECT vec_id, v, min(struct_pack(d := list_sum(list_transform(range(1, {dim + 1}), lambda j: (v[j] - w[j]) * (v[j] - w[j]))), c := c)) AS best
          FROM x, c{r} GROUP BY vec_id, v)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT best.c AS c, j, sum(v[j]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, {dim + 1})) AS j) GROUP BY best.c, j)""")
            steps.append(f"""f{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS w FROM m{r} GROUP BY c)""")
            steps.append(f"""c{r + 1} AS (SELECT o.c, coalesce(f.w, o.w) AS w FROM c{r} o LEFT JOIN f{r} f ON f.c = o.c)""")
    return f"""
WITH x AS (SELECT vec_id, {_WHOLE} AS v FROM embeddings WHERE {_SOUND} AND len(embedding) = {dim}),
     c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS w FROM (SELECT v, sha256('2:' || vec_id) AS h FROM x ORDER BY h LIMIT {k})),
     {""",
     """.join(steps)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = best.c"""


def _host_rule_sql() -> str:
    fails = {"few_words": "n_words < 50", "repeated_words": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
             "copied_lines": "10 * n_dup_lines > 3 * n_lines", "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words"}
    low, high, limit = host_rules.LEAST_WEIGHT, host_rules.MOST_WEIGHT, host_rules.HOST_LIMIT
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
     windows AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
     again AS (SELECT r, i FROM windows WHERE true QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
     repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(0, 3)) AS k) GROUP BY r),
     lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
               FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
     m AS (SELECT d.r, doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                  length(text) - length(translate(text, '{host_rules.SYMBOLS}', '')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
                  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
           FROM d LEFT JOIN repeated ON repeated.r = d.r LEFT JOIN lines ON lines.r = d.r),
     ruled AS (SELECT *, unnest([{", ".join(f"struct_pack(rule := '{n}', place := {k}, fails := {sql})" for k, (n, sql) in enumerate(fails.items()))}], recursive := true) FROM m),
     hosts AS (SELECT source, rule, place, count(*) AS n, sum(CAST(fails AS INTEGER)) AS f FROM ruled WHERE source IS NOT NULL GROUP BY ALL),
     moments AS (SELECT rule, count(*) AS k, avg(f / n) AS mean, var_pop(f / n) AS spread, (count(*) - 1) / count(*) * sum(1 / n) / count(*) AS noise,
                        (count(*) - 1) / count(*) AS whole FROM hosts GROUP BY rule),
     prior AS (SELECT rule, mean, CASE WHEN k > 1 AND mean > 0 AND mean < 1 AND whole > noise AND spread / (mean * (1 - mean)) > noise
                      THEN least(greatest((whole - noise) / (spread / (mean * (1 - mean)) - noise) - 1, {low}), {high}) ELSE {high} END AS weight FROM moments),
     verdicts AS (SELECT source, string_agg(rule, ',' ORDER BY place) AS host_failed FROM hosts JOIN prior USING (rule)
                  WHERE round((f + mean * weight) / (n + weight), 9) >= {limit} GROUP BY source),
     own AS (SELECT r, string_agg(rule, ',' ORDER BY place) FILTER (fails) AS failed, bool_or(fails AND place < 2) AS base_failed FROM ruled GROUP BY r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND host_failed IS NULL AS kept, coalesce(failed, '') AS failed, coalesce(host_failed, '') AS host_failed
FROM m JOIN own ON own.r = m.r LEFT JOIN verdicts v ON v.source = m.source"""


#: DuckDB SQL where SQL can express the operator over whole tables.
ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d),
     windows AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS nth FROM starts),
     gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows, (SELECT unnest(range(0, 20)) AS k) o WHERE nth > 1),
     words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
     kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS text, count(*) AS n
              FROM words x ANTI JOIN gone g ON g.doc_id = x.doc_id AND g.i = x.i GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op9_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_TERMS} AS w FROM benchmark),
     starts AS (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
     items AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM starts),
     grams AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
               FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM items) s)),
     found AS (SELECT g.doc_id, g.i, g.size, t.item_id FROM grams g JOIN items t ON t.size = g.size AND t.gram = g.gram),
     hit AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM found) GROUP BY doc_id),
     named AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN named ON named.doc_id = d.doc_id""",
    "op11_centroid_search": _clustering(),
    "op12_hard_negatives": f"""
WITH x AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, CAST({_WHOLE} AS DOUBLE[]) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_SOUND}),
     scored AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
                FROM x a JOIN x r ON r.vec_id <> a.vec_id AND len(r.v) = len(a.v) WHERE a.vec_id % 100 = 0),
     positive AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
                  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5""",
    "op13_host_rules": _host_rule_sql(),
}
