"""The corpus pipeline: toxicity, near-duplicates, substring repeats, benchmark leaks, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the rows it keeps
with the columns of ``documents``, the last one the encoded documents. Each stage's rows are
written as Parquet to the shared folder and read again by the next, so a lost executor
costs at most the stage it was in. What a stage does with null or empty texts, repeated rows
and empty tables is what its operator documents; no stage drops a row for any of these.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, kernel_toxicity, prob_minhash, recompression, suffix_decontamination
from ledgerline.llm.common import release, sha, table, written
from ledgerline.llm.queries import PREDICTED_FROM, toxicity_machine


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine, trained on ``labels``, does not predict toxic."""
    scored = kernel_toxicity.score(docs, toxicity_machine(spark, docs, sf_dir), out="toxicity_score")
    return scored.filter(F.col("toxicity_score") < PREDICTED_FROM).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each near-duplicate class."""
    return prob_minhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that start earlier; a document without such words keeps its text as it is."""
    found = recompression.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return found.select(*(text.alias("text") if c == "text" else F.length(text).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark stands."""
    return suffix_decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids (little-endian unsigned 32-bit), their number, and digests of them and of the decoded text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(docs.select("doc_id", "text", "lang", "source"), path).drop("text")
    return byte_bpe.decode(ids, path).select("doc_id", "lang", "source", byte_bpe.n_ids("ids").alias("n_tokens"), "ids",
                                             sha("ids").alias("ids_sha256"), sha("decoded").alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe_tokens),
]

#: Learned scores and hashing rounds have no SQL form; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; returns the last one's rows."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, *([before] if before is not None else []))
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
