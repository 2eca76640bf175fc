"""The registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, clustering, licenses, lm, mixing, negatives, packing, pii, quality, sharding, simhash, substrings, topk
from tidemark.llm.common import read_table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(function):
    LLM_QUERIES[function.__name__] = function
    return function


@register
def op1_perspective_rotation(spark, sf_dir):
    return chat.rotate(read_table(spark, sf_dir, "conversations"))


@register
def op2_best_fit_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"))


@register
def op3_stratified_shards(spark, sf_dir):
    rows = sharding.shard_documents(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op4_water_filling_mix(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    plan = mixing.plan_mixture(docs)
    rows = mixing.with_copies(docs, plan).select("doc.doc_id", mixing.word_count("doc.text").alias("size"), "copies", "source_size", "target")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register
def op5_disclosure_sanitiser(spark, sf_dir):
    rows = pii.report(read_table(spark, sf_dir, "documents"), everywhere=True)
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@register
def op6_template_automata(spark, sf_dir):
    return licenses.scan_documents(read_table(spark, sf_dir, "documents")).drop("matches")


@register
def op7_simhash_bit_sliced(spark, sf_dir):
    rows = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@register
def op8_super_kmers(spark, sf_dir):
    return substrings.report(read_table(spark, sf_dir, "documents"))


@register
def op9_rule_cascade(spark, sf_dir):
    rows = quality.judge_documents(read_table(spark, sf_dir, "documents"))
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    base_failed = (words < 50) | (100 * repeated > 50 * words)
    return rows.select("doc_id", *quality.COUNTS, base_failed.alias("base_failed"), "kept")


@register
def op10_threshold_top_k(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register
def op11_centroid_expressions(spark, sf_dir):
    rows = clustering.clusters(read_table(spark, sf_dir, "embeddings"))
    digits = F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string")))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(digits, 256).alias("centroid_sha256"))


@register
def op12_log_bilinear(spark, sf_dir):
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


@register
def op13_slot_negatives(spark, sf_dir):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=shifted)
