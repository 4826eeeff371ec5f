"""The queries opN_<name>: each applies one operator to its whole table and
derives the columns of its contract; and the DuckDB SQL of those that have one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import centroids, decontaminate, exact_dedup, html, language, manifest, mixing, packing, private, quality, secrets, sharding, simhash
from tessera.llm.common import documents, scratch_path
from tessera.llm.oracles import ORACLES  # noqa: F401  the entry module takes them from here

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The key of op8's pseudonyms here; a real one comes from a secret store.
PSEUDONYM_KEY = "tessera-demonstration-key"


def op1_zstd_novelty_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = secrets.scan(docs, secrets.corpus_words(docs))
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    sha = F.sha2(F.encode(secrets.joined(base), "UTF-8"), 256)
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), sha.alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"), count("novel"))


def op2_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_blocks", "n_main")


def op3_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digest(packing.pack(documents(spark, sf_dir), TOKENIZER))


def op4_virtual_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(documents(spark, sf_dir), scratch_path(spark, "slot-map"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op5_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = language.identify(docs, language.fit(language.labelled_sample(docs)))
    return rows.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op7_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = private.pseudonymise(documents(spark, sf_dir), PSEUDONYM_KEY)
    return rows.select("doc_id", "text", F.size("finds").cast("long").alias("n_finds"), F.to_json("finds").alias("finds"))


def op9_digest_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with exact_dedup.DigestIndex.temporary(spark) as index:
        rows = exact_dedup.deduplicate_newest_first(documents(spark, sf_dir), index)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op10_ball_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(documents(spark, sf_dir), words=4, radius=2)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_hamerly_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = centroids.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.scan(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    sha = F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    rows = manifest.manifest(documents(spark, sf_dir), third)
    return rows.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_zstd_novelty_secrets,
        op2_crf_main_text,
        op3_bin_slack_packing,
        op4_virtual_slot_shards,
        op5_crf_language,
        op6_adaptive_quality,
        op7_pareto_mix,
        op8_feistel_pseudonyms,
        op9_digest_index_dedup,
        op10_ball_simhash,
        op11_hamerly_clusters,
        op12_suffix_array_decontamination,
        op13_merkle_manifest,
    )
}
