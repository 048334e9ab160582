"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, decontam, exact, language, packing, pii, quality, repair, shards, simhash, substring, suffix, trie

Query = Callable[[SparkSession, str], DataFrame]


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where it lies, as if it were installed."""
    root, known = str(Path(__file__).parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [root, known.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, text), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, profiles)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.refine(table(spark, sf_dir, "documents"), hash_all=True)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    lost = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", lost.alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law that holds is ``bytes``; growing by a shard moves rows between all, so it is not offered."""
    found = shards.kd_shards(table(spark, sf_dir, "documents"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ensemble = quality.learn(docs, labels, ~language.held_out(F.col("doc_id")))
    found = quality.score(docs, ensemble)
    held = language.held_out(F.col("doc_id")).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, sizes = trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.with_lent_starts(turns, sizes), sizes.select("conv_id"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
