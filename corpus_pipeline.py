"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import decontam, exact, language, packing, simhash
from martloom.llm.components import components
from martloom.llm.queries import importable, table
from martloom.sources.staging import stage

MIN_COSINE = 0.05  # of random vectors in 1024 dimensions it is within 0.03 of zero for the most part


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` but for those whose id is in ``dropped``; rows without an id stay."""
    ids = dropped.select(F.col("doc_id").cast("long").alias("_dropped")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("_dropped"), "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the profiles know; no letters, or nothing like any profile, is out."""
    importable(spark)
    profiles = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs, profiles, id_col="doc_id")
    rejected = found.where((F.col("lang_pred") == language.UNKNOWN) | (F.col("score") < MIN_COSINE))
    return _without(docs, stage(rejected.select("doc_id"), "pipeline-language"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    found = exact.refine(docs)
    return _without(docs, stage(found.where(~F.col("kept")).select("doc_id"), "pipeline-exact"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays, one without an id if no other has any.

    Linked are SimHash fingerprints that differ in two bits at most, as in ``op10_simhash``, and documents whose
    sets of five-word shingles are similar by 0.8 or more. Every row takes part: one without an id is a document
    of its own, different texts under one id are too, and rows of equal id and text count as one.
    """
    importable(spark)
    # Numbered once and stored, as a second reading may number rows in another way.
    nameless = stage(docs.where("doc_id IS NULL").withColumn("_row", F.monotonically_increasing_id()), "pipeline-nameless")
    rows = docs.where("doc_id IS NOT NULL").withColumn("_row", F.col("doc_id").cast("long")).unionByName(nameless)
    keyed = rows.withColumn("_key", F.xxhash64(F.col("doc_id").isNull(), "_row", "text")).drop("_row")
    known = stage(keyed.select("_key", "doc_id").distinct(), "pipeline-keys")
    found = [simhash.near_duplicates(keyed, id_col="_key"), simhash.similar_documents(keyed, id_col="_key")]
    links = [f.select(F.col("doc_id").alias("u"), F.col("component_id").alias("v")) for f in found]
    groups = components(links[0].unionByName(links[1])).select(F.col("vertex").alias("_key"), "root")
    members = stage(known.join(groups, "_key"), "pipeline-near")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key"))["_key"].alias("first")
    copies = members.join(members.groupBy("root").agg(first), "root").where("_key <> first").select("_key")
    return keyed.join(stage(copies, "pipeline-copies"), "_key", "left_anti").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that cover half of a benchmark item or more."""
    found = decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, stage(found.where("contaminated").select("doc_id"), "pipeline-leaks"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with the sequence that each goes to."""
    importable(spark)
    return packing.pack(docs)


STAGES = [
    ("language identification", known_language),
    ("exact dedup", exact_copies),
    ("simhash near-dedup", near_copies),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
