"""From raw documents to token ids, in five stages.

Each stage reads what the one before it kept; the driver writes and rereads the
documents between stages, and so does ``run``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strataloom.llm import language, leaks, pieces, secrets, shingle_links
from strataloom.llm.workload import PIECES, RANKS
from strataloom.session import materialise
from strataloom.sources import lake

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and longer ones in none of the learned languages.

    If no document to learn from has a language, all with letters stay.
    """
    docs = docs.select(*COLUMNS)
    learned = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    # Any profile tells texts with letters from those without.
    found = language.predict(docs, learned or {"any": [1.0] * language.DIMENSIONS})
    stays = language.accepted(F.col("text"), F.col("lang_pred"), F.col("score")) if learned else F.col("lang_pred") != language.UNKNOWN
    return found.where(stays).select(*COLUMNS)


def keep_one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the least id.

    Where that id is repeated with several texts of the group, one of them stays, and
    rows that repeat an id and its text are one document.
    """
    docs = docs.select(*COLUMNS)
    found = shingle_links.join(docs).where("kept")
    # Per id its rows, and the one set of each class that stays.
    classes = found.groupBy("doc_id", "root").agg(F.count("*").alias("rows"), F.min("set").alias("set"))
    kept = materialise(classes.groupBy("doc_id").agg(F.sum("rows").alias("rows"), F.collect_set("set").alias("sets")), "kept")
    # The ids grow with the documents: shuffled at every size, never broadcast.
    ids = kept.select(F.col("doc_id").alias("_kept"), "rows").hint("merge")
    stays = docs.join(ids.drop("rows"), F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi").select(*COLUMNS)
    again = kept.where("rows > 1")
    if not again.take(1):
        return stays
    several = again.select(F.col("doc_id").alias("_kept"), "sets").hint("merge")
    once = stays.join(several, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_anti")
    more = shingle_links.sketched(stays.join(several, F.col("doc_id").eqNullSafe(F.col("_kept"))), "text")
    more = more.where("set IS NULL OR array_contains(sets, set)")
    more = more.withColumn("_same", F.coalesce(F.hex("set"), F.col("text"))).dropDuplicates(["doc_id", "_same"])
    return once.select(*COLUMNS).unionByName(more.select(*COLUMNS))


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain an item of the benchmark."""
    found = leaks.find(docs.select(*COLUMNS), lake.read_table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts and counts the characters anew."""
    found = secrets.find(docs.select(*COLUMNS), RANKS, public_tokenizers.PATTERN, clean="_clean")
    return found.select("doc_id", F.col("_clean").alias("text"), "lang", "source").withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, with an end id, and whether they decode to it."""
    coded = pieces.encode(docs.select(*COLUMNS), PIECES, decoded="decoded")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language", identify_language),
    ("near copies", keep_one_of_a_kind),
    ("leaks", remove_leaks),
    ("secrets", redact_secrets),
    ("pieces", encode_pieces),
]

# The stages' methods (profiles, sampled paths, sketches, tokenizers) cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
