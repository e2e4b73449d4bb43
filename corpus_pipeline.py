"""The corpus pipeline: five stages over ``documents``, each written and read again.

Toxic documents go, one document of each group of near copies stays, documents
that hold a benchmark item go, secrets are blotted out of the rest, and what is left
is packed into windows. Every stage works on all rows its predecessor kept; all
but the last return the columns of ``documents``, whatever further ones there are.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import decontamination, ngram_join, packing, secret_scan, toxicity, words
from tallyworks.llm.queries import vocabulary
from tallyworks.operators import aggregates, joins
from tallyworks.session import new_shared_folder, passing_pins, pin, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage with its texts going to Python workers in small batches.

    Executors live on through all stages, so what one takes at most adds to what those
    before it left behind.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        return stage(spark, small_batches(docs), folder)

    return run


@in_small_batches
def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score is below one half. Null and empty texts stay."""
    lexicon = toxicity.learn(docs, words.read(spark, folder, "labels"))
    score = words.unused("score")
    scored = docs.withColumn(score, toxicity.toxicity(words.text_or_empty("text"), lexicon))
    return scored.where(scored[score] < 0.5).drop(score)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a key of their own: rows that differ in id or text differ in it."""
    key = words.unused("key")
    return docs.withColumn(key, F.xxhash64("doc_id", F.col("text").isNull(), "text")), key


@in_small_batches
def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays.

    Rows without id and texts without a word are in no group and stay. Rows that share an
    id are judged each by its own text; of rows with the same id and text one stays.
    """
    rows, key = keyed(docs)
    named = rows.where("doc_id IS NOT NULL").select(F.col(key).alias("doc_id"), "text", F.col("doc_id").alias("id"))
    grouped = ngram_join.similarity_join(named).where("n_shingles > 0")
    # Rows with a copy or a link are those of groups of more than one row, far fewer than all.
    # Told row by row: a group, however large, need not meet.
    grouped = grouped.where("n_copies > 1 OR n_connecting > 0")
    members = pin(grouped.groupBy("doc_id").agg(F.min("component_id").alias("group"), F.count("*").alias("rows")))
    ids = named.select("doc_id", "id").distinct()
    first = members.join(ids, "doc_id").groupBy("group").agg(F.min(F.struct("id", "doc_id"))["doc_id"].alias("doc_id"))
    first = pin(first.select("doc_id"))
    again = members.where("rows > 1").join(first, "doc_id", "left_semi").select("doc_id")
    goes = members.join(first, "doc_id", "left_anti").select("doc_id").unionByName(again)
    goes = pin(goes.withColumnRenamed("doc_id", key))
    # Rows without id have keys, but those of no member. Only rows that may go are shuffled
    # with their texts.
    suspected, stays = joins.sifted(rows, key, goes)
    kept = stays.unionByName(suspected.join(goes, key, "left_anti"))
    repeated = suspected.join(again.withColumnRenamed("doc_id", key), key, "left_semi")
    return kept.unionByName(aggregates.one_per_key(repeated, [key])).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no item of the benchmark, each judged by its own text."""
    rows, key = keyed(docs)
    found = decontamination.contaminated(
        rows.select(F.col(key).alias("doc_id"), "text"), words.read(spark, folder, "benchmark")
    )
    # Written, so that the planner knows how small it is.
    leaks = pin(found.select(F.col("doc_id").alias(key)).distinct())
    return rows.join(leaks, key, "left_anti").select(*docs.columns)


@in_small_batches
def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, every secret in them replaced by a mark, ``n_chars`` counted anew."""
    crf = secret_scan.learn(docs)
    found = words.unused("spans")
    scanned = docs.withColumn(found, secret_scan.spans(words.text_or_empty("text"), crf))
    changed = scanned.withColumn(
        "text", F.when(F.size(found) > 0, secret_scan.redacted(F.col("text"), F.col(found))).otherwise(F.col("text"))
    )
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.size(found) > 0, length).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens, with a checksum of their ids."""
    pieces = packing.pack_documents(docs, vocabulary("byte_bpe_50k.tiktoken"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("ngram_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("packing", packed),
]
#: SQL cannot state the stages; the tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The last stage's rows; every stage's result is written to the shared folder.

    What a stage wrote on the way is deleted when its result is there.
    """
    docs = words.read(spark, folder, "documents")
    for name, stage in STAGES:
        path = new_shared_folder(spark, f"corpus-{name}")
        with passing_pins(spark):
            stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
