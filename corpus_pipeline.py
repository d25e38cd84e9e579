"""Training-corpus pipeline over ``documents``: STAGES in order, each written as Parquet and read again.

1. ``toxicity`` drops the documents that the toxicity model, trained on ``labels``, puts at TOXIC_FROM or more.
2. ``simhash`` keeps the document of smallest doc_id of each near-duplicate group.
3. ``substrings`` removes the words of repeated passages but for their first occurrence; other texts stay as they are.
4. ``secrets`` replaces secrets by their kind in brackets.
5. ``packing`` packs what is left into sequences; its rows are the pieces, each with its token ids (``ids``, little-endian
   32-bit integers): a sequence is its pieces' ids by ``offset``.

All stages but the last return the columns of ``documents``; n_chars follows the text where a stage changes it.
Null and empty texts pass through all stages (the packing gives each its end id); other columns of ``documents``
are left behind at the first stage that changes rows. A stage's files are removed once the next stage has written its own.
A document that a stage has nothing to say against stays. Rows without doc_id belong to no near-duplicate group
and stay; of several rows with one doc_id the second stage keeps one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postura.llm.common import DOCUMENT_COLUMNS, shared_folder, table
from postura.llm.packing import pack_documents
from postura.llm.queries import BYTE_VOCABULARY, END_ID, FINGERPRINT_BITS, REPEAT_WORDS, SEQUENCE_TOKENS, SHINGLE_WORDS, TOXIC_FROM
from postura.llm.secrets import redact, scan
from postura.llm.simhash import simhash_groups
from postura.llm.substrings import substring_dedup
from postura.llm.toxicity import fit_model, score
from postura.sources.files import Files

CARRY = ("text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = score(docs, fit_model(docs, table(spark, sf_dir, "labels")), CARRY).filter(F.col("score") < TOXIC_FROM)
    return scored.select("doc_id", *[F.col(f"doc_{c}").alias(c) for c in CARRY])


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash_groups(docs, SHINGLE_WORDS, FINGERPRINT_BITS)
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.select(*DOCUMENT_COLUMNS)
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text", "lang", "source", "n_chars")))
    one = kept.join(first, "doc_id", "left_semi").withColumn("_nth", nth).filter("_nth = 1").drop("_nth")
    return one.union(kept.filter("doc_id is null"))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substring_dedup(docs, REPEAT_WORDS, carry=CARRY)
    changed = F.col("n_removed") > 0
    return found.select(
        "doc_id",
        F.when(changed, F.col("kept")).otherwise(F.col("doc_text")).alias("text"),
        F.col("doc_lang").alias("lang"),
        F.col("doc_source").alias("source"),
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("doc_n_chars")).alias("n_chars"),
    )


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = scan(docs, carry=CARRY)
    clean = found.withColumn("clean", redact(F.col("text"), F.col("spans")))
    changed = F.size("spans") > 0
    return clean.select(
        "doc_id",
        F.when(changed, F.col("clean")).otherwise(F.col("doc_text")).alias("text"),
        F.col("doc_lang").alias("lang"),
        F.col("doc_source").alias("source"),
        F.when(changed, F.length("clean").cast("long")).otherwise(F.col("doc_n_chars")).alias("n_chars"),
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path(BYTE_VOCABULARY), END_ID, SEQUENCE_TOKENS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("simhash", simhash),
    ("substrings", substrings),
    ("secrets", secrets),
    ("packing", packing),
]
# fingerprints, trained scores and token ids have no SQL form
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            Files(spark, before).delete(before)
        before = path
    return docs
