"""The corpus pipeline: language ID, near-duplicates, repeated strings, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns they were given.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import removed, shared_folder, table, written
from foliant.llm.decontamination import find_contamination
from foliant.llm.language_id import identify_languages
from foliant.llm.near_dedup import near_duplicate_groups
from foliant.llm.packing import pack_documents
from foliant.llm.suffix_dedup import remove_repeats

#: Languages, tokens and copies have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents, each as one struct ``row`` whatever its columns are named, and n, a number
    of their own. They are written first: numbers made while reading could differ between two
    reads, or after a lost executor."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return written(rows.withColumn("n", F.monotonically_increasing_id()))


def _texts(numbered: DataFrame) -> DataFrame:
    return numbered.select(F.col("n").alias("doc_id"), F.col("row").getField("text").alias("text"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty texts too) or without a likely language go.
    Of equally likely languages the first by name counts; an empty table stays empty."""
    return identify_languages(docs).where(~F.col("rejected")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (five words, a similarity of 0.8 or more) the document of
    the smallest id stays. Repeated rows of
    that id are one document; a group without ids keeps one row. Documents without words are
    groups of their own."""
    numbered = _numbered(docs)
    # groups are found for rows, so that null and repeated ids can't be mistaken
    of_row = F.col("row").getField("doc_id")
    order = F.struct(of_row.isNull().alias("none"), of_row.alias("id"), "n")
    found = near_duplicate_groups(_texts(numbered), percent=80).select(F.col("doc_id").alias("n"), "component")
    first = numbered.select("n", order.alias("o")).join(found, "n").groupBy("component").agg(F.min("o").alias("o")).select("o.n")
    return numbered.join(first, "n", "left_semi").select("row.*")


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts: runs of more than 50 words (200 bytes at
    least, so a run of 51 words of two letters stays) or of 400 bytes. n_chars follows the text; null text stays null."""
    cut = remove_repeats(docs, passage=200, words=50)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts hold none;
    repeated rows go or stay together."""
    numbered = _numbered(docs)
    found = find_contamination(_texts(numbered), table(spark, sf_dir, "benchmark"))
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("n"))
    return numbered.join(hit, "n", "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens. A null or empty text is its end
    token alone; repeated rows and null ids are packed as documents of their own."""
    path = public_tokenizers.path
    return pack_documents(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder
    and read again, and goes when the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
