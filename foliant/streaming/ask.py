"""Questions to a model as a stream of small batches, and in rounds until answers will do.

A call costs time and money, so no answer is lost with a run and none is asked for twice: the
questions are a table of small files, a stream takes a file at a time and writes its answers
before it is committed, and a later run goes on where the last one ended.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.extraction import call_model
from foliant.sources.stages import Files

ANSWERS = "cache_key string, prompt string, answer string, error string"


def known_answers(spark: SparkSession, base: str) -> DataFrame:
    """(cache_key, prompt, answer) without an error of all folders below."""
    folders = Files(spark).glob(f"{base}/*/answers")
    df = spark.read.schema(ANSWERS).option("recursiveFileLookup", True).parquet(*folders) if folders else spark.createDataFrame([], ANSWERS)
    return df.where("error IS NULL").select("cache_key", "prompt", "answer")


def next_folder(spark: SparkSession, base: str, mark: str, again: bool = False) -> str:
    """The folder of questions under a fingerprint that was begun last or, with ``again``, a new
    one, whose questions are then asked but for those that ``known_answers`` holds."""
    n = len(Files(spark).glob(f"{base}/{mark}-*"))
    return f"{base}/{mark}-{n if again or not n else n - 1}"


def answers_of(spark: SparkSession, folder: str) -> DataFrame:
    """(cache_key, prompt, answer, error) that ``ask_in_batches`` has written so far."""
    if not Files(spark).exists(f"{folder}/answers"):
        return spark.createDataFrame([], ANSWERS)
    return spark.read.schema(ANSWERS).option("recursiveFileLookup", True).parquet(f"{folder}/answers")


def ask_in_batches(
    asked: DataFrame, client: Callable[[str], str], folder: str, *, known: DataFrame | None = None, rows: int = 256, calls: int = 8, progress: Callable[[int], None] | None = None, **options: object
) -> DataFrame:
    """(cache_key, prompt, answer, error) for the distinct keys of (cache_key, prompt).

    ``folder`` holds the questions (``rows`` a file at most), the answers of each batch and the
    stream's log. At most ``calls`` calls are under way at once. A run that ends in the middle
    is taken up by calling this again with the same folder: batches that were committed are not
    looked at, and the one that was not is asked only if its answers were not written whole.
    ``known`` answers (cache_key, prompt, answer) to the same prompts are taken over. ``progress`` is told the number of
    each batch that is written; other options are those of ``call_model``.
    """
    spark, files = asked.sparkSession, Files(asked.sparkSession)
    todo = f"{folder}/asked"
    if not files.exists(f"{todo}/_SUCCESS"):
        questions = asked.select("cache_key", "prompt").dropDuplicates(["cache_key"])
        if known is not None:
            same = ["cache_key", "prompt"]
            held = questions.join(known.select(*same, "answer").dropDuplicates(same), same)
            held.withColumn("error", F.lit(None).cast("string")).write.mode("overwrite").parquet(f"{folder}/answers/known")
            questions = questions.join(known.select(*same), same, "left_anti")
        questions.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(todo)

    def answer(batch: DataFrame, number: int) -> None:
        at = f"{folder}/answers/batch-{number}"
        if not files.exists(f"{at}/_SUCCESS"):
            got = call_model(batch, client, calls=calls, **options)
            batch.join(got, "cache_key").select("cache_key", "prompt", "answer", "error").write.mode("overwrite").parquet(at)
        if progress:
            progress(number)

    stream = spark.readStream.schema("cache_key string, prompt string").option("maxFilesPerTrigger", 1).parquet(todo)
    stream.writeStream.foreachBatch(answer).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return answers_of(spark, folder)


def ask_in_rounds(asked: DataFrame, ask: Callable[[DataFrame, int], DataFrame], feedback: Callable[[DataFrame], DataFrame], *, rounds: int = 3, wait: float = 1.0) -> DataFrame:
    """(cache_key, answer, error, round) of the last round in which each question was asked.

    ``ask`` takes (cache_key, prompt) and the round from 0 and gives a table that holds what was
    answered, so that no question is asked twice in a round. ``feedback`` gives (cache_key, more)
    for the answers that won't do. What is left of the questions after a round is asked again:
    after an error as it was, and else with its last answer and ``more`` behind it. After the
    last round answers are taken as they are. Rounds after an error wait, each twice as long.
    """
    todo, done = asked.select("cache_key", "prompt"), []
    for k in range(rounds):
        got = ask(todo, k)
        looked = got.join(feedback(got.where("error IS NULL").select("cache_key", "answer")), "cache_key", "left")
        open_ = F.lit(k + 1 < rounds) & (F.col("error").isNotNull() | F.col("more").isNotNull())
        done.append(looked.where(~open_).select("cache_key", "answer", "error", F.lit(k).alias("round")))
        left = looked.where(open_)
        todo = left.select("cache_key", F.when(F.col("error").isNotNull(), F.col("prompt")).otherwise(F.concat_ws("\n\n", "prompt", "answer", "more")).alias("prompt"))
        if k + 1 == rounds or todo.isEmpty():
            break
        if not left.where("error IS NOT NULL").isEmpty():
            time.sleep(wait * 2**k)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
