"""Model answers: cached calls through a given client, parsing and sanitising.

No model is called here; the client is any picklable function from prompt to answer.
"""

from __future__ import annotations

import json
import queue
import re
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Item types of an answer.
TYPES = ("covered", "not_covered", "condition", "limit", "deadline", "obligation", "notification_duty", "claim_obligation", "definition", "admin")

_LISTS = ("supporting_clause_ids", "money_amounts", "deadlines", "conditions", "exclusion_scope")
_ITEM = "struct<item_type:string,module:string,headline:string,exact_quote:string,importance:string,theme:string," + ",".join(f"{c}:array<string>" for c in _LISTS) + ">"


def cache_key(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def _timed(client: Callable[[str], str], prompt: str, seconds: float | None) -> str:
    if seconds is None:
        return client(prompt)
    got: queue.SimpleQueue = queue.SimpleQueue()

    def call() -> None:
        try:
            got.put((client(prompt), None))
        except Exception as e:  # noqa: BLE001 - raised where the answer is awaited
            got.put((None, e))

    threading.Thread(target=call, daemon=True).start()
    try:
        answer, error = got.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no answer in {seconds} s") from None
    if error:
        raise error
    return answer


def call_model(windows: DataFrame, client: Callable[[str], str], cache: DataFrame | None = None, tries: int = 3, wait: float = 1.0, as_json: bool = False, again: Callable[[str], str | None] | None = None, timeout: float | None = None, calls: int | None = None) -> DataFrame:
    """(cache_key, answer, error) for (cache_key, prompt) rows: known answers from the cache,
    the others from the client. Errors are told, and asked again the next time.

    After an error of the client the next try waits (``wait`` seconds, doubled each time); with
    ``as_json`` an answer that is no JSON is an error too, which doesn't wait. ``again`` may look
    at an answer and give what to add to the prompt for another try. A call that takes longer
    than ``timeout`` seconds is an error; its thread is left to end by itself. At most ``calls``
    calls are under way at once."""
    keys = windows.select("cache_key", "prompt").dropDuplicates(["cache_key"])
    known = cache.where("error IS NULL").select("cache_key", "answer", "error") if cache is not None else None
    todo = keys.join(known, "cache_key", "left_anti") if known is not None else keys

    def ask(prompt: str) -> tuple[str | None, str | None]:
        answer, error, more = None, None, ""
        for i in range(tries):
            try:
                answer = _timed(client, prompt + more, timeout)
            except Exception as e:  # noqa: BLE001 - told in the row
                error = repr(e)
                if i + 1 < tries:
                    time.sleep(wait * 2**i)
                continue
            error = None
            try:
                if as_json:
                    json.loads(re.sub(r"^\s*```(?:json)?\s*|\s*```\s*$", "", answer or ""))
            except ValueError as e:
                answer, error = None, f"no JSON: {e}"
                continue
            asked = again(answer) if again else None
            if not asked:
                return answer, None
            more = f"\n\n{asked}"
        return (answer, None) if answer is not None else (None, error)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [ask(p) for p in b["prompt"]]
            yield pd.DataFrame({"cache_key": b["cache_key"], "answer": [a for a, _ in got], "error": [e for _, e in got]}, dtype=object)

    # a task asks one question after the other
    new = (todo.repartition(calls) if calls else todo).mapInPandas(run, "cache_key string, answer string, error string")
    return new if known is None else new.unionByName(known.join(keys, "cache_key", "left_semi"))


def parse_items(answer: Column) -> Column:
    """Items of an answer ({"items": [...]} or a list, with or without a code fence); empty if
    it can't be read."""
    x = F.regexp_replace(F.coalesce(answer, F.lit("")), r"^\s*```(?:json)?\s*|\s*```\s*$|^\s+", "")
    listed, held = F.from_json(x, f"array<{_ITEM}>"), F.from_json(x, f"struct<items:array<{_ITEM}>>")["items"]
    return F.coalesce(F.when(x.startswith("["), listed).otherwise(held), F.array().cast(f"array<{_ITEM}>"))


_GROUP = "struct<display_headline:string,item_type:string,module:string,theme:string,visual_priority:string,source_item_ids:array<string>,item_ids:array<string>>"


def answer_groups(answer: Column) -> Column:
    """The groups of a choosing answer; empty if there are none or it can't be read."""
    x = F.regexp_replace(F.coalesce(answer, F.lit("")), r"^\s*```(?:json)?\s*|\s*```\s*$|^\s+", "")
    held = F.from_json(x, f"struct<selected_groups:array<{_GROUP}>,selected_items:array<{_GROUP}>>")
    return F.coalesce(F.when(F.size(held["selected_groups"]) > 0, held["selected_groups"]), held["selected_items"], F.array().cast(f"array<{_GROUP}>"))


def group_rows(answers: DataFrame, keys: list[str], answer: str = "answer") -> DataFrame:
    """The groups of a choosing answer as ``completed`` takes them: group_index, item_ids and what
    a group says of itself; answers that can't be read give none."""
    rows = answers.select(*keys, F.posexplode(answer_groups(F.col(answer))).alias("group_index", "g")).where("g IS NOT NULL")
    ids = F.coalesce("g.source_item_ids", "g.item_ids", F.array().cast("array<string>"))
    return rows.select(*keys, "group_index", ids.alias("item_ids"), "g.display_headline", "g.item_type", "g.module", "g.theme", F.col("g.visual_priority").try_cast("int").alias("visual_priority"))


def with_extraction_ids(items: DataFrame, number: str) -> DataFrame:
    """extraction_id out of a running number from 0."""
    return items.withColumn("extraction_id", F.format_string("ext_%06d", F.col(number).cast("long")))


def item_rows(answers: DataFrame, keys: list[str], answer: str = "answer") -> DataFrame:
    """One row per item: unknown types are covered, a missing module is general, missing
    importance 3, missing lists empty; items whose importance is no integer are dropped."""
    rows = answers.select(*keys, F.posexplode(parse_items(F.col(answer))).alias("item_index", "i")).where("i IS NOT NULL")
    score = F.when(F.col("i.importance").isNull(), 3).otherwise(F.col("i.importance").try_cast("int"))
    lists = [F.coalesce(f"i.{c}", F.array().cast("array<string>")).alias(c) for c in _LISTS]
    text = [F.coalesce(f"i.{c}", F.lit("")).alias(c) for c in ("headline", "exact_quote", "theme")]
    kind = F.when(F.col("i.item_type").isin(*TYPES), F.col("i.item_type")).otherwise("covered").alias("item_type")
    return rows.select(*keys, "item_index", kind, F.coalesce("i.module", F.lit("general")).alias("module"), score.alias("importance"), *text, *lists).where("importance IS NOT NULL")
