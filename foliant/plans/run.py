"""A whole run: layout JSON to clauses, windows, checked items, chosen entries and pages.

Every stage is a table of the run's folder, built where what it depends on has changed; a run
takes up where the last one ended. The clients are functions from prompt to answer; without one
that chooses, the ranked choice holds.
"""

from __future__ import annotations

import argparse
import importlib
import os
import re
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.choice import filtered_summary, prefiltered, run_cost, run_metadata, small_choices
from foliant.operators.chunk_clauses import chunk_clauses, marked
from foliant.operators.chunk_table import chunk_table, with_section_columns
from foliant.operators.clauses import context_windows, section_table
from foliant.operators.extraction import cache_key, group_rows, item_rows, with_extraction_ids
from foliant.operators.quotes import validate_items
from foliant.operators.numbering import numbered
from foliant.operators.prompts import compact_item, extraction_prompt, selection_prompt
from foliant.operators.selection import composite_score, polarity_override, section_score, specificity
from foliant.operators.summary import entries, relevant, summarise
from foliant.operators.tree import flatten_layout, run_log, useful_blocks
from foliant.plans.report import customer_pages, index_pages
from foliant.sources.stages import Stages, files_fingerprint, read_layout
from foliant.streaming.ask import ask_in_batches, ask_in_rounds, known_answers, next_folder

STAGES = ("layout", "chunks", "clauses", "windows", "items", "summary")
LINKS = 5000  # of an index page, about


def chunks_of(blocks: DataFrame) -> DataFrame:
    """Chunks of useful blocks with ids that run on over the documents."""
    rows = numbered(chunk_table(blocks), "doc_id", ["island"], "n")
    return with_section_columns(rows.withColumn("struct_chunk_id", F.format_string("%s_sc%06d", "doc_id", "n")).drop("n"))


def windows_of(clauses: DataFrame, most: int = 2500) -> DataFrame:
    """Windows of the marked clauses of every section, each with its id and prompt."""
    rows = clauses.withColumn("marked", F.when(F.trim(F.coalesce("clause_text", F.lit(""))) != "", marked(F.col("clause_id"), F.col("column_role"), F.col("category_hint"), F.col("clause_text"))))
    w = context_windows(rows, ["doc_id", "section_id"], ["clause_position", "page_start", "chunk_id", "clause_id"], "marked", most, id_col="clause_id")
    w = w.join(section_table(clauses).select("doc_id", "section_id", "section_path"), ["doc_id", "section_id"])
    w = w.withColumn("context_id", F.concat(F.col("doc_id"), F.lit("__"), "section_id", F.lit("__w"), "window_index"))
    w = w.withColumn("prompt", extraction_prompt(F.col("section_path"), F.col("context_text"), F.col("is_continuation")))
    return w.withColumn("cache_key", cache_key(F.col("prompt")))


def checked_items(answers: DataFrame, windows: DataFrame, clauses: DataFrame) -> DataFrame:
    """Items of the answers under their ids, with status, pages, corrected type and score."""
    keys = ["doc_id", "section_id", "window_index"]
    rows = item_rows(windows.select(*keys, "section_path", "cache_key").join(answers.select("cache_key", "answer"), "cache_key"), [*keys, "section_path"])
    rows = with_extraction_ids(numbered(rows, "doc_id", ["section_id", "window_index", "item_index"], "n"), "n").drop("n")
    of = clauses.select("doc_id", "section_id", "clause_id", "clause_text", "clause_position", "chunk_id", "page_start", "page_end", "bbox")
    rows = validate_items(rows, of, ["doc_id", "section_id"], order=["page_start", "clause_position", "chunk_id"])
    rows = polarity_override(rows, clauses, ["extraction_id"])
    money, terms = specificity(F.col("money_amounts"), F.col("deadlines"))
    score = composite_score(F.col("importance"), section_score(F.coalesce("section_path", F.lit(""))), F.col("item_type"), money, terms, F.col("validation_status"))
    return rows.withColumn("composite_score", score)


def shown_items(items: DataFrame) -> DataFrame:
    """The items of every document's summary, under their ids there."""
    return summarise(entries(relevant(items)), ["doc_id"], [F.desc("composite_score"), F.asc("extraction_id")])


def choice_questions(shown: DataFrame) -> DataFrame:
    """(doc_id, n_items, prompt, cache_key): what a choosing model is asked of each document."""
    few = prefiltered(shown, ["doc_id"])
    item = compact_item(*(F.col(c) for c in ("item_id", "bucket", "module", "item_type", "theme", "headline", "exact_quote", "importance")))
    asked = few.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list(item)).alias("i")).withColumn("prompt", selection_prompt(F.col("doc_id"), F.col("i")))
    return asked.drop("i").withColumn("cache_key", cache_key(F.col("prompt")))


def chosen_entries(shown: DataFrame, choices: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Entries of each document's summary and what the choice did, by the answers (doc_id,
    answer, error) of a model; without them, or where one failed, the ranked choice holds."""
    if choices is None:
        choices = shown.select("doc_id", F.lit(None).cast("string").alias("answer"), F.lit(None).cast("string").alias("error")).limit(0)
    groups = group_rows(choices.where("error IS NULL"), ["doc_id"])
    found = filtered_summary(groups, shown, ["doc_id"])
    did = run_metadata(found, groups, shown, ["doc_id"])
    return found, did.join(choices.select("doc_id", F.col("error").alias("llm_error")), "doc_id", "left")


def _told(client: Callable[[str], str] | None) -> str | None:
    """What stands for a client in a fingerprint."""
    return client and f"{getattr(client, '__module__', '')}:{getattr(client, '__qualname__', type(client).__qualname__)}"


def run(
    spark: SparkSession, layout: str, out: str, client: Callable[[str], str] | None, *, chooser: Callable[[str], str] | None = None, doc_ids: Iterable[str] | None = None, most_words: int = 2500, from_stage: str | None = None, model: str = "gpt-4o-mini",
    calls: int = 10, batch: int = 256, timeout: float | None = 180, rounds: int = 3, wait: float = 1.0, dry_run: bool = False, skip_html: bool = False, fail_on_error: bool = False, by_content: bool = False, progress: Callable[[int], None] | None = None,
) -> DataFrame:
    """Pages (doc_id, n_items, html) of a folder of layout JSON; with ``skip_html`` the summary;
    without a client, or with ``dry_run``, the windows and an estimate of what asking would cost.

    Tables are built where what they depend on has changed: the files (by name, length and time
    or, with ``by_content``, by content), the parameters, the client's name, the tables before;
    and from ``from_stage`` on in any case. Answers are kept: at most ``calls`` calls are under
    way, in batches of ``batch``, and a killed run asks only what it had not asked. Choosing
    answers with too few groups are asked again, ``rounds`` times in all.
    """
    if from_stage is not None and from_stage not in STAGES:
        raise ValueError(f"from_stage must be one of {STAGES}")
    again = lambda name: from_stage is not None and STAGES.index(name) >= STAGES.index(from_stage)
    started, s = time.time(), Stages(spark, out)
    doc_ids = None if doc_ids is None else sorted(set(doc_ids))
    given = {"layout": files_fingerprint(spark, layout, doc_ids=doc_ids, by_content=by_content), "doc_ids": doc_ids}

    def finished(windows: DataFrame, items: DataFrame | None, summary: DataFrame | None) -> None:
        statuses = {r.validation_status: r["count"] for r in items.groupBy("validation_status").count().collect()} if items is not None else {}
        counts = {f"n_{k}": df.count() if df is not None else 0 for k, df in (("windows", windows), ("extracted", items), ("summary_items", summary))}
        s.json("run", {"model": model, "doc_ids": doc_ids, **counts, "validation_stats": statuses, "elapsed_seconds": round(time.time() - started, 1), "dry_run": dry_run})

    blocks = s.table("blocks", lambda: flatten_layout(read_layout(spark, layout, doc_ids)), again("layout"), inputs=given)
    s.csv("run_log", run_log(blocks))
    chunk_rows = s.table("chunks", lambda: chunks_of(useful_blocks(blocks)), again("chunks"), after=["blocks"])
    clauses = s.table("clauses", lambda: chunk_clauses(chunk_rows), again("clauses"), after=["chunks"])
    s.table("sections", lambda: section_table(clauses), again("clauses"), after=["clauses"])
    windows = s.table("windows", lambda: windows_of(clauses, most_words), again("windows"), after=["clauses"], inputs={"most_words": most_words})
    s.csv("cost", run_cost(windows, "n_words", model))
    if client is None or dry_run:
        finished(windows, None, None)
        return windows

    options = {"rows": batch, "calls": calls, "timeout": timeout, "as_json": True, "wait": wait, "progress": progress}

    def asked(kind: str, questions: DataFrame, who: Callable[[str], str], mark: str, anew: bool, **more: object) -> DataFrame:
        base = f"{s.root}/asked/{re.sub(r'[^0-9A-Za-z.-]', '_', model)}/{kind}"
        known = known_answers(spark, base)
        return ask_in_batches(questions, who, next_folder(spark, base, mark, anew), known=known, **options | more)

    extracting = {"client": _told(client), "model": model}
    answers = s.table("answers", lambda: asked("extract", windows, client, s.fingerprint(extracting, ["windows"]), again("items")), again("items"), after=["windows"], inputs=extracting)
    s.documents("responses", windows.select("doc_id", "context_id", "cache_key").join(answers.drop("prompt"), "cache_key"))
    items = s.table("items", lambda: checked_items(answers, windows, clauses), again("items"), after=["answers", "windows", "clauses"])
    shown = s.table("shown", lambda: shown_items(items), again("summary"), after=["items"])
    choices = None
    if chooser:
        choosing = {"client": _told(chooser), "model": model, "rounds": rounds}
        mark = s.fingerprint(choosing, ["shown"])

        def build() -> DataFrame:
            questions = choice_questions(shown)
            ask = lambda todo, k: asked(f"choose-{k}", todo, chooser, mark, again("summary"), tries=1)
            got = ask_in_rounds(questions, ask, lambda got: small_choices(got, questions), rounds=rounds, wait=wait)
            return questions.select("doc_id", "cache_key").join(got, "cache_key")

        choices = s.table("choices", build, again("summary"), after=["shown"], inputs=choosing)
        s.documents("choice_responses", choices)
        failed = choices.where("error IS NOT NULL")
        if fail_on_error and not failed.isEmpty():
            raise RuntimeError(f"no choice for {failed.count()} documents, such as {failed.first().doc_id}: {failed.first().error}")
    after = ["shown", *(["choices"] if chooser else [])]
    found, did = chosen_entries(shown, choices)
    summary = s.table("summary", lambda: found, again("summary"), after=after)
    metadata = s.table("metadata", lambda: did, again("summary"), after=after)
    totals = metadata.agg(F.count(F.lit(1)).alias("n_docs"), *(F.sum(c).alias(c) for c in ("input_items", "filtered_items", "selected_source_items", "fallback_items", "minimum_items", "balance_items")), F.bround(F.avg("reduction_ratio"), 4).alias("avg_reduction_ratio"), F.sum(F.size("invalid_ids")).alias("invalid_ids"), F.count("llm_error").alias("llm_errors"))
    s.json("choice_run", totals.first().asDict())
    s.documents("summaries", summary)
    finished(windows, items, summary)
    if skip_html:
        return summary
    cards = summary.withColumns({"group": F.col("module"), "item_id": F.lpad(F.col("g").cast("string"), 4, "0")})
    pages = s.table("pages", lambda: customer_pages(cards), again("summary"), after=["summary"])
    s.texts("html", pages, "html")
    s.table("index", lambda: index_pages(pages, pages.count() // LINKS + 1), again("summary"), after=["pages"])
    return pages


def _named(name: str | None) -> Callable[[str], str] | None:
    """module:function as a function."""
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def read_env(path: str) -> dict[str, str]:
    """Names and values of a .env file, if there is one: NAME=value lines, quotes around values
    go, and so do comment lines and an ``export`` before the name."""
    if not os.path.isfile(path):
        return {}
    with open(path, encoding="utf-8") as f:
        found = [re.fullmatch(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*", x) for x in f if not x.lstrip().startswith("#")]
    return {m[1]: m[2][1:-1] if len(m[2]) > 1 and m[2][0] == m[2][-1] and m[2][0] in "\"'" else m[2] for m in found if m}


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="foliant", description="Layout JSON to pages of what a policy says.")
    p.add_argument("layout", help="folder of layout JSON")
    p.add_argument("out", help="folder of the run's tables")
    p.add_argument("--client", help="module:function from prompt to answer; without it the run ends with the windows")
    p.add_argument("--chooser", help="module:function that chooses items; without it the ranked choice holds")
    p.add_argument("--doc-ids", nargs="+")
    p.add_argument("--all", action="store_true", help="all documents of the folder")
    p.add_argument("--max-words", type=int, default=2500)
    p.add_argument("--max-concurrent", type=int, default=10, help="calls under way at once")
    p.add_argument("--from-stage", choices=STAGES, help="build anew from here on, whatever has changed")
    p.add_argument("--model", default="gpt-4o-mini", help="name whose prices the estimate takes")
    p.add_argument("--skip-llm", action="store_true", help="end with the windows")
    p.add_argument("--skip-html", action="store_true", help="end with the summary")
    p.add_argument("--dry-run", action="store_true", help="end with the windows and an estimate")
    p.add_argument("--fail-on-error", action="store_true", help="fail if a document's choice does")
    p.add_argument("--env-file", default=".env", help="names and values for the clients, where the environment has none")
    a = p.parse_args(args)
    if not a.doc_ids and not a.all:
        p.error("name documents by --doc-ids or take --all")
    builder = SparkSession.builder.appName("foliant")
    for name, value in read_env(a.env_file).items():
        builder = builder.config(f"spark.executorEnv.{name}", os.environ.setdefault(name, value))
    client = None if a.skip_llm else _named(a.client)
    run(builder.getOrCreate(), a.layout, a.out, client, chooser=_named(a.chooser), doc_ids=None if a.all else a.doc_ids, most_words=a.max_words, from_stage=a.from_stage, model=a.model, calls=a.max_concurrent, dry_run=a.dry_run, skip_html=a.skip_html, fail_on_error=a.fail_on_error)
