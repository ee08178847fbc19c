"""Clauses, sections and context windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import clean_clause, merge_dependent, sentences, strip, word_count
from foliant.operators.chunk_clauses import marked
from foliant.operators.scan import numbered_in, windows_of
from foliant.sources.shared import durable


def split_clauses(df: DataFrame, text_col: str, keys: list[str], prefixes: tuple[str, ...] = ()) -> DataFrame:
    """One row per clause of each line; line and clause numbers are kept when clauses are
    skipped (empty ones and bare numbers), so ids have gaps."""
    lines = df.select(*keys, F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("line", "raw"))
    parts = lines.select(*keys, "line", F.posexplode(merge_dependent(sentences(clean_clause(F.col("raw"))), prefixes)).alias("pos", "clause"))
    return parts.where((F.col("clause") != "") & ~F.col("clause").rlike(r"^\d+[.:]?$"))


def section_rollup(clauses: DataFrame, keys: list[str], order: list[str], preview: int = 6) -> DataFrame:
    """Counts, ordered ids and a preview of each section's clauses."""
    c = F.array_sort(F.collect_list(F.struct(*order, "clause")))
    return clauses.groupBy(*keys).agg(F.count(F.lit(1)).alias("clause_count"), c.alias("c")).select(
        *keys, "clause_count", F.array_join(F.slice(F.filter(F.col("c.clause"), lambda x: F.trim(x) != ""), 1, preview), " ").alias("preview")
    )


def _first_filled(values: Column) -> Column:
    return F.coalesce(F.get(F.filter(F.transform(values, lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != ""), F.lit(0)), F.lit(""))


def section_table(clauses: DataFrame, preview: int = 6) -> DataFrame:
    """One row per (doc_id, section_id) of clauses: the first path and title that say
    something, pages, a preview, ordered ids of chunks and clauses without repeats, counts."""
    c = F.array_sort(F.collect_list(F.struct("page_start", "clause_position", "chunk_id", "clause_id", "section_path", "title_text", "clause_text")))
    s = clauses.groupBy("doc_id", "section_id").agg(c.alias("c"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.count(F.lit(1)).alias("clause_count"))
    distinct = lambda x: F.array_distinct(F.filter(x, lambda y: y != ""))
    texts = F.filter(F.transform("c.clause_text", lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != "")
    s = s.withColumns({"chunk_ids": distinct(F.col("c.chunk_id")), "clause_ids": distinct(F.col("c.clause_id"))})
    return s.select(
        "doc_id", "section_id", _first_filled(F.col("c.section_path")).alias("section_path"), _first_filled(F.col("c.title_text")).alias("title_text"), "page_start", "page_end",
        F.array_join(F.slice(texts, 1, preview), " ").alias("preview"), "chunk_ids", "clause_ids", "clause_count", F.size("chunk_ids").cast("long").alias("chunk_count"),
    )


def section_texts(clauses: DataFrame) -> DataFrame:
    """Plain and marked text of each (doc_id, section_id), clauses by their position and then by
    page, chunk and id, blank ones left out; n_words of the plain text."""
    rows = clauses.where(strip(F.coalesce("clause_text", F.lit(""))) != "")
    mark = marked(F.col("clause_id"), F.col("column_role"), F.col("category_hint"), F.col("clause_text"))
    c = F.array_sort(F.collect_list(F.struct("clause_position", "page_start", "chunk_id", "clause_id", strip(F.col("clause_text")).alias("t"), mark.alias("m"))))
    s = rows.groupBy("doc_id", "section_id").agg(c.alias("c"))
    return s.select("doc_id", "section_id", F.array_join("c.t", "\n\n").alias("section_text"), F.array_join("c.m", "\n\n").alias("marked_text")).withColumn("n_words", word_count(F.col("section_text")))


def sections_with_text(sections: DataFrame, texts: DataFrame) -> DataFrame:
    """Sections with their texts; the columns that come from the texts replace older ones."""
    keys = ["doc_id", "section_id"]
    return sections.drop(*(c for c in texts.columns if c not in keys)).join(texts, keys, "left")


def window_bounds(words: Column, most: int, overlap: int) -> Column:
    """(start, end) of greedy windows over clause word counts: a window grows while it holds
    at most ``most`` words (one clause at least); the next starts ``overlap`` clauses before
    its end, also after the last clause is reached; at most 201 windows."""
    n = F.size(words)
    end = lambda s: F.aggregate(
        F.slice(words, s + 1, most + 1),  # every clause has a word
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("k"), F.lit(True).alias("open")),
        lambda a, x: F.when(a["open"] & ((a["sum"] + x <= most) | (a["k"] == 0)), F.struct((a["sum"] + x).cast("int").alias("sum"), (a["k"] + 1).alias("k"), F.lit(True).alias("open"))).otherwise(F.struct(a["sum"].alias("sum"), a["k"].alias("k"), F.lit(False).alias("open"))),
        lambda a: s + a["k"],
    )
    # only the starts that a window has are looked at: 201 at most
    at = lambda done: F.coalesce(F.try_element_at(done, F.lit(-1))["next"], F.lit(0))
    window = lambda s: F.transform(F.array(F.struct(s.alias("s"), end(s).alias("e"))), lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), F.greatest(x["s"] + 1, x["e"] - overlap).alias("next")))
    step = lambda done, _: F.when(at(done) >= n, done).otherwise(F.concat(done, window(at(done))))
    empty = F.array().cast("array<struct<start: int, end: int, next: int>>")
    many = F.aggregate(F.sequence(F.lit(1), F.least(n, F.lit(201))), empty, step)
    whole = F.array(F.struct(F.lit(0).alias("start"), n.alias("end"), n.alias("next")))
    total = F.aggregate(words, F.lit(0), lambda a, x: (a + x).cast("int"))
    return F.when(n == 0, empty).when(total <= most, whole).otherwise(many)


def context_windows(clauses: DataFrame, keys: list[str], order: list[str], text_col: str, most: int = 2500, overlap: int = 2, id_col: str | None = None) -> DataFrame:
    """One row per window: its index, clause range, words and text (clauses by blank lines);
    with ``id_col`` also clause_ids, the ids of its clauses."""
    c = F.array_sort(F.collect_list(F.struct(*order, F.col(text_col).alias("t"), F.col(id_col or text_col).alias("id"))))
    doc = clauses.where(F.trim(F.coalesce(text_col, F.lit(""))) != "").groupBy(*keys).agg(c.alias("c"))
    doc = doc.select(*keys, F.col("c.t").alias("t"), F.col("c.id").alias("id")).withColumn("w", F.transform("t", word_count))
    rows = doc.select(*keys, "t", "w", "id", F.posexplode(window_bounds(F.col("w"), most, overlap)).alias("window_index", "x"))
    part = lambda a: F.slice(a, F.col("x.start") + 1, F.col("x.end") - F.col("x.start"))
    return rows.select(
        *keys, "window_index", F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.aggregate(part(F.col("w")), F.lit(0), lambda a, x: (a + x).cast("int")).alias("n_words"),
        F.array_join(part(F.col("t")), "\n\n").alias("context_text"), (F.col("window_index") > 0).alias("is_continuation"), *([part(F.col("id")).alias("clause_ids")] if id_col else []),
    )


def section_windows(clauses: DataFrame, keys: list[str], order: list[str], text_col: str, most: int = 2500, overlap: int = 2, id_col: str | None = None) -> DataFrame:
    """``context_windows`` for sections of any size: no row holds a section, a window's clauses
    meet by their places, and no window has more than ``most`` clauses."""
    rows = numbered_in(clauses.where(F.trim(F.coalesce(text_col, F.lit(""))) != "").select(*keys, *(c for c in order if c not in keys), F.col(text_col).alias("__t"), F.col(id_col or text_col).alias("__id")), keys, order, "pos")
    rows = durable(rows.select(*keys, "pos", "__t", "__id", word_count(F.col("__t")).alias("w")))
    bounds = windows_of(rows.select(*keys, "pos", "w"), keys, most, overlap)
    held = bounds.withColumn("pos", F.explode(F.sequence(F.col("start").cast("long"), F.col("end").cast("long") - 1))).join(rows, [*keys, "pos"])
    c = F.array_sort(F.collect_list(F.struct("pos", F.col("__t").alias("t"), F.col("__id").alias("id"))))
    found = held.groupBy(*keys, "window_index", "start", "end").agg(F.sum("w").cast("int").alias("n_words"), c.alias("c"))
    return found.select(*keys, "window_index", "start", "end", "n_words", F.array_join("c.t", "\n\n").alias("context_text"), (F.col("window_index") > 0).alias("is_continuation"), *([F.col("c.id").alias("clause_ids")] if id_col else []))
