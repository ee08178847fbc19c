"""Chunks with what a table of chunks shows: titles, parsed tables, cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.html import html_table
from foliant.operators.layout import bbox_union, chunks

_KINDS = {"list": "list_chunk", "paragraph": "paragraph_chunk", "single_text": "single_text_chunk"}


def chunk_table(blocks: DataFrame) -> DataFrame:
    """``chunks`` of useful blocks (with html) with chunk_kind, title_text (the last part of
    the path), text_with_title, headers, pairs and rows of tables. A table names its cells
    after itself and its box holds theirs; a table that can't be parsed is table_other_chunk."""
    at = lambda i: F.get("bbox", F.lit(i))
    cell = F.struct("page_no", F.coalesce(at(1), F.lit(float("inf"))).alias("y"), F.coalesce(at(0), F.lit(float("inf"))).alias("x"), "block_id", "bbox")
    cells = blocks.where("block_type = 'TableCell' AND parent_id IS NOT NULL").groupBy("doc_id", F.col("parent_id").alias("__id")).agg(F.array_sort(F.collect_list(cell)).alias("__cells"))
    tables = blocks.where("block_type = 'Table'").groupBy("doc_id", F.col("block_id").alias("__id")).agg(F.min_by("html", "at").alias("__html"))
    rows = chunks(blocks).withColumn("__id", F.when(F.col("kind") == "table", F.get("block_ids", F.lit(0))))
    rows = rows.join(cells, ["doc_id", "__id"], "left").join(tables, ["doc_id", "__id"], "left").withColumn("__t", F.when(F.col("kind") == "table", html_table("__html")))
    kind = F.coalesce("__t.kind", F.lit("table_other_chunk"))
    for short, name in _KINDS.items():
        kind = F.when(F.col("kind") == short, name).otherwise(kind)
    title = F.trim(F.element_at(F.split(F.coalesce("section_path", F.lit("")), " > ", -1), -1))
    own = F.coalesce("__cells.block_id", F.array().cast("array<string>"))
    boxes = F.concat(F.array("bbox"), F.coalesce("__cells.bbox", F.array().cast("array<array<double>>")))
    out = rows.withColumn("title_text", title)
    titled = F.when((F.col("title_text") != "") & ((F.col("kind") != "table") | (F.col("text") != "")), F.concat_ws("\n", "title_text", "text")).otherwise(F.col("text"))
    ids = F.concat("block_ids", own)
    return out.select(
        "doc_id", "island", kind.alias("chunk_kind"), "page_start", "page_end", "section_path", "title_text", ids.alias("source_block_ids"), F.size(ids).alias("n_blocks"), bbox_union(boxes).alias("bbox"),
        F.col("text").alias("text_raw"), titled.alias("text_with_title"), F.col("__t.headers").alias("headers"), F.col("__t.pairs").alias("pairs"), F.col("__t.rows").alias("rows"),
    )


def with_section_columns(chunks: DataFrame) -> DataFrame:
    """Chunks with chunk_id (struct_chunk_id where there is none) and the columns that say that
    paths and titles are the original ones."""
    if not {"chunk_id", "struct_chunk_id"} & set(chunks.columns):
        raise ValueError("chunks need chunk_id or struct_chunk_id")
    out = chunks if "chunk_id" in chunks.columns else chunks.withColumn("chunk_id", F.col("struct_chunk_id"))
    own = {c: F.coalesce(c, F.lit("")) if c in out.columns else F.lit("") for c in ("section_path", "title_text")}
    same = {f"{c}_{k}": v for c, v in own.items() for k in ("original", "enriched")}
    return out.withColumns(own | same | {"heading_text_inferred": F.lit(""), "heading_level_inferred": F.lit(0), "heading_source": F.lit("original"), "section_enrichment_confidence": F.lit(1.0)})
