"""Layout documents: trees of blocks of any depth as rows in reading order."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.html import text_of
from foliant.functions.text import section_path

BLOCKS = "doc_id string, page_no int, at int, block_id string, parent_id string, depth int, block_type string, html string, text string, bbox array<double>, hierarchy map<string,string>, n_children int, error string"

#: Block types that carry no content.
DROPPED = ("Page", "PageHeader", "PageFooter", "Picture")


def _blocks(doc_id: str, raw: str) -> Iterator[tuple]:
    """Blocks in pre-order; a tree on a stack, so depth is not bound by recursion. A broken
    document gives the blocks before the break and one row that holds the error."""
    at = 0
    try:
        doc = json.loads(raw)
        pages = doc.get("children") if isinstance(doc, dict) else doc
        for page_no, page in enumerate(pages if isinstance(pages, list) else [], 1):
            stack = [(page, None, 0)]
            while stack:
                block, parent, depth = stack.pop()
                children = block.get("children")
                children = children if isinstance(children, list) else []
                box, levels = block.get("bbox"), block.get("section_hierarchy")
                box = [float(x) for x in box] if isinstance(box, list) and len(box) == 4 else None
                levels = {str(k): str(v) for k, v in levels.items()} if isinstance(levels, dict) else {}
                html = block.get("html") or ""
                yield doc_id, page_no, at, block.get("id"), parent, depth, block.get("block_type"), html, text_of(html), box, levels, len(children), None
                at += 1
                stack += [(c, block.get("id"), depth + 1) for c in reversed(children)]
    except Exception as e:  # noqa: BLE001 - told in the run log
        yield doc_id, None, at, None, None, None, None, None, None, None, None, None, repr(e)


def flatten_layout(docs: DataFrame) -> DataFrame:
    """Rows of ``BLOCKS`` for (doc_id, json) rows."""
    names = [c.split(" ")[0] for c in BLOCKS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, raw in zip(batch["doc_id"], batch["json"], strict=True):
                rows = pd.DataFrame(list(_blocks(doc_id, raw)), columns=names, dtype=object)
                yield rows

    return docs.select("doc_id", "json").mapInPandas(run, BLOCKS)


def run_log(blocks: DataFrame) -> DataFrame:
    """Per document with rows: ok, notes (the error) and the number of pages."""
    notes = F.coalesce(F.max("error"), F.lit(""))
    return blocks.groupBy("doc_id").agg((F.count("error") == 0).alias("ok"), notes.alias("notes"), F.coalesce(F.max("page_no"), F.lit(0)).alias("n_pages"))


def useful_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with text and content, with their section paths from the headers of their
    document; of headers that share an id the last counts."""
    rows = blocks.where("error IS NULL")
    last = rows.where("block_type = 'SectionHeader'").groupBy("doc_id", "block_id").agg(F.max_by("text", "at").alias("t"))
    headers = last.where("block_id IS NOT NULL").groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("block_id", "t"))).alias("headers"))
    path = section_path(F.col("hierarchy"), F.coalesce("headers", F.create_map().cast("map<string,string>")))
    kept = rows.where(~F.coalesce("block_type", F.lit("")).isin(*DROPPED) & (F.length("text") > 0))
    return kept.join(headers, "doc_id", "left").withColumn("section_path", path).drop("headers", "error")
