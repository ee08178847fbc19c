"""Layout blocks: geometry and merging of neighbouring blocks (gaps and islands)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bbox_union(boxes: Column) -> Column:
    """Smallest box around the boxes of an array; null if there are none."""
    ok = F.filter(boxes, lambda b: b.isNotNull() & (F.size(b) == 4))
    pick = lambda i, f: f(F.transform(ok, lambda b: F.get(b, F.lit(i))))
    return F.when(F.size(ok) > 0, F.array(pick(0, F.array_min), pick(1, F.array_min), pick(2, F.array_max), pick(3, F.array_max)))


def text_run(gap: Column, shift: Column) -> Column:
    return gap.between(-5, 35) & (F.abs(shift) <= 40)


def list_run(gap: Column, shift: Column, same_parent: Column) -> Column:
    return (gap >= -5) & (same_parent | ((gap <= 28) & (F.abs(shift) <= 50)))


def islands(df: DataFrame, keys: list[str], order: list[str], joins: Column, name: str = "island") -> DataFrame:
    """Number the runs of rows in which each row ``joins`` the one before; ``joins`` may use
    ``prev``, a struct of the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn("prev", F.lag(F.struct(*df.columns)).over(w))
    starts = F.when(F.col("prev").isNull() | ~F.coalesce(joins, F.lit(False)), 1).otherwise(0)
    return rows.withColumn(name, F.sum(starts).over(w)).drop("prev")


def chunks(blocks: DataFrame) -> DataFrame:
    """Runs of text and list blocks of (doc_id, page_no, block_id, parent_id, depth,
    block_type, section_path, text, bbox) as chunks in reading order. Tables are chunks of
    their own; headers and other types emit nothing and end runs. Runs lose leading noise."""
    at = lambda i: F.get("bbox", F.lit(i))
    b = blocks.where("block_type <> 'TableCell'").withColumns({"x0": at(0), "y0": at(1), "y1": at(3)})
    gap, shift = F.col("y0") - F.col("prev.y1"), F.col("x0") - F.col("prev.x0")
    same = (F.col("block_type") == F.col("prev.block_type")) & (F.col("section_path") == F.col("prev.section_path")) & (F.col("page_no") == F.col("prev.page_no"))
    parents = F.coalesce("parent_id", F.lit("")) == F.coalesce("prev.parent_id", F.lit(""))
    joins = same & (((F.col("block_type") == "Text") & text_run(gap, shift)) | ((F.col("block_type") == "ListItem") & list_run(gap, shift, parents)))
    keys = ["page_no", F.asc_nulls_last("y0"), F.asc_nulls_last("x0"), "depth", "block_id"]
    w = Window.partitionBy("doc_id").orderBy(*keys)
    rows = islands(b, ["doc_id"], keys, joins).withColumn("at", F.row_number().over(w))
    noise = (F.col("block_type") == "Text") & F.trim("text").isin("", ".", "-", "•")
    inside = Window.partitionBy("doc_id", "island").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.where(F.col("block_type").isin("Text", "ListItem", "Table")).withColumn("live", F.max((~noise).cast("int")).over(inside)).where("live = 1")
    out = rows.groupBy("doc_id", "island").agg(
        F.first("block_type").alias("block_type"), F.min("page_no").alias("page_start"), F.max("page_no").alias("page_end"), F.first("section_path").alias("section_path"),
        F.array_sort(F.collect_list(F.struct("at", "block_id", "text", "bbox"))).alias("b"),
    )
    texts, many = F.col("b.text"), F.size("b") > 1
    kind = F.when(F.col("block_type") == "Table", "table").when(F.col("block_type") == "ListItem", "list").when(many, "paragraph").otherwise("single_text")
    text = F.when(F.col("block_type") == "ListItem", F.array_join(F.transform(texts, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise(F.array_join(texts, " "))
    return out.select("doc_id", "island", kind.alias("kind"), "page_start", "page_end", "section_path", F.col("b.block_id").alias("block_ids"), bbox_union(F.col("b.bbox")).alias("bbox"), text.alias("text"))
