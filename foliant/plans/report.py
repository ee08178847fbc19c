"""Reports: a document's summary as one HTML page, built by column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import escape_html, truncate
from foliant.operators.summary import BUCKETS, MODULES


def html_reports(items: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, html): a section a bucket and group in fixed order, a card an item."""
    place = lambda names, c: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, names)), F.col(c)), F.lit(0)), F.lit(len(names) + 1))
    card = F.concat(F.lit("<li><b>"), escape_html(truncate(F.col("headline"), 120)), F.lit("</b><q>"), escape_html(truncate(F.col("exact_quote"), 130)), F.lit("</q></li>"))
    cards = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_id", card.alias("c")))), lambda x: x["c"]), "")
    parts = items.groupBy(doc_id, "bucket", "group").agg(cards.alias("cards"))
    title = escape_html(F.concat_ws(" / ", "bucket", "group"))
    part = F.struct(place(BUCKETS, "bucket").alias("b"), place(MODULES, "group").alias("m"), "group", F.concat(F.lit("<section><h2>"), title, F.lit("</h2><ul>"), "cards", F.lit("</ul></section>")).alias("html"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["html"]), "")
    page = F.concat(F.lit('<!doctype html><html><head><meta charset="utf-8"></head><body>'), body, F.lit("</body></html>"))
    return parts.groupBy(doc_id).agg(page.alias("html"))


def customer_pages(items: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_items, html): counts of the buckets that hold items, a tab a bucket, and
    cards with number, headline, quote, source pages and the first four chunks (+n for more).

    Items: bucket, group, item_id, headline, exact_quote, source_pages, chunk_ids. Numbers run
    through a document in the order of the page, so other outputs can refer to them.
    """
    numbered = item_numbers(items, doc_id)
    quote = F.regexp_replace(F.coalesce("exact_quote", F.lit("")), r"(?U)\s+", " ")
    quote = F.when(F.length(quote) > 130, F.concat(F.rtrim(F.substring(quote, 1, 130)), F.lit("..."))).otherwise(quote)
    none = F.array().cast("array<string>")
    ids = F.coalesce("chunk_ids", none)
    chips = F.concat(F.array_join(F.transform(F.slice(ids, 1, 4), lambda x: F.concat(F.lit("<i>"), escape_html(x), F.lit("</i>"))), ""), F.when(F.size(ids) > 4, F.concat(F.lit("<i>+"), F.size(ids) - 4, F.lit("</i>"))).otherwise(""))
    badge = F.when(F.size(F.coalesce("source_pages", F.array().cast("array<int>"))) > 0, F.concat(F.lit("<small>p. "), F.array_join(F.col("source_pages").cast("array<string>"), ", "), F.lit("</small>"))).otherwise("")
    card = F.concat(F.lit('<article id="item-'), "number", F.lit('"><h3>'), escape_html(F.coalesce("headline", F.lit(""))), F.lit("</h3><q>"), escape_html(quote), F.lit("</q>"), badge, chips, F.lit("</article>"))
    lines = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["h"]), "")
    tabs = numbered.groupBy(doc_id, "bucket").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"), lines(F.struct("number", card.alias("h"))).alias("cards"))
    stat = F.concat(F.lit("<li>"), escape_html(F.col("bucket")), F.lit(": "), "n", F.lit("</li>"))
    tab = F.concat(F.lit("<details open><summary>"), escape_html(F.col("bucket")), F.lit("</summary>"), "cards", F.lit("</details>"))
    title = escape_html(F.col(doc_id).cast("string"))
    page = F.concat(F.lit('<!doctype html><html><head><meta charset="utf-8"><title>'), title, F.lit("</title></head><body><ul>"), lines(F.struct("first", stat.alias("h"))), F.lit("</ul>"), lines(F.struct("first", tab.alias("h"))), F.lit("</body></html>"))
    return tabs.groupBy(doc_id).agg(F.sum("n").alias("n_items"), page.alias("html"))


def item_numbers(items: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Numbers from 1 through each document: buckets in fixed order, known modules, then
    others by name, then item ids."""
    place = lambda names, c: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, names)), F.col(c)), F.lit(0)), F.lit(len(names) + 1))
    return items.withColumn("number", F.row_number().over(Window.partitionBy(doc_id).orderBy(place(BUCKETS, "bucket"), place(MODULES, "group"), F.asc_nulls_first("group"), "item_id")))


def index_pages(pages: DataFrame, shards: int = 1, doc_id: str = "doc_id") -> DataFrame:
    """(shard, html): links to the documents' pages by name, dealt out over ``shards`` pages."""
    name = F.col(doc_id).cast("string")
    link = F.concat(F.lit('<li><a href="'), escape_html(name), F.lit('.html">'), escape_html(name), F.lit("</a> "), "n_items", F.lit("</li>"))
    links = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(name.alias("d"), link.alias("h")))), lambda x: x["h"]), "")
    html = F.concat(F.lit('<!doctype html><html><head><meta charset="utf-8"></head><body><ul>'), links, F.lit("</ul></body></html>"))
    return pages.groupBy(F.pmod(F.xxhash64(name), F.lit(shards)).alias("shard")).agg(html.alias("html"))
