"""Operator 12: what every filter removes in every order of the filters.

A document is a mask, one bit for each filter that it fails. A table with one row a mask and one
column an order (32 by 120 for five filters) holds the step at which a document of that mask
goes. Tasks look their rows up and count them by part, order and step, once for all rows and
once for each label; the counts of all tasks are summed. All other figures follow from these:
a filter at the first step removes all that fail it, at the last step those that fail it only.

Defined results: a condition or label that is null doesn't hold; a null part is the empty
string, as an empty part is; an empty table gives no rows. Repeated rows count one by one. A row
of null id is later than none. Null texts are empty texts, and equal to them. A document with
several rows of labels has a label if any of them says so. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import durable

SPACE = " \t\n\x0b\f\r"


def first_failures(filters: int) -> np.ndarray:
    """By mask and order (orders as ``permutations`` gives them) the step from 0 at which the
    first filter fails; ``filters`` if none does."""
    orders = np.array(list(permutations(range(filters))))
    masks = np.arange(1 << filters)[:, None]
    step = np.full((1 << filters, len(orders)), filters, np.int64)
    for s in reversed(range(filters)):
        np.putmask(step, masks >> orders[:, s] & 1, s)
    return step


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null and empty texts have none."""
    x = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, "[ \\t-\\r]+"))


def later_copies(rows: DataFrame, key: str, id_col: str, name: str) -> DataFrame:
    """The rows with a flag: a row of the same key has a smaller id.

    Keys of more than a thousandth of all rows (so fewer than 1000) are broadcast, so no key
    that is joined by a shuffle has more rows than that.
    """
    first = durable(rows.groupBy(key).agg(F.min(id_col).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    hot = F.col("__n") * 1000 > rows.count()
    many = F.broadcast(first.where(hot).select(key, "__first"))
    few = rows.join(many, key, "left_anti").join(first.where(~hot).select(key, "__first"), key, "left")
    return rows.join(many, key).unionByName(few).withColumn(name, F.coalesce(F.col(id_col) > F.col("__first"), F.lit(False))).drop("__first")


def _counted(filters: int, labels: int, schema: pa.Schema, held: int = 256):
    """Counts of a task's rows; parts are given out when more than ``held`` have gathered."""
    steps = filters + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = first_failures(filters)
        cells = np.arange(table.shape[1]) * steps
        width, sums = len(cells) * steps, {}

        def given() -> Iterator[pa.RecordBatch]:
            for part, n in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([part] * width, pa.string()), pa.array(np.arange(width, dtype=np.int32)), *(pa.array(x) for x in n)], schema=schema)
            sums.clear()

        for batch in batches:
            for at in range(0, len(batch), 1024):
                b = batch.slice(at, 1024)
                part = pa.array(b.column(0)).dictionary_encode()
                cell = part.indices.to_numpy()[:, None] * width + cells + table[b.column(1).to_numpy()]
                which = [np.ones(len(b), bool), *(b.column(2 + i).to_numpy(zero_copy_only=False) for i in range(labels))]
                counts = np.stack([np.bincount(cell[w].ravel(), minlength=len(part.dictionary) * width).reshape(-1, width) for w in which], 1)
                for name, n in zip(part.dictionary.to_pylist(), counts, strict=True):
                    sums[name] = sums[name] + n if name in sums else n
                if len(sums) > held:
                    yield from given()
        yield from given()

    return run


def audit(rows: DataFrame, part: str, fails: list[str], labels: list[str]) -> DataFrame:
    """For rows with a part, flags of failed filters (columns named by one letter each, at most
    eight) and flags of labels: part, filter_order and step (from 1), and of the step's filter
    kept, removed, redundant, unique_fails, a ``<label>_lost`` for each label, and shapley (its
    removed rows, summed over all orders)."""
    if not 1 <= len(fails) <= 8 or any(len(f) != 1 for f in fails):
        raise ValueError("one to eight filters, named by one letter each")
    k, lost = len(fails), [f"__l{i}" for i in range(len(labels))]
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    mask = sum((F.when(yes(f), 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")
    schema = pa.schema([("__part", pa.string()), ("__cell", pa.int32()), *((c, pa.int64()) for c in ("__n", *lost))])
    slim = rows.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("__part"), mask.alias("__mask"), *(yes(x).alias(c) for x, c in zip(labels, lost, strict=True)))
    each = slim.mapInArrow(_counted(k, len(labels), schema), "__part string, __cell int, __n long" + "".join(f", {c} long" for c in lost))
    sums = each.groupBy("__part", "__cell").agg(*(F.sum(c).alias(c) for c in ("__n", *lost)))
    orders = F.array(*(F.lit("".join(o)) for o in permutations(fails)))
    cells = sums.select("*", F.get(orders, F.floor(F.col("__cell") / (k + 1)).cast("int")).alias("__order"), (F.col("__cell") % (k + 1) + 1).alias("__step"))
    cells = cells.withColumn("__filter", F.substring("__order", F.col("__step"), F.lit(1)))  # empty beyond the last step
    later = Window.partitionBy("__part", "__order").orderBy("__step").rowsBetween(1, Window.unboundedFollowing)
    own = Window.partitionBy("__part", "__filter")
    at = lambda step: F.max(F.when(F.col("__step") == step, F.col("__n"))).over(own)
    found = cells.select(
        F.col("__part").alias("part"), F.col("__order").alias("filter_order"), F.col("__step").cast("int").alias("step"), F.sum("__n").over(later).alias("kept"), F.col("__n").alias("removed"),
        (at(1) - F.col("__n")).alias("redundant"), at(k).alias("unique_fails"), *(F.col(c).alias(f"{x}_lost") for x, c in zip(labels, lost, strict=True)), F.sum("__n").over(own).alias("shapley"),
    )
    return found.where(F.col("step") <= k)


def text_filters(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Rows for ``audit``: part, flags A to E (few words, repeated words, many capitals, marks,
    text of a smaller id) and good and toxic by the labels. Texts are read once; what is
    shuffled is a digest and a few flags a document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).alias("id"), F.col(part_col).cast("string").alias("part"), text.alias("t"), words(text).alias("w"))
    n = F.size("w")
    capitals = F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    flags = {"A": n < 50, "B": 100 * F.size(F.array_distinct("w")) < 65 * n, "C": 100 * capitals > 5 * F.length("t"), "D": F.col("t").rlike("[#$%&*|]")}
    rows = durable(read.select("id", "part", *(c.alias(f) for f, c in flags.items()), F.unhex(F.sha2("t", 256)).alias("digest")))
    known = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return later_copies(rows, "digest", "id", "E").join(known, "id", "left").select("part", *"ABCDE", "good", "toxic")
