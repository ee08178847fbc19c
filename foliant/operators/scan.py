"""Running values over the ordered rows of a key of any size, without a task for a whole key.

Rows are sorted over all partitions, so a key may reach over many. What runs on is found inside
each partition's stretch of a key and then carried over by a table of one row a stretch, of which
a key has at most as many as there are partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.sources.shared import durable

PART, PLACE = "__part", "__place"


def placed(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The rows, kept in order of keys and ``order``, with their partition and place."""
    return durable(df.sort(*keys, *order).withColumn(PLACE, F.monotonically_increasing_id()).withColumn(PART, F.shiftright(PLACE, 33)))


def running(rows: DataFrame, keys: list[str], value: Column, name: str, kind: str = "sum") -> DataFrame:
    """``placed`` rows with the sum (or ``kind`` max) of the value over the rows of the key up to
    this one."""
    total, both = (F.sum, lambda a, b: a + b) if kind == "sum" else (F.max, F.greatest)
    same = [PART, *keys]
    inside = Window.partitionBy(*same).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*same).agg(total(value).alias("__v")).select(*same, total("__v").over(before).alias("__carried"))
    own = rows.withColumn("__own", total(value).over(inside))
    found = _matched(own, carried, same)
    if kind == "sum":
        return found.withColumn(name, both(F.coalesce("__own", F.lit(0)), F.coalesce("__carried", F.lit(0)))).drop("__own", "__carried")
    return found.withColumn(name, both(F.col("__own"), F.col("__carried"))).drop("__own", "__carried")


def previous(rows: DataFrame, keys: list[str], fields: list[str], name: str) -> DataFrame:
    """``placed`` rows with a struct of the fields of the row before in the key, null for the
    first."""
    same = [PART, *keys]
    inside = Window.partitionBy(*same).orderBy(PLACE)
    row = F.struct(*fields)
    last = rows.groupBy(*same).agg(F.max_by(row, PLACE).alias("__last"))
    before = last.select(*same, F.lag("__last").over(Window.partitionBy(*keys).orderBy(PART)).alias("__carried"))
    own = rows.withColumns({"__own": F.lag(row).over(inside), "__first": F.row_number().over(inside) == 1})
    return _matched(own, before, same).withColumn(name, F.when(F.col("__first"), F.col("__carried")).otherwise(F.col("__own"))).drop("__own", "__first", "__carried")


def _matched(rows: DataFrame, carried: DataFrame, same: list[str]) -> DataFrame:
    """The rows with what is carried to their stretch; keys may be null."""
    named = carried.select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(same)), "__carried")
    on = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(same)]
    return rows.join(named, on, "left").drop(*(f"__k{i}" for i in range(len(same))))


def numbered_in(df: DataFrame, keys: list[str], order: list[str | Column], name: str) -> DataFrame:
    """Rows numbered from 0 inside their key, however many it has."""
    rows = running(placed(df, keys, order), keys, F.lit(1), name)
    return rows.withColumn(name, (F.col(name) - 1).cast("long")).drop(PART, PLACE)


def islands_of(df: DataFrame, keys: list[str], order: list[str | Column], joins: Column, name: str = "island") -> DataFrame:
    """``layout.islands`` for keys of any size: each row that doesn't join the one before
    (``prev``, a struct) begins an island, numbered from 1 inside the key."""
    rows = previous(placed(df, keys, order), keys, df.columns, "prev")
    starts = F.when(F.col("prev").isNull() | ~F.coalesce(joins, F.lit(False)), 1).otherwise(0)
    return running(rows.withColumn("__start", starts), keys, F.col("__start"), name).drop("prev", "__start", PART, PLACE)


def windows_of(words: DataFrame, keys: list[str], most: int, overlap: int, limit: int = 201) -> DataFrame:
    """(keys, window_index, start, end) of the greedy windows of ``clauses.window_bounds`` for
    keys of any size, over (keys, pos, w): places from 0 and word counts of one at least.

    The end of the window that would start at each place is found by merging the sums of words
    before with the bounds that they allow. Where the next window starts is then a link from
    place to place; links of links are taken, each twice as long, until ``limit`` windows from
    place 0 on are known.
    """
    rows = durable(running(placed(words, keys, ["pos"]), keys, F.col("w"), "upto").select(*keys, F.col("pos").cast("long").alias("pos"), F.col("w").cast("long").alias("w"), F.col("upto").cast("long").alias("upto")))
    total = rows.groupBy(*keys).agg(F.max("upto").alias("total"), F.count(F.lit(1)).alias("n"))
    ends = rows.select(*keys, F.col("upto").alias("v"), F.lit(0).alias("ask"), "pos")
    asks = rows.select(*keys, (F.col("upto") - F.col("w") + most).alias("v"), F.lit(1).alias("ask"), "pos")
    merged = running(placed(ends.unionByName(asks), keys, ["v", "ask", "pos"]), keys, F.when(F.col("ask") == 0, F.col("pos") + 1), "fits", "max")
    end = F.greatest(F.col("pos") + 1, F.coalesce("fits", F.lit(0)))
    starts = merged.where("ask = 1").select(*keys, "pos", end.alias("end"))
    starts = starts.join(total, keys).withColumn("next", F.when(F.col("total") <= most, F.col("n")).otherwise(F.greatest(F.col("pos") + 1, F.col("end") - overlap)))
    starts = durable(starts.select(*keys, "pos", "end", F.when(F.col("next") < F.col("n"), F.col("next")).alias("next")))
    jump = starts.where("next IS NOT NULL").select(*keys, "pos", "next")
    known = starts.where("pos = 0").select(*keys, F.lit(0).alias("window_index"), "pos")
    step = 1
    while step < limit:
        new = known.join(jump, [*keys, "pos"]).select(*keys, (F.col("window_index") + step).alias("window_index"), F.col("next").alias("pos"))
        known = durable(known.unionByName(new.where(F.col("window_index") < limit)))
        step *= 2
        if step < limit:
            twice = jump.select(*keys, F.col("pos").alias("next"), F.col("next").alias("__next"))
            jump = durable(jump.join(twice, [*keys, "next"]).select(*keys, "pos", F.col("__next").alias("next")))
    return known.join(starts, [*keys, "pos"]).select(*keys, "window_index", F.col("pos").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
