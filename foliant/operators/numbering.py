"""Numbers that run on over ordered keys, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.sources.shared import durable


def offsets(counts: DataFrame, key: str, n: str = "n", rows: int = 100_000) -> DataFrame:
    """(key, offset): the sum of ``n`` over all smaller keys, for rows of distinct keys.

    Bounds (keys drawn by their hash) cut the keys into stretches of about ``rows`` keys, eight
    stretches at least and 10,000 at most; the sums of the stretches are all that reaches the
    driver. ``counts`` is computed once.
    """
    counts = durable(counts.select(key, n))
    parts = min(10_000, max(8, counts.count() // rows))
    drawn = counts.select(key).orderBy(F.xxhash64(key), key).limit(parts).collect()
    bounds = F.array(*(F.lit(k) for k in sorted(r[0] for r in drawn))) if drawn else F.array(F.lit(None).cast(counts.schema[key].dataType))
    rows_ = counts.select(key, n, F.size(F.filter(bounds, lambda b: b <= F.col(key))).alias("__part"))
    before, total = [], 0
    for r in rows_.groupBy("__part").agg(F.sum(n).alias("s")).orderBy("__part").collect():
        before += [F.lit(r["__part"]), F.lit(total)]
        total += r.s
    base = F.element_at(F.create_map(*before), F.col("__part")) if before else F.lit(0)
    inside = Window.partitionBy("__part").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows_.select(key, (base + F.sum(n).over(inside) - F.col(n)).cast("long").alias("offset"))


def numbered(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 by key and, inside a key, by ``order``. The rows are computed once."""
    rows = durable(df)
    inside = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    before = offsets(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key)
    return rows.join(before, key).withColumn(name, F.col("offset") + inside).drop("offset")
