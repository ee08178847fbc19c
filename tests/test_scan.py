"""Running values over keys of many partitions against the operators that hold a key in one."""

import random

import pytest
from pyspark.sql import functions as F

from foliant.operators.clauses import context_windows, section_windows
from foliant.operators.layout import islands
from foliant.operators.scan import islands_of, numbered_in, placed, previous, running

KINDS = "k string, o int, x int"


@pytest.fixture(scope="module", autouse=True)
def many_partitions(spark):
    """Small partitions stay apart, so that keys reach over several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def rows(spark):
    """One key over all partitions, small ones, a null one; no two rows of a key are alike."""
    r = random.Random(2)
    data = [("big", i, r.randint(0, 3)) for i in range(400)] + [(k, i, r.randint(0, 3)) for k in ("a", "b", None) for i in range(r.randint(1, 5))]
    r.shuffle(data)
    return spark.createDataFrame(data, KINDS).repartition(5)


def test_running(rows):
    p = placed(rows, ["k"], ["o"])
    assert p.where("k = 'big'").select("__part").distinct().count() > 1
    found = running(running(previous(p, ["k"], ["x"], "before"), ["k"], F.col("x"), "total"), ["k"], F.when(F.col("x") < 3, F.col("o")), "most", "max")
    got = {(r.k, r.o): (r.before and r.before.x, r.total, r.most) for r in found.collect()}
    want, by = {}, {}
    for k, o, x in sorted(map(tuple, rows.collect()), key=lambda r: (r[0] or "", r[1])):
        last, total, most = by.get(k, (None, 0, None))
        most = o if x < 3 else most
        want[k, o] = (last, total + x, most)
        by[k] = (x, total + x, most)
    assert got == want
    assert {(r.k, r.o): r.n for r in numbered_in(rows, ["k"], ["o"], "n").collect()} == {(k, o): o for k, o in want}
    assert numbered_in(rows.limit(0), ["k"], ["o"], "n").count() == 0


def test_islands_of(rows):
    joins = F.col("x") == F.col("prev.x")
    one = {(r.k, r.o): r.island for r in islands(rows, ["k"], ["o"], joins).collect()}
    assert {(r.k, r.o): r.island for r in islands_of(rows, ["k"], ["o"], joins).collect()} == one and max(one.values()) > 100


@pytest.mark.parametrize(("most", "overlap"), [(7, 2), (1, 0), (20, 5), (3000, 2)])
def test_section_windows(spark, most, overlap):
    """Oversize clauses, redundant tails, whole sections and the stop at 201 windows."""
    r = random.Random(most)
    clauses = [("long", i, " ".join(["w"] * r.randint(1, 9))) for i in range(300)] + [("ones", i, "w") for i in range(450)]
    clauses += [("short", 0, "a b"), ("short", 1, " "), ("short", 2, None), ("empty", 0, ""), ("wide", 0, "w " * 50), ("wide", 1, "v"), ("wide", 2, "u " * 60), ("wide", 3, "t")]
    df = spark.createDataFrame([(s, i, t, f"{s}{i}") for s, i, t in clauses], "s string, o int, t string, id string").repartition(4)
    order = ["s", "window_index"]
    want = context_windows(df, ["s"], ["o"], "t", most, overlap, "id").orderBy(*order).collect()
    got = section_windows(df, ["s"], ["o"], "t", most, overlap, "id").orderBy(*order)
    assert got.columns == want[0].__fields__ and [tuple(x) for x in got.collect()] == [tuple(x) for x in want]
    assert most > 1 or max(x.window_index for x in want) == 200
    assert section_windows(df.limit(0), ["s"], ["o"], "t", most, overlap).count() == 0
