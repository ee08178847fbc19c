"""Choice without a model, totals, tiers of quotes, prompts and pages."""

import json

from pyspark.sql import functions as F

from foliant.operators.matching import quote_position, quoted_pages
from foliant.operators.quotes import validate_items
from foliant.operators.prompts import compact_item, extraction_prompt, selection_prompt
from foliant.operators.selection import fallback_selection, largest, run_totals, too_few
from foliant.plans.report import customer_pages, index_pages


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_fallback(spark):
    rows = [(f"{b}{m}{i}", b, m, i % 3, i) for b in ("cov", "exc", "com") for m in ("y", "x", None) for i in range(5)]
    df = spark.createDataFrame(rows, "id string, bucket string, module string, priority int, score int").withColumn("doc", F.lit("d"))
    got = fallback_selection(df, ["doc"], {"cov": 2, "exc": 1, "com": 4}, ("cov", "exc"), "priority", [F.asc("priority"), F.desc("score"), F.asc("id")], 10)
    # by hand: quotas in order of choice, then a stable sort by priority
    rank = lambda r: (r[3], -r[4], r[0])
    want = []
    for m in sorted({r[2] or "general" for r in rows}):
        for b, k in (("cov", 2), ("exc", 1)):
            want += sorted((r for r in rows if r[1] == b and (r[2] or "general") == m), key=rank)[:k]
    want += sorted((r for r in rows if r[1] == "com"), key=lambda r: (r[3], -r[4], str(r[0])))[:4]
    want = sorted(want, key=lambda r: r[3])[:10]
    assert [r.id for r in got.orderBy("place").collect()] == [r[0] for r in want]
    assert fallback_selection(df.limit(0), ["doc"], {"com": 1}, ("cov",), "priority", [F.asc("id")]).count() == 0


def test_too_few_and_totals(spark):
    assert one(spark, too_few(F.lit(35), F.lit(100))) is None and one(spark, too_few(F.lit(3), F.lit(3))) is None
    assert "Only 2 groups" in one(spark, too_few(F.lit(2), F.lit(3)))
    df = spark.createDataFrame([("a", 10, 4, ["x", "x"]), ("b", 0, 0, ["y"])], "d string, i int, o int, bad array<string>")
    assert tuple(run_totals(df, ["i", "o"], "i", "o", "bad").first()) == (2, 10, 4, 0.3, 2)
    assert tuple(run_totals(df.limit(0), ["i"], "i", "o").first()) == (0, 0, 0.0)
    assert [r.d for r in largest(df, "i", "d", 1).collect()] == ["a"]


def test_items(spark):
    clauses = spark.createDataFrame([("s", 0, "c0", "The quick  brown fox", 1, 2, [0.0, 1.0, 2.0, 3.0]), ("s", 1, "c1", "jumps over it all", 3, 3, None), ("s", 2, "c2", "the quick brown fox", 5, 5, [1.0, 0.0, 1.0, 9.0])], "s string, i int, clause_id string, clause_text string, page_start int, page_end int, bbox array<double>")
    items = spark.createDataFrame([(1, "s", "quick brown", ["c0", "?"]), (2, "s", "quick brown", None), (3, "s", "", ["c0"]), (4, "z", "quick", []), (5, "s", " ", ["c1"]), (6, "s", None, None), (7, "s", "jumps ower it all", ["c1"])], "n int, s string, exact_quote string, supporting_clause_ids array<string>")
    got = {r.n: (r.validation_status, r.matched_clause_ids, r.page_start, r.page_end, r.bbox_union) for r in validate_items(items, clauses, ["s"], order=["i"]).collect()}
    assert got[1] == ("verified", ["c0"], 1, 2, [0.0, 1.0, 2.0, 3.0])
    assert got[2] == ("verified", ["c0", "c2"], 1, 5, [0.0, 0.0, 2.0, 9.0])
    assert got[3] == got[4] == got[6] == ("unverified", [], None, None, None)
    assert got[5] == ("verified", ["c1"], 3, 3, None) and got[7][:2] == ("fuzzy_match", ["c1"])
    assert validate_items(items.limit(0), clauses, ["s"], order=["i"]).count() == 0


def test_quote_search(spark):
    at = lambda t, q: one(spark, quote_position(F.lit(t), F.lit(q)))
    long = "word " * 20
    assert at("xx The  Quick fox", "the quick") == 4 and at("nothing", "the quick") == 0 and at("nothing", "") == 0
    assert at(long + "end", long + "other") == 1 and at("one two", "one three") == 1
    pages = spark.createDataFrame([("d", 1, "nothing"), ("d", 2, "here it is"), ("d", 3, "here it is")], "doc_id string, page_no int, text string")
    items = spark.createDataFrame([("d", "a", "it is", [1, 3, 2]), ("d", "b", "else", [1]), ("d", "c", "it is", None)], "doc_id string, item_id string, exact_quote string, source_pages array<int>")
    assert [tuple(r) for r in quoted_pages(items, pages, ["doc_id"]).collect()] == [("d", "a", 3, 6)]


def test_prompts(spark):
    assert one(spark, extraction_prompt(F.lit("A > B"), F.lit("text"), F.lit(False))).endswith("Section: A > B\n\ntext")
    item = compact_item(*map(F.lit, ("i", "b", "m", "t", None, "h" * 100, "q", 3)))
    got = json.loads(one(spark, selection_prompt(F.lit("d"), F.array(item))).split("\n\n", 1)[1])
    assert got["doc_id"] == "d" and got["targets"]["total_max"] == 80 and len(got["items"][0]["h"]) == 90


def test_customer_pages(spark):
    rows = [("d", "limits_by_module", "wa", "l0", "<L>", "q" * 200, [2, 3], list("abcdef")), ("d", "coverage_by_module", "wa", "c0", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id string, bucket string, group string, item_id string, headline string, exact_quote string, source_pages array<int>, chunk_ids array<string>")
    page = customer_pages(df).first()
    assert page.n_items == 2 and 'id="item-2"><h3>&lt;L&gt;</h3><q>' + "q" * 130 + "...</q><small>p. 2, 3</small>" in page.html and "<i>+2</i>" in page.html
    assert page.html.index("coverage_by_module") < page.html.index("limits_by_module")
    assert '<a href="d.html">d</a> 2' in index_pages(customer_pages(df)).first().html
