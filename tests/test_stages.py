import json

from pyspark.sql import functions as F

from foliant.functions.html import html_table, html_text, table_of, text_of
from foliant.operators.extraction import cache_key, call_model, item_rows
from foliant.operators.layout import chunks
from foliant.operators.summary import balance, replaced_bucket, summarise
from foliant.operators.tree import flatten_layout, run_log, useful_blocks
from foliant.plans.report import html_reports
from foliant.sources.stages import Stages, read_layout


def test_html(spark):
    assert text_of("<p>a&amp;b<br>c <b>d</p>") == "a&b c d"
    assert text_of(None) == ""
    df = spark.createDataFrame([("<p>x</p>",), (None,)], "h string").select(html_text("h").alias("t"), html_table("h").alias("k"))
    assert [tuple(r) for r in df.collect()] == [("x", None), ("", None)]


def test_tables():
    row = lambda *c, t="td": "<tr>" + "".join(f"<{t}>{x}</{t}>" for x in c) + "</tr>"
    paired = table_of("<table>" + row("1. Dit is verzekerd", "2. Dit is niet verzekerd", t="th") + row("a", "b") + row("c") + "</table>")
    assert paired["kind"] == "table_paired_chunk" and paired["headers"] == [["1. Dit is verzekerd", "2. Dit is niet verzekerd"]]
    assert [(r["insured"], r["not_insured"]) for r in paired["pairs"]] == [("a", "b"), ("c", "")]
    assert table_of("<table>" + row("a") * 3 + "</table>")["kind"] == "table_matrix_chunk"
    assert table_of("<table>" + row("a") * 2 + "</table>")["kind"] == "table_other_chunk"
    assert table_of('<table><tr><td colspan="2">a</td></tr></table>')["kind"] == "table_matrix_chunk"
    assert table_of('<table><tr><td colspan="x">a</td></tr></table>')["rows"][0]["cells"][0]["colspan"] == 1
    assert table_of("<p>no table</p>") is None


def layout():
    block = lambda i, t, y, text, h=None, kids=(): {"id": i, "block_type": t, "html": f"<p>{text}</p>", "bbox": [0, y, 100, y + 10], "section_hierarchy": h, "children": list(kids)}
    h = {"10": "s2", "2": "s1"}
    page = {"id": "p", "block_type": "Page", "bbox": None, "children": [block("s1", "SectionHeader", 0, "One"), block("s2", "SectionHeader", 20, "Two"), block("a", "Text", 40, "x", h), block("b", "Text", 60, "y", h), block("f", "PageFooter", 90, "7")]}
    return {"children": [page]}


def test_tree(spark, tmp_path):
    for name, text in (("one", json.dumps(layout())), ("bad", "{"), ("none", "{}")):
        (tmp_path / f"{name}.json").write_text(text)
    blocks = flatten_layout(read_layout(spark, str(tmp_path)))
    assert {r.doc_id: r.ok for r in run_log(blocks).collect()} == {"one": True, "bad": False}
    useful = useful_blocks(blocks)
    assert {(r.block_id, r.section_path) for r in useful.where("block_type = 'Text'").collect()} == {("a", "One > Two"), ("b", "One > Two")}
    assert [(r.kind, r.text) for r in chunks(useful).collect()] == [("paragraph", "x y")]
    rows = flatten_layout(spark.createDataFrame([("d", json.dumps({"children": []})), ("e", None)], "doc_id string, json string")).collect()
    assert [(r.doc_id, r.error is not None) for r in rows] == [("e", True)]
    assert flatten_layout(spark.createDataFrame([], "doc_id string, json string")).count() == 0


def test_answers(spark):
    good = json.dumps({"items": [{"item_type": "limit", "headline": "h", "importance": 4}, {"item_type": "odd"}, {"importance": "many"}]})
    df = spark.createDataFrame([(1, f"```json\n{good}\n```"), (2, '[{"headline": "k"}]'), (3, "nothing"), (4, None)], "k int, answer string")
    got = sorted((r.k, r.item_index, r.item_type, r.module, r.importance) for r in item_rows(df, ["k"]).collect())
    assert got == [(1, 0, "limit", "general", 4), (1, 1, "covered", "general", 3), (2, 0, "covered", "general", 3)]


def test_model_cache(spark):
    w = spark.createDataFrame([("a",), ("b",), ("boom",), ("a",)], "prompt string").withColumn("cache_key", cache_key(F.col("prompt")))

    def client(prompt):
        if prompt == "boom":
            raise ValueError(prompt)
        return prompt.upper()

    first = {r.answer: r.error is None for r in call_model(w, client).collect()}
    assert first == {"A": True, "B": True, None: False}
    cache = spark.createDataFrame([(spark.range(1).select(cache_key(F.lit("a"))).first()[0], "kept", None)], "cache_key string, answer string, error string")
    assert {r.answer for r in call_model(w, client, cache).collect()} == {"kept", "B", None}


def test_summary(spark):
    rows = [(1, "covered", "casco", [], 0.9), (2, "covered", "own_damage", [], 0.8), (3, "covered", "odd", [], 0.7), (4, "not_covered", "wa", ["wa", "glass"], 0.6), (5, "not_covered", "wa", ["pechhulp"], 0.5), (6, "not_covered", "odd", None, 0.4), (7, "admin", "wa", [], 0.3), (8, "obligation", None, [], 0.2)]
    df = spark.createDataFrame([("d", *r) for r in rows], "doc_id string, n int, item_type string, module string, exclusion_scope array<string>, score double")
    s = summarise(df, ["doc_id"], [F.desc("score"), F.asc("n")])
    assert {r.n: r.item_id for r in s.collect()} == {1: "coverage_by_module.all_risk.000", 2: "coverage_by_module.all_risk.001", 4: "exclusions.common.000", 5: "exclusions.by_module.pechhulp.000", 6: "exclusions.by_module.odd.000", 8: "notification_duties.000"}
    page = html_reports(s.withColumns({"headline": F.concat(F.lit("<"), "n"), "exact_quote": F.lit("q")})).first().html
    assert page.count("<li>") == 6 and "&lt;1" in page and page.index("coverage_by_module") < page.index("exclusions.common") < page.index("exclusions.by_module")
    assert spark.range(1).select(replaced_bucket(F.lit("limit"), F.lit("coverage_by_module"))).first()[0] == "coverage_by_module"


def test_balance_stops_at_most(spark):
    rows = [("s", i, i == 0, "coverage_by_module", m) for i, m in enumerate(["wa", "zz", "aa", "general", "wa"])]
    df = spark.createDataFrame(rows, "s string, i int, sel boolean, b string, m string")
    got = lambda most: sorted(r.i for r in balance(df, ["s"], "sel", "b", "m", [F.asc("i")], most).collect())
    assert (got(10), got(3), got(1)) == ([0, 1, 2, 3], [0, 2, 3], [0])


def test_restart(spark, tmp_path):
    runs, stages = [], Stages(spark, str(tmp_path))

    def build():
        runs.append(1)
        return spark.createDataFrame([("a", [1])], "doc_id string, x array<int>")

    assert stages.table("t", build).count() == 1 and stages.table("t", build).count() == 1 and len(runs) == 1
    stages.csv("t", stages.read("t"))
    assert spark.read.csv(f"{tmp_path}/t.csv", header=True).first().x == "[1]"
    stages.documents("j", stages.read("t"))
    assert stages.read_documents("j", "doc_id string, x array<int>", ["a", "b"]).first().x == [1]
