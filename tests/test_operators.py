from pyspark.sql import functions as F

from foliant.functions.text import clean_clause, escape_html, merge_dependent, normalise_space, section_path, sentences, truncate
from foliant.operators.clauses import split_clauses, window_bounds
from foliant.operators.layout import bbox_union, chunks
from foliant.operators.selection import composite_score, corrected_polarity, greedy_dedup, section_score, supplement


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_text(spark):
    assert one(spark, normalise_space(F.lit(" a b\t\nc­d "))) == "a b cd"
    assert one(spark, normalise_space(F.lit(None).cast("string"))) == ""
    assert one(spark, clean_clause(F.lit("• – x � y"))) == "x € y"
    assert one(spark, truncate(F.lit("abcdefghij"), 8)) == "abcde..."
    assert one(spark, escape_html(F.lit('<a & "b">'))) == "&lt;a &amp; &quot;b&quot;&gt;"


def test_sentences(spark):
    split = lambda t: one(spark, merge_dependent(sentences(F.lit(t)), ("Maar ",)))
    assert split("X y. Zin twee.") == ["X y.", "Zin twee."]
    assert split("X y. Maar z.") == ["X y. Maar z."]
    assert split("A? Dan b.") == ["A? Dan b."]
    df = spark.createDataFrame([(1, "12.\nEen. Twee."), (2, None)], "id int, t string")
    assert [tuple(r) for r in split_clauses(df, "t", ["id"]).orderBy("line", "pos").collect()] == [(1, 1, 0, "Een."), (1, 1, 1, "Twee.")]


def test_section_path(spark):
    headers = F.create_map(F.lit("a"), F.lit("A"), F.lit("b"), F.lit("B"), F.lit("c"), F.lit("C"))
    path = lambda *kv: one(spark, section_path(F.create_map(*map(F.lit, kv)), headers))
    assert path("10", "c", "2", "b", "1", "a") == "A > B > C"
    assert path("1", "a", "2", "?") == "A"
    assert path("x", "a") == ""


def test_windows(spark):
    bounds = lambda words, most: [(x.start, x.end) for x in one(spark, window_bounds(F.array(*map(F.lit, words)), most, 2))]
    assert bounds([10] * 12, 50) == [(0, 5), (3, 8), (6, 11), (9, 12), (10, 12), (11, 12)]
    assert bounds([60] * 4, 50) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert bounds([10, 20], 50) == [(0, 2)]


def test_boxes_and_chunks(spark):
    boxes = F.array(F.array(*map(F.lit, (1.0, 2.0, 3.0, 4.0))), F.array(*map(F.lit, (0.0, 5.0, 2.0, 9.0))))
    assert one(spark, bbox_union(boxes)) == [0.0, 2.0, 3.0, 9.0]
    rows = [("d", 1, "a", None, 0, "Text", "s", "one", [0.0, 0.0, 9.0, 10.0]), ("d", 1, "b", None, 0, "Text", "s", "two", [0.0, 45.0, 9.0, 50.0]), ("d", 1, "c", None, 0, "Text", "s", "far", [0.0, 86.0, 9.0, 90.0]), ("d", 1, "h", None, 0, "SectionHeader", "s", "H", [0.0, 91.0, 9.0, 92.0]), ("d", 1, "n", None, 0, "Text", "s", "•", [0.0, 93.0, 9.0, 94.0]), ("d", 1, "l", "p", 0, "ListItem", "s", "i", [0.0, 200.0, 9.0, 201.0]), ("d", 1, "m", "p", 0, "ListItem", "s", "j", [0.0, 701.0, 9.0, 702.0])]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, block_id string, parent_id string, depth int, block_type string, section_path string, text string, bbox array<double>")
    assert [(r.kind, r.text) for r in chunks(df).orderBy("island").collect()] == [("paragraph", "one two"), ("single_text", "far"), ("list", "- i\n- j")]


def test_scores(spark):
    score = lambda i, s, k, m, d, v: one(spark, composite_score(F.lit(i), F.lit(s), F.lit(k), F.lit(m), F.lit(d), F.lit(v)))
    assert score(5, 1.0, "covered", False, False, "verified") == 0.87
    assert score(5, 1.0, "covered", True, True, "verified") == 0.97
    assert score(5, 1.0, "covered", False, False, "unverified") == 0.609
    assert score(3, 0.3, "condition", False, False, "verified") == 0.475
    assert one(spark, section_score(F.lit("Begrippen"), {"begrippen": 0.1, "verzekerd": 0.9})) == 0.3
    assert one(spark, corrected_polarity(F.lit("not_covered"), F.lit(2), F.lit(1))) == "covered"
    assert one(spark, corrected_polarity(F.lit("limit"), F.lit(1), F.lit(1))) == "limit"
    assert one(spark, corrected_polarity(F.lit("deadline"), F.lit(0), F.lit(1))) == "deadline"


def test_selection(spark):
    df = spark.createDataFrame([("s", "x", 1), ("s", "x", 1), ("s", "x", 2), ("s", "y", 2)], "s string, i string, g int")
    assert sorted((r.i, r.g) for r in greedy_dedup(df, ["s"], "i", "g").collect()) == [("x", 1), ("x", 1), ("y", 2)]
    df = spark.createDataFrame([("s", i, i == 0) for i in range(5)], "s string, i int, c boolean")
    assert sorted(r.i for r in supplement(df, ["s"], "c", [F.asc("i")], 3).collect()) == [0, 1, 2]
