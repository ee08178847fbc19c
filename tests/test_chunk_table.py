"""Tables among chunks, numbers over documents, PDF files."""

import json

import pytest
from pyspark.sql import functions as F

from foliant.operators.chunk_clauses import chunk_clauses
from foliant.operators.chunk_table import chunk_table
from foliant.operators.tree import flatten_layout, useful_blocks
from foliant.sources.stages import Stages, convert, read_pdfs

HTML = "<table><tr><th>1. Dit is verzekerd</th><th>2. Dit is niet verzekerd</th></tr><tr><td>Brand</td><td>Opzet</td></tr></table>"


def block(i, kind, html, y, children=(), **more):
    return {"id": i, "block_type": kind, "html": html, "bbox": [0, y, 9, y + 1], "children": list(children), **more}


def layout(spark, *docs):
    return useful_blocks(flatten_layout(spark.createDataFrame(docs, "doc_id string, json string")))


def test_tables(spark):
    cells = [block("c2", "TableCell", "Opzet", 30), block("c1", "TableCell", "Brand", 20)]
    page = [block("h", "SectionHeader", "Kop", 0), block("t", "Table", HTML, 5, cells, section_hierarchy={"1": "h"}), block("p", "Text", "los", 90)]
    got = chunk_table(layout(spark, ("d", json.dumps({"children": [{"block_type": "Page", "children": page}]}))))
    table, text = got.orderBy("page_start", "island").collect()
    assert table.chunk_kind == "table_paired_chunk" and table.title_text == "Kop" and table.text_with_title.startswith("Kop\n")
    assert table.source_block_ids == ["t", "c1", "c2"] and table.n_blocks == 3 and table.bbox == [0.0, 5.0, 9.0, 31.0]
    assert [tuple(r) for r in table.pairs] == [(0, "Brand", "Opzet")]
    assert (text.chunk_kind, text.title_text, text.text_with_title) == ("single_text_chunk", "", "los")
    clauses = chunk_clauses(got.withColumn("chunk_id", F.col("island").cast("string"))).where("chunk_kind like 'table%'").orderBy("clause_position").collect()
    assert [(c.column_role, c.clause_text, c.section_id) for c in clauses] == [("insured", "Brand", "Kop"), ("not_insured", "Opzet", "Kop")]


def test_numbers(spark, tmp_path):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("x")).repartition(7)
    got = Stages(spark, str(tmp_path)).numbered("n", lambda: df, ["x"], "at")
    want = sorted(r.x for r in df.collect())
    assert [r.x for r in got.orderBy("at").collect()] == want and sorted(r["at"] for r in got.collect()) == list(range(100))
    assert Stages(spark, str(tmp_path)).numbered("e", lambda: df.limit(0), ["x"], "at").count() == 0


def test_pdfs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_pdfs(spark, str(tmp_path))
    for name in ("a.pdf", "b.PDF", "c.txt"):
        (tmp_path / name).write_bytes(name.encode())
    pdfs = read_pdfs(spark, str(tmp_path))
    done = spark.createDataFrame([("a",)], "doc_id string")
    assert [tuple(r) for r in convert(pdfs, lambda b: b.decode().upper(), done).collect()] == [("b", "B.PDF")]
    assert read_pdfs(spark, str(tmp_path), ["a"]).count() == 1
