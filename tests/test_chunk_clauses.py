"""Clauses of chunks of every kind."""

import os
import re

import pytest
from pyspark.sql import functions as F

from foliant.functions import lexicon as L
from foliant.operators.chunk_clauses import atomic, chunk_clauses, column_role, inline_bullets, marked, skipped
from foliant.operators.clauses import context_windows
from foliant.plans.reference import turn_clauses

DATA = "/root/testdata/sf0.001"

SCHEMA = "doc_id string, chunk_id string, chunk_kind string, title_text string, section_path string, text_raw string, bbox array<double>, page_start int, pairs array<struct<row_idx:int,insured:string,not_insured:string>>, rows array<struct<row_idx:int,cells:array<struct<text:string>>>>"


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def chunk(kind, text, title="", path="s", bbox=None, pairs=None, rows=None, key="k"):
    return ("d", key, kind, title, path, text, bbox, 1, pairs, rows)


def clauses(spark, *rows):
    got = chunk_clauses(spark.createDataFrame(list(rows), SCHEMA)).orderBy("chunk_id", "clause_position").collect()
    return [(r.clause_id, r.column_role, r.category_hint, r.clause_text) for r in got]


def table(*rows):
    return [(i, [(c,) for c in r]) for i, r in enumerate(rows)]


def test_paired(spark):
    pairs = [(0, "Brand en storm.", "Slijtage. Opzet."), (1, None, "Roest."), (2, "", "")]
    assert clauses(spark, chunk("table_paired_chunk", "", pairs=pairs)) == [
        ("d:k:r0:c0", "insured", "", "Brand en storm."),
        ("d:k:r0:c1", "not_insured", "not_covered", "Slijtage."),
        ("d:k:r0:c2", "not_insured", "not_covered", "Opzet."),
        ("d:k:r1:c3", "not_insured", "not_covered", "Roest."),
    ]
    assert clauses(spark, chunk("table_paired_chunk", "Zonder rijen.")) == [("d:k:rna:c0", "unknown", "", "Zonder rijen.")]


def test_matrices(spark):
    rows = table(("Leeftijd", "Eerste jaar", "Later"), ("Tot 1 jaar", "nieuwwaarde", "dagwaarde"), ("x", ""), ("Ouder", "a", "b"))
    got = clauses(spark, chunk("table_matrix_chunk", "Samenvatting waardebepaling", rows=rows))
    assert [(c[0], c[2]) for c in got] == [(f"d:k:rna:c{i}", h) for i, h in enumerate(["condition", "limit"] * 2)]
    assert got[0][3].startswith("Tot 1 jaar. ") and got[0][3].endswith(" nieuwwaarde.")
    assert clauses(spark, chunk("table_matrix_chunk", "samenvatting waardebepaling", rows=rows[:2])) == []
    rows = table(("Hersteller A", "100% vergoeding"), ("Hersteller B", "geen vergoeding"), ("Hersteller C", "100% vergoeding", "eigen bijdrage 50"))
    assert [c[2] for c in clauses(spark, chunk("table_matrix_chunk", "Reparatie door:", rows=rows))] == ["not_covered", "condition"]
    assert [c[3] for c in clauses(spark, chunk("table_matrix_chunk", "Gewone tekst.", rows=rows))] == ["Gewone tekst."]


def test_lists_and_texts(spark):
    assert [c[2:] for c in clauses(spark, chunk("list_chunk", "- ruit\r\n\n- 12.\n- deur", title="Verzekerd zijn"))] == [("covered", "ruit"), ("covered", "deur")]
    assert [c[0] for c in clauses(spark, chunk("list_chunk", "- ruit\n- 12.\n- deur"))] == ["d:k:rna:c0", "d:k:rna:c2"]
    assert clauses(spark, chunk("list_chunk", "- opzet", title="Nooit verzekerd"))[0][2] == "not_covered"
    got = clauses(spark, chunk("paragraph_chunk", "Wij betalen. Maximale vergoeding: 50 euro. Bijzonderheden: alleen thuis."))
    assert [c[2] for c in got] == ["", "limit", "condition"] and got[2][3] == "alleen thuis."
    assert clauses(spark, chunk("single_text_chunk", "Oorlog.", title="Dit is nooit verzekerd"))[0][2] == "not_covered"
    assert clauses(spark, chunk("table_other_chunk", None), chunk(None, "", title=None, path=None)) == []


def test_atomic(spark):
    assert one(spark, inline_bullets(F.lit("prefix: • a • b"))) == ["prefix: a", "prefix: b"]
    assert one(spark, atomic(F.lit("A? Dan b."))) == ["A? Dan b."]
    assert one(spark, atomic(F.lit("X y. Maar z. Zin twee."))) == ["X y. Maar z.", "Zin twee."]
    assert one(spark, atomic(F.lit("Tot max. 5 dagen. Per jaar btw. 7."))) == ["Tot max. 5 dagen.", "Per jaar btw. 7."]
    assert one(spark, atomic(F.lit(""))) == [] and one(spark, atomic(F.lit(None).cast("string"))) == []


def test_roles(spark):
    box = lambda a, b: F.array(F.lit(a), F.lit(0.0), F.lit(b), F.lit(1.0))
    role = lambda title="", path="", text="", at=F.lit(None).cast("array<double>"), kind="list_chunk", given="": one(spark, column_role(*map(F.lit, (kind, given, title, path, text)), at))
    assert role("Dit is verzekerd") == "insured" and role(path="Dit is  niet verzekerd") == "not_insured"
    both = "1. Dit is verzekerd 2. Dit is niet verzekerd"
    assert role(both) == "unknown" and role(both, at=box(0.0, 100.0)) == "insured" and role(both, at=box(300.0, 300.0)) == "not_insured"
    assert role(text="Als het regent", at=box(300.0, 400.0)) == "not_insured" and role(text="Als het regent", at=box(0.0, 4.0)) == "unknown"
    assert role(kind="table_paired_row", given="insured") == "insured" and role(kind="table_paired_row") == "unknown"


def test_skips(spark):
    for text, skip in (("", True), ("12:", True), ("Zie paragraaf 3", True), ("Met schade bedoelen we dit", True), ("Maximale vergoeding:", True), ("Schade aan ruiten", False)):
        assert one(spark, skipped(F.lit(text))) is skip


def test_marked_windows(spark):
    df = spark.createDataFrame([("s", 0, "c0", "insured", "", "een twee"), ("s", 1, "c1", "unknown", "limit", "drie")], "s string, i int, clause_id string, role string, hint string, t string")
    got = context_windows(df.withColumn("m", marked(F.col("clause_id"), F.col("role"), F.col("hint"), F.col("t"))), ["s"], ["i"], "m").first()
    assert got.context_text == "[clause_id=c0] [column=insured]\neen twee\n\n[clause_id=c1] [hint=limit]\ndrie"


def plain_clauses(text):
    """Lists in plain Python: lines, bullets, sentences, dependents, skips."""
    clean = lambda t: re.sub(r"^(Bijzonderheden:|1\. Dit is verzekerd 2\. Dit is niet verzekerd\s+)", "", re.sub(r"^[-•‣●◦\s]+", "", " ".join((t or "").replace("\xad", "").replace("�", "€").split())), flags=re.I).strip()
    out = []
    for line in map(clean, (text or "").replace("\r", "").split("\n")):
        head, *items = re.split(r"\s*[•‣●◦·]\s*", line)
        whole = [clean(f"{head} {i}") for i in map(clean, items) if i] if items else [head]
        for part in filter(None, whole):
            done: list[str] = []
            for s in filter(None, map(clean, re.split(r"(?<=[.!?])(?<!max\.)(?<!p\.p\.)(?<!btw\.)(?<!bovag\.)(?!(?<=\?) Dan )\s+(?=[A-ZÀ-Ý0-9])", part))):
                if done and (done[-1].endswith("?") or s.lower().startswith(L.DEPENDENT)):
                    done[-1] += f" {s}"
                else:
                    done.append(s)
            out += done
    low = [c.lower() for c in out]
    skip = [re.fullmatch(r"\d+[.:]?", c) or any(p in c for p in L.SKIP_PHRASES) or c in L.SKIP_HEADINGS or c.startswith(L.SKIP_STARTS) for c in low]
    return [(i, c) for i, (c, s) in enumerate(zip(out, skip, strict=True)) if not s]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_against_plain_python(spark):
    turns = spark.read.parquet(f"{DATA}/conversations.parquet").collect()
    want = sorted((f"{r.conv_id}:{r.turn}:rna:c{i}", c) for r in turns for i, c in plain_clauses(r.text))
    assert sorted((r.clause_id, r.clause_text) for r in turn_clauses(spark, DATA).collect()) == want and want
