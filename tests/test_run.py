"""A whole run over two documents with clients that need no model."""

import json
import os
import re
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from foliant.operators.chunk_table import with_section_columns
from foliant.operators.extraction import call_model
from foliant.plans import run as plan
from foliant.sources.stages import Stages, in_order, read_summaries, required
from foliant.streaming.ask import answers_of, ask_in_batches


def block(i, kind, text, y, path=None):
    return {"id": i, "block_type": kind, "html": f"<p>{text}</p>", "bbox": [0, y, 90, y + 10], "section_hierarchy": path or {}, "children": []}


def document(name):
    rows = [block("h", "SectionHeader", "Wat is verzekerd", 0), block("a", "Text", f"Schade door brand bij {name}. U meldt schade binnen 3 dagen.", 20, {"1": "h"}), block("b", "ListItem", "Diefstal van de auto", 60, {"1": "h"})]
    return {"children": [{"id": "p", "block_type": "Page", "children": rows}]}


def clients():
    """Made here, so that the workers get them by value."""

    def client(prompt):
        """Every marked clause is an item of its own, quoted in full."""
        found = re.findall(r"\[clause_id=([^\]]+)\][^\n]*\n([^\n]+)", prompt)
        return json.dumps({"items": [{"item_type": "deadline" if "dagen" in t else "covered", "module": "casco", "headline": t[:20], "exact_quote": t, "supporting_clause_ids": [i], "importance": 4} for i, t in found]})

    def chooser(prompt):
        items = json.JSONDecoder().raw_decode(prompt, prompt.index("{\"doc_id\""))[0]["items"]
        return json.dumps({"selected_groups": [{"display_headline": "All", "source_item_ids": [i["id"] for i in items] + ["unknown"]}]})

    return client, chooser


@pytest.mark.parametrize("choose", [False, True])
def test_run(spark, tmp_path, choose):
    client, chooser = clients()
    (tmp_path / "in").mkdir()
    for name in ("one", "two"):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(document(name)))
    (tmp_path / "in" / "bad.json").write_text("{")
    out = str(tmp_path / "out")
    pages = plan.run(spark, str(tmp_path / "in"), out, client, chooser=chooser if choose else None)
    got = {r.doc_id: r for r in pages.collect()}
    assert set(got) == {"one", "two"} and got["one"].n_items == (1 if choose else 3) and ("All" if choose else "Diefstal") in got["one"].html
    items = spark.read.parquet(f"{out}/items.parquet")
    assert items.count() == 6 and items.where("validation_status = 'verified' AND quote_match_score = 1.0").count() == 6
    assert {r.extraction_id for r in items.collect()} == {f"ext_{i:06d}" for i in range(6)}
    assert {r.chunk_id for r in spark.read.parquet(f"{out}/chunks.parquet").collect()} == {f"{d}_sc{n:06d}" for d, n in (("one", 0), ("one", 1), ("two", 2), ("two", 3))}
    did = {r.doc_id: r for r in spark.read.parquet(f"{out}/metadata.parquet").collect()}
    assert did["one"].input_items == 3 and did["one"].invalid_ids == (["unknown"] if choose else [])
    assert plan.run(spark, str(tmp_path / "in"), out, client, from_stage="summary").count() == 2
    with pytest.raises(ValueError):
        plan.run(spark, "", out, client, from_stage="none")


def test_without_a_client(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text(json.dumps(document("one")))
    plan.main([str(tmp_path / "in"), str(tmp_path / "out"), "--all", "--max-words", "5"])
    w = spark.read.parquet(str(tmp_path / "out" / "windows.parquet")).collect()
    assert len(w) > 1 and all(r.clause_ids and r.context_id.startswith("one__Wat is verzekerd__w") for r in w)
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "cost.csv")).first().windows == str(len(w))


def counted(path, answer):
    """A client that notes every call in a file (workers are other processes)."""

    def client(prompt):
        with open(path, "a") as f:
            f.write(f"{len(prompt)}\n")
        return answer(prompt)

    return client


def calls(path):
    return len(path.read_text().splitlines()) if path.exists() else 0


def test_what_is_built_again(spark, tmp_path):
    """Changes of documents, parameters and files build what depends on them, and no more."""
    client, _ = clients()
    (tmp_path / "in").mkdir()
    for name in ("one", "two"):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(document(name)))
    out, asked = str(tmp_path / "out"), tmp_path / "asked"
    go = lambda **k: {r.doc_id for r in plan.run(spark, str(tmp_path / "in"), out, counted(str(asked), client), skip_html=True, **k).select("doc_id").collect()}
    marks = lambda: {n: Stages(spark, out).note(n)["fingerprint"] for n in ("blocks", "chunks", "windows", "answers", "summary")}
    whole = lambda name: (tmp_path / "out" / f"{name}.parquet" / "_SUCCESS").stat().st_mtime_ns
    assert go() == {"one", "two"} and calls(asked) == 2
    first, at = marks(), whole("blocks")
    assert go() == {"one", "two"} and calls(asked) == 2 and marks() == first and whole("blocks") == at
    # documents: all is built for the one, its answer is known
    assert go(doc_ids=["one"]) == {"one"} and calls(asked) == 2 and not set(marks().items()) & set(first.items())
    assert go(doc_ids=["two"]) == {"two"} and {r.doc_id for r in spark.read.parquet(f"{out}/windows.parquet").collect()} == {"two"}
    n = calls(asked)
    # a parameter of the windows leaves the tables before them
    assert go() == {"one", "two"}
    before, at, clauses = marks(), whole("blocks"), whole("clauses")
    assert go(most_words=3) == {"one", "two"} and calls(asked) > n and whole("blocks") == at and whole("clauses") == clauses
    assert {k for k, v in marks().items() if v != before[k]} == {"windows", "answers", "summary"}
    # a file that isn't among the documents changes nothing, one that is does
    go(doc_ids=["one"])
    before = marks()
    (tmp_path / "in" / "three.json").write_text(json.dumps(document("three")))
    assert go(doc_ids=["one"]) == {"one"} and marks() == before
    assert go() == {"one", "two", "three"}
    # a table that was not written whole is built again
    (tmp_path / "out" / "chunks.parquet" / "_SUCCESS").unlink()
    assert go() == {"one", "two", "three"} and whole("chunks")
    assert json.loads((tmp_path / "out" / "run.json").read_text())["validation_stats"] == {"verified": 9}


def test_choosing_in_rounds(spark, tmp_path):
    """Each prompt is asked once a round; too few groups drive the next; answers survive."""
    client, _ = clients()
    (tmp_path / "in").mkdir()
    for name in ("one", "two", "down"):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(document(name)))
    seen = tmp_path / "seen"

    def choose(prompt):
        asked, _ = json.JSONDecoder().raw_decode(prompt, prompt.index('{"doc_id"'))
        ids, n = [i["id"] for i in asked["items"]], prompt.count("groups came back")
        if asked["doc_id"] == "down":
            raise OSError("down")
        # one group, then all; the first document never gives more than one
        groups = [[x] for x in ids] if n and asked["doc_id"] == "two" else [ids[:1]]
        return json.dumps({"selected_groups": [{"source_item_ids": g} for g in groups]})

    chooser = counted(str(seen), choose)
    go = lambda **k: plan.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), client, chooser=chooser, wait=0.0, skip_html=True, **k)
    assert go().select("doc_id").distinct().count() == 3
    # round one asks three, round two those three anew, round three the one that has too few and the one that is down
    assert calls(seen) == 3 + 3 + 2
    did = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "out" / "metadata.parquet")).collect()}
    choices = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "out" / "choices.parquet")).collect()}
    assert {d: c.round for d, c in choices.items()} == {"one": 2, "two": 1, "down": 2}
    assert "down" in did["down"].llm_error and did["one"].llm_error is None and did["down"].fallback_items == 3
    assert (did["one"].minimum_items, did["two"].minimum_items) == (2, 0)
    assert json.loads((tmp_path / "out" / "choice_run.json").read_text())["llm_errors"] == 1
    go()
    assert calls(seen) == 8
    go(from_stage="summary")  # known answers are taken, what failed is asked again in every round
    assert calls(seen) == 8 + 3
    with pytest.raises(RuntimeError, match="down"):
        go(fail_on_error=True)


def test_batches_go_on(spark, tmp_path):
    """A run that ends after some batches asks only the rest when it is taken up."""
    seen, folder = tmp_path / "seen", str(tmp_path / "asks")
    client = counted(str(seen), str.upper)
    asked = spark.createDataFrame([(f"k{i}", f"q{i}") for i in range(20)] + [("k0", "q0")], "cache_key string, prompt string").coalesce(1)
    done = []

    def stop(number):
        done.append(number)
        if len(done) == 3:
            raise KeyError("killed")

    with pytest.raises(StreamingQueryException):
        ask_in_batches(asked, client, folder, rows=4, calls=2, progress=stop)
    before = calls(seen)
    assert 0 < before < 20 and answers_of(spark, folder).count() == before
    got = ask_in_batches(asked, client, folder, rows=4, calls=2)
    assert {(r.cache_key, r.answer) for r in got.collect()} == {(f"k{i}", f"Q{i}") for i in range(20)} and calls(seen) == 20
    # the same again asks nothing; known answers to the same prompts aren't asked in another folder
    assert ask_in_batches(asked, client, folder).count() == 20 and calls(seen) == 20
    other = spark.createDataFrame([("k1", "q1"), ("k2", "changed")], "cache_key string, prompt string")
    got = ask_in_batches(other, client, str(tmp_path / "more"), known=answers_of(spark, folder))
    assert {(r.cache_key, r.answer) for r in got.collect()} == {("k1", "Q1"), ("k2", "CHANGED")} and calls(seen) == 21
    assert ask_in_batches(other.limit(0), client, str(tmp_path / "none")).count() == 0


def test_calls_under_way(spark, tmp_path):
    """Never more calls at once than asked for; a call that takes too long is an error."""
    log = str(tmp_path / "log")

    def slow(prompt):
        with open(log, "a") as f:
            f.write(f"{time.time()} 1\n")
        time.sleep(5 if prompt == "q3" else 0.05)
        with open(log, "a") as f:
            f.write(f"{time.time()} -1\n")
        return prompt

    asked = spark.createDataFrame([(f"k{i}", f"q{i}") for i in range(12)], "cache_key string, prompt string")
    got = {r.cache_key: r for r in call_model(asked, slow, tries=1, timeout=1.0, calls=2).collect()}
    assert "no answer" in got["k3"].error and sum(r.error is None for r in got.values()) == 11
    at, most = 0, 0
    for _, n in sorted((float(a), int(b)) for a, b in (x.split() for x in open(log))):
        at += n
        most = max(most, at)
    assert most <= 3  # two, and the one that was given up


def test_command(spark, tmp_path, capsys, monkeypatch):
    with pytest.raises(SystemExit):
        plan.main([str(tmp_path), str(tmp_path / "out")])
    assert "--all" in capsys.readouterr().err
    env = tmp_path / "env"
    env.write_text("# note\nA=1\nexport B = 'two words'\nbad line\nC=\n")
    assert plan.read_env(str(env)) == {"A": "1", "B": "two words", "C": ""} and plan.read_env(str(tmp_path / "none")) == {}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text(json.dumps(document("one")))
    monkeypatch.setenv("A", "kept")
    plan.main([str(tmp_path / "in"), str(tmp_path / "out"), "--doc-ids", "one", "--client", "json:loads", "--dry-run", "--env-file", str(env)])
    assert os.environ["A"] == "kept" and os.environ.pop("B") == "two words"
    ran = json.loads((tmp_path / "out" / "run.json").read_text())
    assert ran["dry_run"] and ran["n_windows"] == 1 and ran["doc_ids"] == ["one"] and not (tmp_path / "out" / "asked").exists()


def test_tries(spark):
    calls = {"bad": 0}

    def flaky(prompt):
        if prompt.startswith("down"):
            raise OSError("down")
        if prompt.startswith("text"):
            return "no json"
        return '{"n": 2}' if "more" in prompt else '{"n": 1}'

    asked = spark.createDataFrame([("a", "down"), ("b", "text"), ("c", "ask")], "cache_key string, prompt string")
    got = {r.cache_key: r for r in call_model(asked, flaky, wait=0.0, as_json=True, again=lambda x: "more" if '"n": 1' in x else None).collect()}
    assert "down" in got["a"].error and got["b"].error.startswith("no JSON") and got["c"].answer == '{"n": 2}' and calls == {"bad": 0}


def test_documents(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "doc_id string, x int")
    assert sorted((r.place, r.doc_id) for r in in_order(df, ["b", "z", "a", "b"]).collect()) == [(0, "b"), (2, "a"), (3, "b")]
    assert {r.doc_id for r in in_order(df, None).collect()} == {"a", "b"} and required(df, ["a"]).count() == 1
    with pytest.raises(LookupError, match="y, z"):
        required(df, ["a", "z", "y"])
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "visual_summary_items.json").write_text(json.dumps({"model": d}))
    assert {(r.doc_id, r.model) for r in read_summaries(spark, str(tmp_path), "model string").collect()} == {("a", "a"), ("b", "b")}
    c = with_section_columns(df.withColumn("struct_chunk_id", F.col("doc_id"))).first()
    assert (c.chunk_id, c.section_path, c.heading_source) == ("b", "", "original")
    with pytest.raises(ValueError):
        with_section_columns(df)
