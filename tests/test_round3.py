"""Findings of the third round's reviewer."""

import os
import random
from difflib import SequenceMatcher

import pytest

from foliant.functions import html
from foliant.operators import matching, quotes
from foliant.plans import structure

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", ["list_chunk_clauses", "text_chunk_clauses", "policy_sentences"])
def test_clauses_are_found_once(spark, name):
    """the words of a text are found once, and what is skipped is cleaned once."""
    plan = structure.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^a-z]+") == 1
    assert all(line.count("(?i)^(?:") <= 1 for line in plan.split("\n") if "Filter" in line)


def test_few_texts_are_compared(monkeypatch):
    """F8, F9: once a text is known to be good, those that can't be are not compared, and a long
    text not as a whole; what is left out is below the floor."""
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(200)]
    texts = [" ".join(r.choices(words, k=90)) for _ in range(40)]
    quote = f"{texts[25][:3]}#{texts[25][4:5]}#{texts[25][6:7]}#{texts[25][8:9]}#{texts[25][10:50]}"
    exact = [matching.similarity(quote, t) for t in texts]
    assert all(s < floor or matching.may_reach(quote, t, floor) for s, t in zip(exact, texts, strict=True) for floor in (0.3, s, 0.8, 0.9, 0.98))
    made = []
    monkeypatch.setattr(matching, "SequenceMatcher", lambda *x: made.append(x) or SequenceMatcher(*x))
    n, ones, twos = quotes.profile([quote])
    assert quotes.best_places(quote, 0.8, texts, quotes.profile(texts), (int(n[0]), ones[0], twos[0])) == (0.92, [25])
    assert 0 < len(made) < 10 and all(len(b) == len(quote) for _, _, b in made)


def test_only_large_sections_are_indexed(spark, monkeypatch):
    """F8, F9: grams are taken of the clauses of sections of more than a block alone, and runs
    are not tried where a clause will do."""
    clauses = spark.createDataFrame([(s, i, f"{'abcdefgh'[i % 8] * 3} clause {i * 7919} of {s} and what it says") for s, n in (("small", 3), ("large", 9)) for i in range(n)], "s string, pos long, t string")
    asked = spark.createDataFrame([(1, "small", "bbb clause #919 of small and"), (2, "large", "eee clause 31#76 of large and"), (3, "large", "of large and what it says fff clause 395#5")], "row long, s string, q string")
    indexed, tried, plain = [], [], quotes.floors

    def watched(q, c, *x, **more):
        indexed.append(c)
        tried.append(out := plain(q, c, *x, **more))
        return out

    monkeypatch.setattr(quotes, "floors", watched)
    got = {x.row: (x.places, x.run) for x in quotes.best_clauses(asked, clauses, ["s"], block=4, run_below=0.8).collect()}
    assert got == {1: ([1], False), 2: ([4], False), 3: ([3], True)}
    assert [r.s for r in indexed[0].select("s").distinct().collect()] == ["large"]
    assert {r.row: (r.floor >= 0.8, r.of_run > 0) for r in tried[0].collect()} == {2: (True, False), 3: (False, True)}


def test_plain_tables_are_read_at_once(monkeypatch):
    """markup that can be read in one way only needs no event parser, and any markup gives
    the same with it."""
    r = random.Random(2)
    parts = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", '<td colspan="2">', '<td rowspan="x" class="a b">', "a > b ", "­", " \n", "1. Dit is verzekerd", "2. dit is niet verzekerd", "<p>", "</b>"]
    odd = ["&amp;", "<br>", "<TD>", "<td >", "<", "</td x>", "<!-- <td> -->", "<td colspan=2>", "<script>a<b></script>"]
    texts = ["".join(r.choice(odd) if i % 2 and r.random() < 0.1 else r.choice(parts) for _ in range(r.randint(0, 25))) for i in range(2000)]
    got = [(html.table_of(t), html.text_of(t)) for t in texts]
    with monkeypatch.context() as m:
        m.setattr(html._Events, "plain", lambda *_: False)
        assert got == [(html.table_of(t), html.text_of(t)) for t in texts]
    monkeypatch.setattr(html.HTMLParser, "feed", lambda *_: pytest.fail("parsed by events"))
    table = html.table_of('<table><tr><th colspan="2">wide</th></tr><tr><td>1</td><td>F</td></tr></table>')
    assert table["kind"] == "table_matrix_chunk" and [[c["text"] for c in row["cells"]] for row in table["rows"]] == [["wide"], ["1", "F"]]
