"""The quote search against a restatement that holds a section in one list."""

import random
import time

import numpy as np
import pytest

from foliant.operators.matching import normalised, similarity
from foliant.operators.quotes import best_clauses, best_places, bounds, profile, validate_items


def searched(quote, texts, fuzzy=0.8):
    """Best score and places: all ties, and below the threshold the first best run of three."""
    scores = [similarity(quote, t) for t in texts]
    best = max(scores, default=0.0)
    found = [i for i, s in enumerate(scores) if s == best and s > 0]
    if best < fuzzy:
        for a in range(len(texts) - 1):
            s = similarity(quote, " ".join(" ".join(texts[a : a + 3]).split()))
            if s > best:
                best, found = s, list(range(a, min(a + 3, len(texts))))
    return best, found


def tiered(quote, cited, texts, verified=0.95, fuzzy=0.8):
    """Status, score and places by the tiers: cited clauses together, one of them, the section."""
    status = lambda s, other: "verified" if s >= verified else "fuzzy_match" if s >= fuzzy else other
    if cited:
        score = similarity(quote, " ".join(" ".join(texts[i] for i in cited).split()))
        if score >= fuzzy:
            return status(score, ""), score, cited
        single = max(similarity(quote, texts[i]) for i in cited)
        if single >= fuzzy:
            return "fuzzy_match", single, cited
        other, found = searched(quote, texts, fuzzy)
        return (status(other, ""), other, found) if other >= fuzzy else ("weak_match", score, cited)
    score, found = searched(quote, texts, fuzzy)
    return status(score, "unverified"), score, found


def test_tiers():
    texts = ["the quick brown fox jumps over it", "a wholly different clause of text", "x"]
    assert tiered("the quick brown fox", [0], texts) == ("verified", 1.0, [0])
    # the cited clauses say nothing of the quote: the section does
    assert tiered("wholly different clause", [0], texts) == ("verified", 1.0, [1])
    # a short cited clause inside the quote, cited with a long other one
    assert tiered("different clause of the sort x", [2, 0], [texts[0] * 3, "y", "x"]) == ("fuzzy_match", 1.0, [2, 0])
    assert tiered("zzzzzzzzzzzz", [0], texts)[0] == "weak_match" and tiered("zzzzzzzzzzzz", [], texts)[0] == "unverified"
    assert tiered("of text the quick", [], ["clause of text", "the quick fox"]) == ("verified", 1.0, [0, 1])


def test_bounds():
    """No score is above its bound."""
    r = random.Random(7)
    word = lambda: "".join(r.choices("abcdeé ", k=r.randint(1, 6)))
    for _ in range(300):
        texts = [" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(8)]
        quote = " ".join(word() for _ in range(r.randint(1, 12))) if r.random() < 0.5 else "".join(c if r.random() < 0.9 else "#" for c in r.choice(texts)[: r.randint(5, 80)])
        n, ones, twos = profile([quote])
        top, scores = bounds((int(n[0]), ones[0], twos[0]), profile(texts)), [similarity(quote, t) for t in texts]
        held = [quote in t or t in quote for t in texts]
        assert all(s <= b + 1e-9 for s, b, h in zip(scores, top, held) if not h)
        best = max(scores)
        assert best_places(quote, 0.0, texts, profile(texts), (int(n[0]), ones[0], twos[0])) == (best, [i for i, s in enumerate(scores) if s == best] if best else [])


@pytest.fixture(scope="module")
def sections():
    """Sections with repeated, empty and short clauses, and quotes of every kind."""
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(120)]
    out, quotes = {}, []
    for s, n in (("one", 1), ("small", 5), ("large", 60), ("two", 2)):
        texts = [" ".join(r.choices(words, k=r.randint(3, 14))) for _ in range(n)]
        if n > 10:
            texts[7], texts[20], texts[33], texts[34] = texts[3], texts[3], "", "zq"
        out[s] = texts
        for _ in range(4 * min(n, 8)):
            i = r.randrange(n)
            t = texts[i]
            changed = "".join(c if r.random() < r.choice([0.97, 0.85, 0.6]) else r.choice("xyz#") for c in t)
            across = f"{t[len(t) // 3 :]} {texts[min(i + 1, n - 1)][: r.randint(3, 20)]}"
            q = r.choice([t, t[2:-3], changed, changed, across, t.upper(), f"{t} and more of it", " ".join(r.choices(words, k=6)), "ab", "#" * 20, " "])
            cited = r.choice([[], [], [i], [r.randrange(n)], [i, r.randrange(n)], [r.randrange(n)] * 2])
            quotes.append((s, q, cited))
    return out, quotes + [("none", "x", [0]), ("one", "", [0]), ("large", None, []), (None, "abc", [])]


@pytest.mark.parametrize("block", [4, 256])
def test_items_by_brute_force(spark, sections, block):
    texts, quotes = sections
    rows = [(s, i, f"{s}{i}", t, i, i + 1, [float(i), 0.0, 1.0, float(i)] if i % 3 else None) for s, ts in texts.items() for i, t in enumerate(ts)]
    clauses = spark.createDataFrame(rows, "s string, i int, clause_id string, clause_text string, page_start int, page_end int, bbox array<double>").repartition(3)
    items = spark.createDataFrame([(n, s, q, [f"{s}{i}" for i in c] + ["unknown"], 9, "mine") for n, (s, q, c) in enumerate(quotes)], "n int, s string, exact_quote string, supporting_clause_ids array<string>, row int, t string")
    got = validate_items(items, clauses, ["s"], order=["i"], block=block)
    seen = set()
    for r in got.collect():
        s, q, cited = quotes[r.n]
        if not q or s not in texts:
            want = ("unverified", 0.0, [])
        else:
            status, score, places = tiered(" ".join(q.lower().split()), cited, texts[s])
            want = (status, score, [f"{s}{i}" for i in places])
            seen.add((status, bool(cited), len(set(places)) > 1))
        assert (r.validation_status, r.matched_clause_ids) == (want[0], want[2]) and abs(r.quote_match_score - want[1]) < 6e-5, (q, cited, r, want)
        assert (r.row, r.t) == (9, "mine")
        pages = [int(i[len(s) :]) for i in r.matched_clause_ids]
        assert (r.page_start, r.page_end) == ((min(pages), max(pages) + 1) if pages else (None, None))
    assert got.count() == len(quotes) and {x for x, *_ in seen} == {"verified", "fuzzy_match", "weak_match", "unverified"} and ("verified", False, True) in seen
    assert validate_items(items.limit(0), clauses, ["s"], order=["i"]).count() == 0 and validate_items(items, clauses.limit(0), ["s"], order=["i"]).where("validation_status <> 'unverified'").count() == 0


def test_a_section_of_many_clauses(spark):
    """One section of 100,000 clauses: held, changed and spanning quotes."""
    r = np.random.default_rng(0)
    words = np.array(["".join(r.choice(list("abcdefghijklmnopqrstuvw"), 5)) for _ in range(3000)])
    texts = [" ".join(x) for x in words[r.integers(0, 3000, (100_000, 10))]]
    clauses = spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)], "s string, pos long, t string")
    at = r.integers(0, 99_990, 30).tolist()
    quotes = [(texts[i][5:-5], [i], False) for i in at[:10]] + [(texts[i][:20] + "#" + texts[i][21:40] + "#" + texts[i][41:], [i], False) for i in at[10:20]]
    quotes += [(f"{texts[i][-30:]} {texts[i + 1][:30]}", [max(i - 1, 0)], True) for i in at[20:]]
    df = spark.createDataFrame([("s", n, q) for n, (q, *_) in enumerate(quotes)], "s string, row long, q string")
    began = time.time()
    got = {x.row: (x.places, x.run) for x in best_clauses(df, clauses, ["s"], run_below=0.8, block=2048).collect()}
    assert got == {n: (places, run) for n, (_, places, run) in enumerate(quotes)} and time.time() - began < 600


def test_white_space(spark):
    assert [r.x for r in spark.createDataFrame([(" A\u00a0b\n",), (None,)], "x string").select(normalised("x").alias("x")).collect()] == ["a b", ""]
