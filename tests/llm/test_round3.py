"""Operators 11 to 13 against brute force, and their odd cases."""

import hashlib
import os
import random
import re
import zlib
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import queries
from foliant.llm.filter_audit import audit, first_failures, text_filters
from foliant.llm.hashing import mix
from foliant.llm.jaccard_join import bitmap, bucket_keys, fine_bands, folded, may_be_similar, similar_groups
from foliant.llm.periodic_runs import collapse_runs, document_runs, periodic_runs, runs_of

DATA = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, least=24, times=3):
    out = []
    for p in range(1, len(w) // times + 1):
        same = [False, *(a == b for a, b in zip(w, w[p:])), False]
        edges = [i for i in range(1, len(same)) if same[i] != same[i - 1]]
        for s, e in zip(edges[::2], edges[1::2]):
            s, e = s - 1, e - 1 + p
            if e - s >= max(least, times * p) and not any(a <= s and e <= a + n and p % q == 0 for a, n, q in out):
                out.append((s, e - s, p))
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_runs_by_brute_force():
    r, seen = random.Random(1), 0
    for _ in range(1500):
        least, times, w = r.choice([1, 3, 6, 10, 24]), r.choice([3, 3, 4]), []
        for _ in range(r.randint(0, 4)):
            block = [r.choice("ab" if r.random() < 0.5 else "abcde").encode() for _ in range(r.randint(1, r.choice([2, 5, 15])))]
            w += [block[i % len(block)] for i in range(r.randint(0, 9 * len(block)))] + [r.choice("abcz").encode() for _ in range(r.randint(0, 6))]
        ids = {}
        want, codes = plain_runs(w, least, times), np.array([ids.setdefault(x, len(ids)) for x in w], np.int64)
        assert runs_of(codes, least, times) == want == document_runs(w, least, times)
        seen += len(want)
    assert seen > 500


def test_long_runs():
    """One word, few words and words of a morphism, 30,000 of each: time stays near linear."""
    assert runs_of(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    assert runs_of(np.arange(30_000) % 70) == [(0, 30_000, 70)]
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert runs_of(np.array(b)) == plain_runs(b)
    # cubes do not occur here, whatever windows hash to
    assert runs_of(np.array([i.bit_count() % 2 for i in range(1 << 15)]), least=3) == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_op11_by_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_periodic_runs"](spark, DATA).collect()}
    for i, text in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        w, h = WORDS.findall(text or ""), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + k % p] for k in range(n - a)]
        codes = {}
        runs = plain_runs([codes.setdefault(x, len(codes)) for x in w]) if n < 4000 else document_runs([x.encode() for x in w])
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
        assert got.pop(i) == want
    assert not got


def test_periodic_runs_on_odd_rows(spark):
    often = " ".join(["a b"] * 15)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, often), (4, often), (None, f"x {often}\x0by"), (5, " ".join(["é"] * 40 + ["É"])), (6, "w " * 200_000)]
    df = spark.createDataFrame([(*r, "mine", 7) for r in rows], "doc_id long, text string, runs string, __part int")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed) for r in periodic_runs(df).collect()]
    one = (30, [(0, 30, 2)], (0, 30, 2), "a b")
    assert sorted(got, key=str) == sorted([(1, 0, [], None, ""), (2, 0, [], None, ""), (3, 0, [], None, ""), (4, *one), (4, *one), (None, 32, [(1, 30, 2)], (1, 30, 2), "x a b y"), (5, 41, [(0, 40, 1)], (0, 40, 1), "é É"), (6, 200_000, [(0, 200_000, 1)], (0, 200_000, 1), "w")], key=str)
    # of equally strong runs the first
    tie = spark.createDataFrame([(1, " ".join(["a b c"] * 10 + ["x"] + ["d e"] * 15 + ["y"] + ["f g"] * 15))], "doc_id long, text string")
    assert tuple(periodic_runs(tie).first().strongest) == (31, 30, 2)
    cut = collapse_runs(df)
    assert cut.columns == df.columns and sorted(("-" if r.text is None else r.text, r.runs, r["__part"]) for r in cut.collect()) == sorted((x, "mine", 7) for x in ("-", "", " \n\t", "a b", "a b", "x a b y", "é É", "w"))
    assert periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(df, times=2)


def test_first_failures():
    table = first_failures(5)
    assert table.shape == (32, 120)
    for i, order in enumerate(permutations(range(5))):
        for mask in range(32):
            assert table[mask, i] == next((s for s, f in enumerate(order) if mask >> f & 1), 5)


def test_audit_by_simulation(spark):
    """Random flags, every order played through document by document."""
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None, ""]), *(r.random() < 0.3 or (None if r.random() < 0.1 else False) for _ in range(4)), r.choice([True, False, None])) for _ in range(400)]
    got = {tuple(x)[:3]: tuple(x)[3:] for x in audit(spark.createDataFrame(rows, "part string, W boolean, X boolean, Y boolean, Z boolean, good boolean"), "part", [*"WXYZ"], ["good"]).collect()}
    shapley, want = {}, {}
    for part in {p or "" for p, *_ in rows}:
        own = [(dict(zip("WXYZ", map(bool, f), strict=True)), bool(g)) for p, *f, g in rows if (p or "") == part]
        for order in permutations("WXYZ"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[0][f]]
                left = [x for x in left if not x[0][f]]
                redundant = sum(x[0][f] for x in own) - len(gone)
                alone = sum(x[0][f] and sum(x[0].values()) == 1 for x in own)
                want[part, "".join(order), step] = (len(left), len(gone), redundant, alone, sum(g for _, g in gone))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    assert got == {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}


def test_text_filters_on_odd_rows(spark):
    clean = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, "s"), (2, "", "s"), (3, clean, "s"), (None, clean, "s"), (4, clean, None), (4, clean, None), (5, clean.upper(), "s"), (6, clean + " 100%", "s"), (7, "w " * 50_000, "s")]
    df = spark.createDataFrame([(*r, True, 1) for r in rows], "doc_id long, text string, source string, A boolean, __n int")
    labels = spark.createDataFrame([(3, 1, None), (3, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    got = sorted(("".join(f for f in "ABCDE" if r[f]), r.part or "", bool(r.good), bool(r.toxic)) for r in text_filters(df, labels).collect())
    assert got == sorted([("A", "s", False, False), ("AE", "s", False, False), ("", "s", True, True), ("", "s", False, False), ("E", "", False, False), ("E", "", False, False), ("C", "s", False, False), ("D", "s", False, False), ("B", "s", False, False)])
    assert audit(text_filters(df.limit(0), labels), "part", [*"ABCDE"], ["good"]).count() == 0
    every = audit(text_filters(df, labels.limit(0)), "part", [*"ABCDE"], ["good"]).toPandas()
    assert len(every) == 2 * 600 and not every.good_lost.any()


def test_no_similar_pair_is_lost():
    """Pairs around the threshold share a bucket, bitmaps don't part them, fine bands adjoin."""
    r, ends, links = np.random.default_rng(0), fine_bands(80), 0
    for _ in range(6000):
        x = np.unique(mix(r.integers(0, 1 << 62, int(np.exp(r.uniform(0, 6.5)))).astype(np.uint64)))
        n = len(x)
        kept = r.permutation(x)[: max(1, n - int(r.integers(0, n // 4 + 1)))]
        y = np.unique(np.concatenate([kept, mix(r.integers(0, 1 << 62, int(r.integers(0, n // 4 + 1))).astype(np.uint64))]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (n + len(y) - both):
            maps = [bitmap(x), bitmap(y)]
            a, b = folded(maps, min(map(len, maps)))
            differ = np.array([np.bitwise_count(a ^ b).sum()], np.int64)
            assert len(np.intersect1d(bucket_keys(x, 80), bucket_keys(y, 80))) and may_be_similar(differ, np.array([n]), np.array([len(y)]), 80)[0]
            assert abs(np.searchsorted(ends, n, "right") - np.searchsorted(ends, len(y), "right")) <= 1
            links += 1
    assert links > 2000


def _groups(rows, percent):
    sets = []
    for _, t in rows:
        w = [x.lower() for x in WORDS.findall(t or "")]
        m = min(5, len(w))
        sets.append({tuple(w[k : k + m]) for k in range(len(w) - m + 1)} if m else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[root(i)] = min(doc, smallest.get(root(i), doc))
    return sorted(((doc, len(s), smallest.get(root(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize(("percent", "block"), [(80, 512), (80, 4), (60, 4)])
def test_similar_groups_by_brute_force(spark, percent, block):
    """Families of edited copies that drift, so that leads alone don't join them."""
    r = random.Random(percent + block)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    passage, texts = [word() for _ in range(60)], []
    for i in range(180):
        if i % 6 == 0 or not texts:
            w = [word() for _ in range(r.choice([3, 9, 40, 90, 200]))]
            w += passage if r.random() < 0.6 else []
        else:
            w = list(r.choice(texts[-12:]))
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                k = r.randrange(len(w))
                w[k : k + 1] = r.choice([[], [word()], [w[k], word()]])
        texts.append(w or ["x"])
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    got = similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent, block=block).collect()
    want = _groups(rows, percent)
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == want
    assert len({c for _, _, c in want}) < 150


def test_similar_groups_on_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(None, None), (1, ""), (2, " \n"), (9, base), (3, base.upper()), (None, base), (9, base), (4, "one two"), (5, "One\ttwo"), (6, "one"), (7, "a b c d e f g h"), (8, "a b c d e f g h i"), (None, "alone here"), (10, "v " * 100_000)]
    df = spark.createDataFrame([(*x, 1, "t", 3) for x in rows], "doc_id long, text string, node long, key string, n long")
    for limit in (500_000, 0):
        got = similar_groups(df, broadcast_rows=limit).collect()
        assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == _groups(rows, 80)
        assert all(x.component is not None for x in got)
    assert similar_groups(df.limit(0)).count() == 0
    assert similar_groups(df.where(F.col("doc_id").isin(1, 2))).count() == 2
