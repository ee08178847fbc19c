import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from foliant.llm import hashing
from foliant.llm.decontamination import contamination_digest, digest_of, find_contamination
from foliant.llm.language_id import identify_languages
from foliant.llm.license_scan import TEMPLATES, align, scan_licenses, words_of
from foliant.llm.near_dedup import near_duplicate_groups
from foliant.llm.packing import minimum_bin_slack, pack_documents
from foliant.llm.quality import rate_documents, train
from foliant.llm.suffix_dedup import front_code, merge, remove_repeats, repeated_spans
from foliant.llm.topk import top_k
from foliant.llm.toxicity import score_toxicity
from foliant.llm.url_filter import judge_urls

RANDOM = random.Random(5)
WORDS = ["".join(RANDOM.choices("abcdefgh", k=RANDOM.randint(2, 7))) for _ in range(300)]
JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def text(n):
    return " ".join(RANDOM.choices(WORDS, k=n))


def fixture():
    base, passage = text(200), text(90)
    edited = base.split()
    edited[50:52] = ["changed", "words"]
    rows = [(0, base), (1, base), (2, " ".join(edited)), (3, base.upper()), (4, None), (5, ""), (6, " \n "), (7, "one two"), (8, "One  two"), (9, "x" * 900), (9, "x" * 900), (10, text(3000)), (None, text(40)), (None, base)]
    rows += [(20 + i, f"{text(60)} {passage} {text(50)}") for i in range(5)] + [(30, "é" * 700 + text(30))]
    return [(i, t, "en", "s0", -1, "clash") for i, t in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_topk(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), rng.normal(size=12).astype(float).tolist()) for i in range(700)] + [(700, None), (800, [float("nan")] * 12), (900, [1.0, None]), (None, [1.0] * 12), (300, None), (1000, [0.5] * 3)]
    rows += [(i + 2000, rows[i][1]) for i in range(5)] + [rows[3]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = {i: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in good if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q)[:10]
        want |= {(q, n, c, -s) for n, (s, c) in enumerate(scores, 1)}
    assert {tuple(r) for r in top_k(df, candidate_block=128).collect()} == want
    assert top_k(df.limit(0)).count() == 0


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(JSON)
    odd = [(100, " lead  two\n tail ", "", "", 0, ""), (101, "a <|endoftext|> b", "", "", 0, "")]
    both = docs.unionByName(spark.createDataFrame(odd, SCHEMA))
    pieces = pack_documents(both, JSON, RANKS, with_ids=True).toPandas()
    sums = pieces.groupby("sequence_id").length.sum()
    assert ((sums == 1024) | ((sums & (sums - 1)) == 0)).all()
    for _, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in pieces.itertuples())
    for i, t, *_ in [r for r in fixture() if r[0] is not None and r[0] not in (9, 10) and r[0] < 20] + odd:
        got = b"".join(pieces[pieces.doc_id == i].sort_values("start").ids)
        if i in (100, 101, 4, 5, 6, 7, 8):
            assert np.frombuffer(got, "<u4").tolist() == [*tok.encode(t or "", add_special_tokens=False).ids, 0]
    assert pack_documents(empty, JSON, RANKS).count() == 0
    plan = minimum_bin_slack({600: 1000, 512: 3, 3: 1}, 1024)
    assert plan.n_sequences < 620  # 600s alone would need 1000


def test_decontamination(spark, docs, empty):
    items = [(1, text(15)), (2, "one two"), (3, None), (4, "!!"), (None, "changed words"), (10, docs.where("doc_id = 10").first().text[500:700])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for shard in (8 << 20, 1):
        got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in contamination_digest(find_contamination(docs, bench, shard_bytes=shard)).collect()}
        split = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "").lower()).split()
        want = set()
        for i, t, *_ in fixture_rows(docs):
            w, hit, found = split(t), set(), set()
            for item, body in items:
                b = split(body)
                m = min(10, len(b))
                wins = {tuple(b[k : k + m]) for k in range(len(b) - m + 1)} if m else set()
                for k in range(len(w) - m + 1 if m else 0):
                    if tuple(w[k : k + m]) in wins:
                        hit |= set(range(k, k + m))
                        found.add("null" if item is None else str(item))
            want.add((i, len(w), len(hit), len(found), digest_of(found), bool(hit)))
        assert got == want
    assert find_contamination(empty, bench).count() == 0
    assert not find_contamination(docs, bench.limit(0)).where("n_hit > 0").count()


def fixture_rows(docs):
    return [tuple(r) for r in docs.collect()]


def test_near_duplicates(docs, empty):
    got = near_duplicate_groups(docs).toPandas()
    by = got.dropna().groupby("doc_id").component_id.first()
    assert by[0] == by[1] == by[2] == by[3] == 0 and by[7] == by[8] == 7 and by[9] == 9 and by[10] == 10
    assert all(by[i] == i for i in (4, 5, 6)) and len({by[20 + i] for i in range(5)}) == 5
    assert len(got) == len(fixture()) and sorted(got[got.component_id == 0].doc_id.dropna()) == [0, 1, 2, 3]
    assert near_duplicate_groups(empty).count() == 0


def test_near_duplicates_brute_force(spark):
    rows = []
    for i in range(120):
        if i % 3 == 0 or not rows:
            w = text(80).split()
        else:
            w = rows[RANDOM.randrange(len(rows))][1].split()
            for _ in range(RANDOM.randint(0, 3)):
                w[RANDOM.randrange(len(w))] = "edit%d" % RANDOM.randrange(9)
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), block=8).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(sets[i]), root(i)) for i, _ in rows}


def spans_by_brute_force(texts, size):
    seen = {}
    for t in texts:
        for i in range(len(t) - size + 1):
            seen[t[i : i + size]] = seen.get(t[i : i + size], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = True
        out.append(gone)
    return out


@pytest.mark.parametrize(("size", "w"), [(400, 151), (60, 24)])
def test_repeats(docs, empty, size, w):
    rows = fixture_rows(docs)
    texts = [(r[1] or "").encode() for r in rows]
    want = sorted((str(r[0]), len(t), int(g.sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~g].tobytes()).hexdigest()) for r, t, g in zip(rows, texts, spans_by_brute_force(texts, size), strict=True))
    got = repeated_spans(docs, size=size, w=w, run_rows=50).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == want
    assert all(a.end < b.start for r in got for a, b in zip(r.spans, r.spans[1:]))
    assert repeated_spans(empty, size=size, w=w).count() == 0


def test_passages(spark, docs):
    rows = fixture_rows(docs)
    texts = [(r[1] or "").encode() for r in rows]
    got = {(str(r.doc_id), r.n_bytes, r.n_removed, r.n_passage) for r in repeated_spans(docs, size=80, passage=30, words=6, w=12, block=4, run_rows=50, range_rows=100).collect()}
    want = set()
    for r, t, short, full in zip(rows, texts, spans_by_brute_force(texts, 30), spans_by_brute_force(texts, 80), strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], short.astype(np.int8), [0]])))
        n = sum(int(e - b) for b, e in edges.reshape(-1, 2) if e - b >= 80 or len(t[b:e].split()) > 6)
        want.add((str(r[0]), len(t), int(full.sum()), n))
    assert got == want
    # cut texts hold the same bytes, whatever a caller's columns are named
    named = docs.withColumn("h", F.lit("mine")).withColumn("kept", F.lit(1)).withColumn("row", F.lit(2))
    cut = remove_repeats(named, size=80, passage=30, words=6, w=12, block=4)
    assert cut.columns == named.columns and {(x.h, x.kept, x.row) for x in cut.collect()} == {("mine", 1, 2)}
    assert cut.where("text IS NULL").count() == docs.where("text IS NULL").count()


def test_remove_repeats_keeps_columns(docs):
    out = remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_loser_tree():
    rng = np.random.default_rng(1)
    runs = [sorted({bytes(rng.integers(0, 3, 6, dtype=np.uint8)) for _ in range(n)}) for n in (40, 0, 7, 90, 1)]
    coded = [(lambda c: (c[0].tobytes(), c[1]))(front_code(np.array([list(k) for k in r], np.uint8).reshape(-1, 6))) for r in runs]
    merged = [runs[r][i] for _, r, i in merge(coded, 6)]
    assert merged == sorted(k for r in runs for k in r)
    prefixes = [h for h, _, _ in merge(coded, 6)]
    assert all(h == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), 6) for a, b, h in zip(merged, merged[1:], prefixes[1:]))


def test_shingles():
    a, b = hashing.shingles(b"A b c d e f", 5), hashing.shingles(b"a B  c\td e\nf", 5)
    assert len(a) == 2 and (a == b).all() and not len(hashing.shingles(b" ", 5)) and len(hashing.shingles(b"a b", 5)) == 1


def test_urls(spark):
    urls = ["http://a.com/x", "http://EXAMPLE.com/en/x", "http://www.example.com/en/x?q", "https://u:net/es/", "http://x.net/es/a", "http://x.net", "no scheme", None, "http://x.org/fr/1#t", "http://notnet/es/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r.page_id: r for r in judge_urls(df).collect()}
    assert [got[i].rule for i in range(10)] == ["com/", "example.com/en/", "www.example.com/en/", None, "net/es/", None, None, None, None, None]
    assert [got[i].verdict for i in (0, 1, 2, 4)] == ["allow", "block", "allow", "block"] and got[7].host == got[6].path == ""
    assert all(got[i].verdict in ("allow", "block") for i in range(10)) and judge_urls(df.limit(0)).count() == 0


def test_languages(spark, empty):
    rows = [(i, " ".join(RANDOM.choices(["the", "and", "of", "house"], k=30)), "en", "a") for i in range(40)] + [(100 + i, " ".join(RANDOM.choices(["der", "und", "von", "haus"], k=30)), "de", "b") for i in range(40)]
    rows += [(900, "der und von haus der und", "en", "a"), (901, None, "en", None), (902, "12 !!", None, "zz"), (903, "the house of", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.row.doc_id: r for r in identify_languages(df, temper=1.0).collect()}
    assert got[900].language == "de" and got[903].language == "en" and got[901].rejected and got[902].rejected
    assert sum(got[i].language == "en" for i in range(40)) == 40 and identify_languages(empty).count() == 0


def test_rare_languages(spark):
    # 3 documents in 5000 declare "cy"; "more" are 89 languages of one document each
    rare = ["mae", "yn", "ac", "ty"]
    more = [f"{a}{b}" for a in "abcdefghi" for b in "klmnopqrst" if a + b != "en"]
    rows = [(i, " ".join(RANDOM.choices(["the", "and", "of", "house"], k=30)), "en", "a") for i in range(5000)]
    rows += [(9000 + i, " ".join(RANDOM.choices(rare, k=60)), "cy", "a") for i in range(3)]
    rows += [(9100 + i, f"{x}{x[::-1]}q {x}w{x}z " * 20, x, "b") for i, x in enumerate(more)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = {9000 + i: "cy" for i in range(3)} | {9100 + i: x for i, x in enumerate(more)}
    one, many = ({r.row.doc_id: (r.language, round(r.confidence, 6)) for r in identify_languages(df, shard=n).collect()} for n in (512, 40))
    assert {i: one[i][0] for i in want} == want and sum(one[i][0] == "en" for i in range(5000)) == 5000
    assert one == many


def test_quality(spark, empty):
    rows = [(i, " ".join(RANDOM.choices(["good", "fine", "bad###"] if i % 3 == 1 else ["good", "fine"] if i % 3 == 2 else ["bad###", "###"], k=40)), i % 3) for i in range(240)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(999, None)], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, g) for i, _, g in rows] + [(5000, None)], "doc_id long, quality int")
    model = train(df, ratings)
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in rate_documents(df, model).collect()}
    means = [np.mean([got[i].expected_grade for i, _, g in rows if g == k]) for k in range(3)]
    assert means[0] < 0.5 < means[1] < 1.5 < means[2] and all(r.tails[0] >= r.tails[1] for r in got.values())
    assert rate_documents(empty, train(empty, ratings.limit(0))).count() == 0


def test_toxicity(spark, empty):
    clean = lambda: text(30)
    rows = [(i, f"{clean()} {RANDOM.choice(['idiot', 'moron'])} {clean()}" if i % 10 == 0 else clean()) for i in range(600)]
    rows += [(1000, f"{clean()} 1d10t {clean()}"), (1001, f"{clean()} m o r o n {clean()}"), (1002, f"{clean()} idiiiiot {clean()}"), (1003, f"{clean()} m.o.r.0.n, {clean()}"), (1004, clean()), (1005, None), (1006, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(600)] + [(7, None)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in score_toxicity(df, labels, shrink=2.0, margin=1.0).collect()}
    assert all(got[i] >= 0.5 for i in (1000, 1001, 1002, 1003)) and all(got[i] < 0.5 for i in (1004, 1005, 1006))
    assert score_toxicity(empty, labels).count() == 0 and score_toxicity(df, labels.limit(0)).where("score >= 0.5").count() == 0


def test_toxic_words_in_runs(spark):
    # a short spaced word, words before and after the spaced one, long tokens
    clean = lambda: text(30)
    hidden = ["what a m o r o n", "y o u i d i o t", "y o u i d i o t s t o p", "a m.o.r.0.n", "z o b", "i" + "d" * 80 + "iot", "-".join(["abcdefgh"] * 8 + ["moron"] + ["hgfe"] * 3)]
    rows = [(i, f"{clean()} {RANDOM.choice(['idiot', 'moron', 'zob'])} {clean()}" if i % 10 == 0 else clean()) for i in range(600)]
    rows += [(1000 + i, f"{clean()} {t} {clean()}") for i, t in enumerate(hidden)] + [(1100, f"{clean()} a b c d e f {clean()}"), (1101, f"{clean()} {'a b c ' * 3000}"), (1102, "ab-" * 20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(600)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in score_toxicity(df, labels, shrink=2.0, margin=1.0).collect()}
    assert [t for i, t in enumerate(hidden) if got[1000 + i] < 0.5] == []
    assert all(got[i] < 0.5 for i in (1100, 1101, 1102))


def test_licenses(docs, empty):
    a, b = list("abcdxe"), list("abqcde")
    pairs = align([x.encode() for x in a], [x.encode() for x in b])
    assert pairs == [(0, 0), (1, 1), (2, 3), (3, 4), (5, 5)]
    spark = docs.sparkSession
    rows = [(i, f"{text(40)}\n{t}\n{text(40)}") for i, t in enumerate(TEMPLATES.values())] + [(99, None), (98, text(50))]
    got = {r.doc_id: r.license for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(TEMPLATES))] == list(TEMPLATES) and got[99] is None and got[98] is None
    assert scan_licenses(empty).count() == 0


def test_repeated_licenses(spark):
    # copies after each other in mid-document; the last with a word changed in each copy
    edit = lambda t, k: " ".join("edited" if i == k else w for i, w in enumerate(t.split()))
    rows = [(100 * n + i, f"{text(40)}\n" + "\n".join([t] * n) + f"\n{text(40)}") for n in (2, 3) for i, t in enumerate(TEMPLATES.values())]
    rows += [(900 + i, f"license {text(9)} {edit(TEMPLATES[t], 7)} {text(5)} {edit(TEMPLATES[t], 20)} {text(30)}") for i, t in enumerate(("MIT", "GPL-3.0"))]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(got[100 * n + i].license, got[100 * n + i].coverage) for n in (2, 3) for i in range(len(TEMPLATES))] == [(t, 1.0) for t in TEMPLATES] * 2
    assert [got[900 + i].license for i in range(2)] == ["MIT", "GPL-3.0"] and all(got[900 + i].coverage > 0.95 for i in range(2))
    assert all(r.end - r.start == len(words_of(TEMPLATES[r.license].encode())) for r in got.values() if r.coverage == 1)


def test_pipeline_stages(spark, docs, empty):
    import corpus_pipeline

    d, e = docs, empty
    for name, stage in corpus_pipeline.STAGES[:3]:
        d, e = stage(spark, d, ""), stage(spark, e, "")
        assert d.columns == docs.columns and e.count() == 0, name
        d = spark.createDataFrame(d.collect(), SCHEMA)
        if name == "near_dedup":
            assert sorted(r.doc_id for r in d.select("doc_id").dropna().collect()) == [0, 7, 9, 10, *range(20, 25), 30]
