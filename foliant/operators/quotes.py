"""Search of quotes among the clauses of sections of any size.

1. In sections of more than a block an inverted index of character grams finds the clauses that
   hold a quote or that a quote holds: a quote looks up its rarest gram among all grams of the clauses, and a clause its own
   rarest gram among those of the quotes. Only what meets in a gram is compared.
2. Quotes that are left there take a floor from the clauses that share most of their rare grams.
3. Blocks of clauses and of quotes of a section then meet in tiles. What two texts can have in
   common is bounded from above by their characters and pairs of characters, counted for a whole
   tile at once; only clauses whose bound reaches the best score known are compared. The best of
   all tiles, with all its ties, is the result; no row holds a section.

The score is ``matching.similarity``: 1 if either text holds the other, else the best ratio of
matching characters against the whole clause or a stretch of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.operators.matching import may_reach, normalised, similarity
from foliant.operators.scan import numbered_in
from foliant.sources.shared import durable

GRAM = 5
_ONES, _TWOS = 128, 512  # bins of characters and of pairs


def grams(text: Column, n: int = GRAM) -> Column:
    """Distinct stretches of n characters."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(at, lambda i: F.substring(text, i, n)))).otherwise(F.array().cast("array<string>"))


def profile(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and counts of characters and of pairs by bins, of each text."""
    ones, twos = np.zeros((len(texts), _ONES), np.int32), np.zeros((len(texts), _TWOS), np.int32)
    for i, t in enumerate(texts):
        c = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ones[i] = np.bincount(c % _ONES, minlength=_ONES)
        if len(c) > 1:
            twos[i] = np.bincount((c[:-1] * 31 + c[1:]) % _TWOS, minlength=_TWOS)
    return np.array([len(t) for t in texts], np.int64), ones, twos


def bounds(quote: tuple[int, np.ndarray, np.ndarray], clauses: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """No score of the quote against a clause is above this, unless one holds the other.

    Characters that match are common to both. Where blocks of them part, at least one character
    of either text doesn't match, so b common pairs, n and m characters leave at most
    (b + 1 + n + m) / 3 that match."""
    (n, one, two), (m, ones, twos) = quote, clauses
    chars, pairs = np.minimum(ones, one).sum(1), np.minimum(twos, two).sum(1)
    whole = 2 * np.minimum(chars, (pairs + 1 + n + m) / 3) / np.maximum(n + m, 1)
    part = np.minimum(np.minimum(chars, (pairs + 1 + 2 * n) / 3) / max(n, 1), 1.0)
    return np.maximum(whole, np.where((m >= n) & (n >= 10), part, 0.0))


def best_places(quote: str, floor: float, texts: list[str], of: tuple[np.ndarray, np.ndarray, np.ndarray], own: tuple[int, np.ndarray, np.ndarray]) -> tuple[float, list[int]]:
    """The best score that isn't below the floor, and the texts that have it."""
    scores, best, top = {}, floor, bounds(own, of) + 1e-12
    held = [i for i, t in enumerate(texts) if quote in t or t in quote]
    if held:
        return 1.0, held
    order = np.argsort(-top, kind="stable").tolist()
    if texts:  # what shares most grams is likely to set a high mark
        cut = [quote[i : i + GRAM] for i in range(0, len(quote) - GRAM + 1, GRAM)]
        order.insert(0, max(range(len(texts)), key=lambda i: sum(g in texts[i] for g in cut)))
    for k, i in enumerate(order):
        if i in scores:
            continue
        if top[i] < best:
            if k:
                break
            continue
        if may_reach(quote, texts[i], best):
            scores[i] = similarity(quote, texts[i], best)
            best = max(best, scores[i])
    found = sorted(i for i, s in scores.items() if s == best and s > 0)
    return (best, found) if found else (0.0, [])


_FOUND = "row long, score double, places array<long>"


def _tile(runs: bool):
    """Best clauses (or runs of three clauses) of a block for each of its quotes."""

    def meet(quotes: pa.Table, clauses: pa.Table) -> pa.Table:
        if not len(quotes) or not len(clauses):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.float64(), pa.list_(pa.int64()))], names=["row", "score", "places"])
        c = clauses.select(["pos", "t", "n", "tail"]).sort_by("pos").to_pylist()
        texts, places = [x["t"] for x in c], [x["pos"] for x in c]
        if runs:
            last, at = c[0]["n"] - 1, {p: t for p, t in zip(places, texts, strict=True)}
            places = [x["pos"] for x in c if not x["tail"] and x["pos"] < last]
            texts = [" ".join(" ".join(at[p + k] for k in range(3) if p + k in at).split()) for p in places]
        n, ones, twos = profile(texts)
        rows, scores, found = [], [], []
        asked = quotes.to_pylist()
        m, own, both = profile([q["q"] for q in asked])
        for k, q in enumerate(asked):
            score, at_ = best_places(q["q"], q["floor"], texts, (n, ones, twos), (int(m[k]), own[k], both[k])) if texts else (0.0, [])
            if at_:
                rows.append(q["row"])
                scores.append(score)
                found.append([places[i] for i in at_])
        return pa.table([pa.array(rows, pa.int64()), pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.int64()))], names=["row", "score", "places"])

    return meet


def _tiled(quotes: DataFrame, clauses: DataFrame, keys: list[str], block: int, runs: bool) -> DataFrame:
    """Best of each tile: quotes (keys, row, q, floor) against blocks of clauses (keys, pos, t)."""
    parts = quotes.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("__chunks"))
    sizes = clauses.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    sized = clauses.join(sizes, keys).join(parts, keys).withColumn("__b", F.floor(F.col("pos") / block).cast("int"))
    here = F.struct(F.col("__b").alias("b"), F.lit(False).alias("tail"))
    # the first two clauses of a block end runs of the block before
    there = F.when((F.col("pos") % block < 2) & (F.col("__b") > 0), F.struct((F.col("__b") - 1).alias("b"), F.lit(True).alias("tail")))
    places = F.array_compact(F.array(here, there)) if runs else F.array(here)
    left = sized.withColumn("__x", F.explode(places)).withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)))
    left = left.select(*keys, F.col("__x.b").alias("__b"), "__chunk", "pos", "t", "n", F.col("__x.tail").alias("tail"))
    asked = quotes.join(parts, keys).join(sizes, keys).withColumn("__chunk", F.pmod(F.xxhash64("row"), F.col("__chunks")).cast("int"))
    asked = asked.withColumn("__b", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / block).cast("int")))).select(*keys, "__b", "__chunk", "row", "q", "floor")
    by = [*keys, "__b", "__chunk"]
    return asked.groupBy(*by).cogroup(left.groupBy(*by)).applyInArrow(_tile(runs), _FOUND)


def _best(found: DataFrame, first: bool = False) -> DataFrame:
    """(row, score, places): the best of several tiles, places of ties in order; with ``first``
    the first place alone."""
    top = found.withColumn("__top", F.max("score").over(Window.partitionBy("row")))
    same = top.where(F.col("score") == F.col("__top")).groupBy("row", "score")
    if first:
        return same.agg(F.min(F.array_min("places")).alias("place")).select("row", "score", F.array("place").alias("places"))
    return same.agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("places"))


def holding(quotes: DataFrame, clauses: DataFrame, keys: list[str]) -> DataFrame:
    """(row, pos) of all clauses (keys, pos, t) that hold a quote (keys, row, q) or that it
    holds, by the gram index. Quotes shorter than a gram are not looked up."""
    asked = quotes.where(F.length("q") >= GRAM)
    # what a quote holds: clauses by one of their grams, drawn by its hash, short clauses whole
    own = F.array_min(F.transform(grams(F.col("t")), lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))["g"]
    posted = clauses.select(*keys, "pos", F.when(F.length("t") >= GRAM, own).otherwise(F.col("t")).alias("__g"))
    short = [F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("q")), lambda i, n=n: F.substring(F.col("q"), i, n))) for n in range(1, GRAM)]
    probes = asked.select(*keys, "row", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), grams(F.col("q")), *short))).alias("__g"))
    inside = probes.join(posted, [*keys, "__g"]).select(*keys, "row", "pos")
    # what holds a quote: by the quote's rarest gram
    index = clauses.select(*keys, "pos", F.explode(grams(F.col("t"))).alias("__g"))
    rare = asked.select(*keys, "row", F.explode(grams(F.col("q"))).alias("__g")).join(index.groupBy(*keys, "__g").agg(F.count(F.lit(1)).alias("__n")), [*keys, "__g"], "left")
    rare = rare.groupBy(*keys, "row").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__g")).alias("x")).where("x.n > 0").select(*keys, "row", F.col("x.__g").alias("__g"))
    around = rare.join(index, [*keys, "__g"]).select(*keys, "row", "pos")
    met = inside.unionByName(around).distinct().join(asked, [*keys, "row"]).join(clauses, [*keys, "pos"])
    return met.where(F.contains("q", "t") | F.contains("t", "q")).select("row", "pos")


@F.udf(T.StructType([T.StructField("floor", T.DoubleType()), T.StructField("of_run", T.DoubleType())]), useArrow=True)
def _tried(quote: str, near: list[list[str]], places: list[int], below: float) -> tuple[float, float]:
    """Best score of the clauses at places of lists of neighbours, and below a score that of the
    runs with them."""
    best = run = 0.0
    for least in (below, 0.0):  # what is far from it is not worth the time where another reaches it
        for texts, at in zip(near, places, strict=True):
            if may_reach(quote, texts[at], max(best, least)):
                best = max(best, similarity(quote, texts[at], max(best, least)))
        if best >= below:
            return best, 0.0
    for texts, at in zip(near, places, strict=True):
        for a in range(max(0, at - 2), min(at, len(texts) - 2) + 1):
            run = max(run, similarity(quote, " ".join(" ".join(texts[a : a + 3]).split()), run))
    return best, run


def floors(quotes: DataFrame, clauses: DataFrame, keys: list[str], probes: int = 8, tries: int = 3, below: float = 0.0) -> DataFrame:
    """Quotes (keys, row, q) with a floor, the best score against the ``tries`` clauses that share
    most of the quote's ``probes`` rarest grams, and of_run, where that is below ``below`` the best
    against runs of three that hold one of these; 0 if no clause does."""
    index = clauses.select(*keys, "pos", F.explode(grams(F.col("t"))).alias("__g"))
    held = quotes.select(*keys, "row", F.explode(grams(F.col("q"))).alias("__g")).join(index.groupBy(*keys, "__g").agg(F.count(F.lit(1)).alias("__n")), [*keys, "__g"])
    few = held.withColumn("__r", F.row_number().over(Window.partitionBy("row").orderBy("__n", "__g"))).where(F.col("__r") <= probes)
    shared = few.join(index, [*keys, "__g"]).groupBy(*keys, "row", "pos").agg(F.count(F.lit(1)).alias("m"))
    top = shared.withColumn("__r", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("m"), "pos"))).where(F.col("__r") <= tries)
    near = top.select(*keys, "row", "__r", F.col("pos").alias("__at"), F.explode(F.sequence(F.col("pos") - 2, F.col("pos") + 2)).alias("pos")).join(clauses, [*keys, "pos"])
    near = near.groupBy("row", "__r", "__at").agg(F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("x"))
    each = F.struct("__r", F.col("x.t").alias("t"), (F.array_position("x.pos", F.col("__at")) - 1).cast("int").alias("at"))
    near = near.groupBy("row").agg(F.array_sort(F.collect_list(each)).alias("y")).join(quotes, "row")
    best = near.select("row", _tried("q", "y.t", "y.at", F.lit(float(below))).alias("s")).select("row", "s.floor", "s.of_run")
    return quotes.join(best, "row", "left").select(*quotes.columns, F.coalesce("floor", F.lit(0.0)).alias("floor"), F.coalesce("of_run", F.lit(0.0)).alias("of_run"))


def best_clauses(quotes: DataFrame, clauses: DataFrame, keys: list[str], *, block: int = 256, run_below: float | None = None) -> DataFrame:
    """(row, score, places, run) of each quote (keys, row, q; normalised text) among the clauses
    (keys, pos from 0, t) of its keys: the best score and the places that have it, in order.
    Both are read several times, so they are best given as written tables.

    With ``run_below``, quotes that stay below try runs of three clauses too, and take the first
    of the best ones if it is better than any clause; ``places`` is then where it begins and
    ``run`` is true. Quotes whose best score is 0, or whose keys have no clauses, give no row.
    """
    quotes, clauses = quotes.select(*keys, "row", "q"), clauses.select(*keys, F.col("pos").cast("long").alias("pos"), "t")
    kind = lambda run: F.lit(run).alias("run")
    found_in = lambda asked, run: durable(_best(_tiled(asked.select(*keys, "row", "q", "floor"), clauses, keys, block, run), run).select("row", "score", "places", kind(run)))
    # a section of one block is one tile, which needs neither index nor floor
    large = clauses.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > block).select(*keys)
    left, found = quotes.select("*", F.lit(0.0).alias("floor"), F.lit(0.0).alias("of_run")), None
    if not large.isEmpty():
        # written, so that grams are taken of these clauses alone
        there, those = quotes.join(large, keys, "left_semi"), durable(clauses.join(large, keys, "left_semi"))
        found = durable(holding(there, those, keys).groupBy("row").agg(F.lit(1.0).alias("score"), F.array_sort(F.collect_list("pos")).alias("places")).withColumn("run", kind(False)))
        rest = floors(there.join(found.select("row"), "row", "left_anti"), those, keys, below=run_below or 0.0)
        left = durable(rest.unionByName(left.join(large, keys, "left_anti")))
    with_found = lambda df: df if found is None else found.unionByName(df)
    if run_below is None:
        return with_found(found_in(left, False))
    # runs count only where no clause will do, and then a clause only if it is as good as them
    found = with_found(found_in(left.withColumn("floor", F.greatest("floor", F.lit(run_below))), False))
    rest = durable(left.join(found.select("row"), "row", "left_anti"))
    if rest.isEmpty():
        return found
    runs = found_in(rest.withColumn("floor", F.col("of_run")), True)
    mark = rest.join(runs.select("row", "score"), "row", "left").withColumn("floor", F.greatest("floor", F.coalesce("score", F.lit(0.0))))
    alone = found_in(mark, False)
    return found.unionByName(alone).unionByName(runs.join(alone.select("row"), "row", "left_anti"))


@F.udf(T.StructType([T.StructField("status", T.StringType()), T.StructField("score", T.DoubleType())]), useArrow=True)
def _cited(quote: str, joined: str, texts: list[str] | None, verified: float, fuzzy: float) -> tuple[str | None, float | None]:
    """Status and score of a quote by the cited clauses together, then by the best single one;
    no status if neither will do."""
    if texts is None:
        return None, None
    score = similarity(quote, joined)
    if score >= fuzzy:
        return "verified" if score >= verified else "fuzzy_match", score
    single = max(similarity(quote, t) for t in texts)
    return ("fuzzy_match", single) if single >= fuzzy else (None, score)


def validate_items(
    items: DataFrame, clauses: DataFrame, keys: list[str], *, order: list[str], quote: str = "exact_quote", cited: str = "supporting_clause_ids", clause_id: str = "clause_id", text: str = "clause_text", verified: float = 0.95, fuzzy: float = 0.8, block: int = 256
) -> DataFrame:
    """Items with validation_status, quote_match_score, matched_clause_ids, page_start,
    page_end and bbox_union, by the clauses (with page_start, page_end, bbox) of their section.

    The cited clauses together come first, then the best single one of them, then the search of
    the whole section: its best clauses and, below ``fuzzy``, runs of three. A quote whose cited
    clauses and section won't do is a weak_match of the cited ones. Empty and null quotes and
    items without clauses are unverified; a quote of white space is in every text. Ids are
    unique in a section; other columns of the items pass through, whatever their names.
    """
    at = in_sections(clauses.select(*keys, *(c for c in order if c not in keys), F.col(clause_id).alias("__id"), normalised(F.col(text)).alias("t"), F.struct(F.col("page_start").alias("p0"), F.col("page_end").alias("p1"), F.col("bbox").alias("box")).alias("__where")), keys, order)
    at = durable(at.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), "pos", "__id", "t", "__where"))
    k = [f"__k{i}" for i in range(len(keys))]
    rows = durable(items.select(F.struct(*(F.col(f"`{c}`") for c in items.columns)).alias("item"), F.monotonically_increasing_id().alias("row")))
    of = lambda c: F.col("item").getField(c)
    asked = rows.select("row", *(of(c).alias(x) for c, x in zip(keys, k, strict=True)), normalised(of(quote)).alias("q"), F.coalesce(of(cited), F.array().cast("array<string>")).alias("ids"), of(quote).alias("raw"))
    asked = asked.where(F.coalesce("raw", F.lit("")) != "").drop("raw").join(at.select(*k).distinct(), k, "left_semi")
    known = asked.select("row", *k, F.posexplode("ids").alias("j", "__id")).join(at.select(*k, "__id", "pos", "t"), [*k, "__id"])
    known = known.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("j", "pos", "t"))).alias("v"))
    # few bytes, but much to compare: a number given is not made smaller
    both = asked.drop("ids").repartition(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row").join(known, "row", "left").withColumn("joined", normalised(F.array_join("v.t", " ")))
    both = durable(both.select("row", *k, "q", F.col("v.pos").alias("cited_places"), _cited("q", "joined", "v.t", F.lit(verified), F.lit(fuzzy)).alias("m")))
    near = both.where("m.status IS NOT NULL").select("row", "m", F.col("cited_places").alias("places"))
    todo = both.where("m.status IS NULL").select("row", *k, "q", F.col("m.score").alias("cited_score"), "cited_places")
    found = best_clauses(todo, at.select(*k, "pos", "t"), k, block=block, run_below=fuzzy)
    found = found.withColumn("places", F.when(F.col("run"), F.sequence(F.get("places", F.lit(0)), F.get("places", F.lit(0)) + 2)).otherwise(F.col("places"))).drop("run")
    searched = todo.join(found, "row", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    kept = (F.col("score") < fuzzy) & F.col("cited_places").isNotNull()
    status = F.when(kept, "weak_match").when(F.col("score") >= verified, "verified").when(F.col("score") >= fuzzy, "fuzzy_match").otherwise("unverified")
    searched = searched.select("row", F.struct(status.alias("status"), F.when(kept, F.col("cited_score")).otherwise(F.col("score")).alias("score")).alias("m"), F.when(kept, F.col("cited_places")).otherwise(F.coalesce("places", F.array().cast("array<bigint>"))).alias("places"))
    judged = durable(near.unionByName(searched))
    box, page = (lambda i: F.when(F.size("w.box") == 4, F.get("w.box", F.lit(i)))), (lambda f, g: f(g(F.col("w.p0"), F.col("w.p1"))))
    places = judged.join(asked.select("row", *k), "row").select("row", *k, F.posexplode("places").alias("j", "pos")).join(at.select(*k, "pos", "__id", F.col("__where").alias("w")), [*k, "pos"])
    places = places.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("j", F.col("__id").alias("id")))).alias("x"), page(F.min, F.least).alias("first"), page(F.max, F.greatest).alias("last"), *(f(box(i)).alias(f"b{i}") for i, f in enumerate((F.min, F.min, F.max, F.max))))
    whole = rows.join(judged, "row", "left").join(places, "row", "left")
    box_union = F.when(F.col("b0").isNotNull(), F.array("b0", "b1", "b2", "b3"))
    return whole.select(
        *(of(c).alias(c) for c in items.columns if c not in ("page_start", "page_end")), F.coalesce("m.status", F.lit("unverified")).alias("validation_status"), F.bround(F.coalesce("m.score", F.lit(0.0)), 4).alias("quote_match_score"),
        F.coalesce("x.id", F.array().cast("array<string>")).alias("matched_clause_ids"), F.col("first").alias("page_start"), F.col("last").alias("page_end"), box_union.alias("bbox_union"),
    )


def in_sections(clauses: DataFrame, keys: list[str], order: list[str], most: int = 100_000) -> DataFrame:
    """Clauses with pos, their place from 0 in their section; sections of more than ``most``
    clauses are numbered over many tasks."""
    n = clauses.groupBy(*keys).count().agg(F.max("count")).first()[0]
    if n and n > most:
        return numbered_in(clauses, keys, order, "pos")
    return clauses.withColumn("pos", (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))
