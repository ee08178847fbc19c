"""A model's choice made whole: known ids, ranked supplements, module balance, limit, entries.

Items are rows of a document (``scope``) with item_id, bucket, module, item_type, headline,
exact_quote, importance, composite_score, theme, source_pages, chunk_ids and exclusion_scope.
Groups are what a model chose: group_index, item_ids and, where it says so, display_headline,
item_type, module, theme and visual_priority. A document's items meet in its own windows only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators.extraction import answer_groups
from foliant.operators.selection import fallback_place, greedy_dedup, too_few, visual_priority
from foliant.operators.summary import MODULE_BUCKETS, MODULES, canonical_module, replaced_bucket

# How many entries a summary aims at.
TARGETS = {"coverage_by_module": 6, "exclusions.by_module": 10, "exclusions.common": 14, "notification_duties": 5, "claim_obligations": 4, "limits_by_module": 10, "deadlines": 5, "conditions": 8}
TOTAL_MIN, TOTAL_MAX = 35, 80
#: Buckets whose fallback quota holds for each module.
PER_MODULE = ("coverage_by_module", "exclusions.by_module")
#: What a group may say of itself.
_OWN = {"display_headline": "g_headline", "item_type": "g_type", "module": "g_module", "theme": "g_theme", "visual_priority": "g_priority"}


def chosen_ids(groups: DataFrame, items: DataFrame, scope: list[str]) -> tuple[DataFrame, DataFrame]:
    """The known ids of the groups, each in its first group only (scope, group_index, pos,
    item_id), and the unknown ones (scope, invalid_ids: sorted, distinct)."""
    each = groups.select(*scope, "group_index", F.posexplode("item_ids").alias("pos", "item_id"))
    known = items.select(*scope, "item_id")
    unknown = each.join(known, [*scope, "item_id"], "left_anti").groupBy(*scope).agg(F.array_sort(F.collect_set("item_id")).alias("invalid_ids"))
    return greedy_dedup(each.join(known, [*scope, "item_id"], "left_semi"), scope, "item_id", "group_index"), unknown


def small_choices(answers: DataFrame, offered: DataFrame, least: int = TOTAL_MIN, most: int = TOTAL_MAX) -> DataFrame:
    """(cache_key, more): what to say to the choosing answers (cache_key, answer) that have fewer
    groups than asked for, by the items they were offered (cache_key, n_items)."""
    said = too_few(F.size(answer_groups(F.col("answer"))), F.col("n_items"), least, most)
    return answers.join(offered.select("cache_key", "n_items"), "cache_key").select("cache_key", said.alias("more")).where("more IS NOT NULL")


def rank_key(priority: str = "priority") -> list[Column]:
    return [F.asc(priority), F.desc("composite_score"), F.asc("headline"), F.asc("item_id")]


def completed(groups: DataFrame, items: DataFrame, scope: list[str], *, targets: Mapping[str, int] = TARGETS, least: int = TOTAL_MIN, most: int = TOTAL_MAX, buckets: tuple[str, ...] = MODULE_BUCKETS, modules: tuple[str, ...] = MODULES) -> DataFrame:
    """Items of the final groups with g (place of the group from 0), pos and reason.

    Documents without one known id get the ranked choice; then groups of one item are added up
    to ``least``; then, up to ``most``, the best item of every module that no group of a module
    bucket shows (a group counts for the bucket of its first item, with its own module). Limits
    are cut to the number of items. More than ``most`` groups are left for ``limited``.
    """
    doc = Window.partitionBy(*scope)
    c = F.col
    ids, _ = chosen_ids(groups, items, scope)
    own = groups.select(*scope, "group_index", *(c(n).alias(g) for n, g in _OWN.items()))
    # an id that its group names twice stays twice
    chosen = ids.join(own, [*scope, "group_index"]).groupBy(*scope, "item_id").agg(F.sort_array(F.collect_list("pos")).alias("places"), *(F.first(x).alias(x) for x in ("group_index", *_OWN.values())))
    x = items.withColumns({"module": canonical_module(c("module")), "priority": visual_priority(c("item_type"), c("importance"))}).repartition(*scope)
    x = x.join(chosen, [*scope, "item_id"], "left").withColumn("n_items", F.count(F.lit(1)).over(doc))

    # from here on all windows lie inside a document, so nothing is exchanged again
    def grouped(x: DataFrame, g: Column, reason: str, alone: bool = True) -> DataFrame:
        """Items without a group join the group ``g``, if that is not null."""
        new = c("g").isNull() & c("__g").isNotNull()
        said = {"g_headline": F.coalesce(F.nullif("headline", F.lit("")), "exact_quote"), "g_type": c("item_type"), "g_module": c("module"), "g_theme": c("theme"), "g_priority": c("priority")}
        x = x.withColumn("__g", g.cast("int")).withColumns({k: F.when(new, v).otherwise(c(k)) for k, v in said.items()} if alone else {})
        x = x.withColumns({"g": F.coalesce("g", "__g"), "reason": F.when(new, reason).otherwise(c("reason"))})
        return x.withColumn("n_groups", F.coalesce(F.max("g").over(doc) + 1, F.lit(0)))

    x = x.withColumns({"g": F.lit(None).cast("int"), "reason": F.lit(None).cast("string")})
    first = F.dense_rank().over(Window.partitionBy(*scope, c("group_index").isNull()).orderBy("group_index")) - 1
    x = grouped(x, F.when(c("group_index").isNotNull(), first), "model", alone=False)
    x = fallback_place(x, scope, targets, PER_MODULE, "priority", rank_key())
    x = grouped(x, F.when((c("n_groups") == 0) & (c("place") <= most), c("place") - 1), "fallback").drop("place")

    r = F.row_number().over(Window.partitionBy(*scope, c("g").isNull()).orderBy(*rank_key()))
    x = x.withColumn("__r", r)
    x = grouped(x, F.when(c("__r") <= F.least(F.lit(least), "n_items") - c("n_groups"), c("n_groups") + c("__r") - 1), "minimum")

    at = lambda names, v: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, names)), v), F.lit(0)), F.lit(len(names) + 1))
    x = x.withColumn("__first", F.coalesce(F.get("places", F.lit(0)), F.lit(0)))
    of_group = Window.partitionBy(*scope, "g").orderBy("__first")
    x = x.withColumn("__head", F.when(c("g").isNotNull() & (F.row_number().over(of_group) == 1), F.struct("bucket", group_module(scope, "__first").alias("module"))))
    x = x.withColumn("__shown", F.collect_set("__head").over(doc))
    wanted = c("g").isNull() & c("bucket").isin(*buckets) & ~F.array_contains("__shown", F.struct("bucket", "module"))
    best = F.row_number().over(Window.partitionBy(*scope, "bucket", "module", c("g").isNull()).orderBy(*rank_key())) == 1
    x = x.withColumn("__best", wanted & best)
    k = F.row_number().over(Window.partitionBy(*scope, "__best").orderBy(at(buckets, c("bucket")), at(modules, c("module")), "module"))
    x = x.withColumn("__k", F.when(c("__best"), k))
    x = grouped(x, F.when(c("__k") <= F.least(F.lit(most), "n_items") - c("n_groups"), c("n_groups") + c("__k") - 1), "balance")
    x = x.where("g IS NOT NULL").withColumn("pos", F.explode(F.coalesce("places", F.array(F.lit(0)))))
    return x.select(*items.columns, "priority", "pos", "g", "reason", *_OWN.values())


def group_module(scope: list[str], order: str) -> Column:
    """The module that all items of a group share, else what the group or its first item says."""
    of_group = Window.partitionBy(*scope, "g")
    first = F.first("module").over(of_group.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.when(F.min("module").over(of_group) == F.max("module").over(of_group), F.col("module")).otherwise(canonical_module(F.coalesce("g_module", first)))


def merged_entries(rows: DataFrame, scope: list[str]) -> DataFrame:
    """One entry a group: the group's own words before its first item's, all quotes, chunks and
    scopes in order without repeats, sorted pages, largest importance and score."""
    c = F.array_sort(F.collect_list(F.struct("pos", "item_id", "headline", "exact_quote", "module", "item_type", "theme", "bucket", F.coalesce("source_pages", F.array().cast("array<int>")).alias("pages"), F.coalesce("chunk_ids", F.array().cast("array<string>")).alias("chunks"), F.coalesce("exclusion_scope", F.array().cast("array<string>")).alias("scopes"))))
    own = [F.first(f"g_{x}", ignorenulls=True).alias(f"g_{x}") for x in ("headline", "type", "module", "theme", "priority")]
    g = rows.groupBy(*scope, "g").agg(c.alias("c"), *own, F.max(F.coalesce("importance", F.lit(3))).alias("importance"), F.max(F.coalesce("composite_score", F.lit(0.0))).alias("composite_score"), F.count(F.lit(1)).alias("merged_count"), F.first("reason").alias("reason"))
    base, distinct = F.col("c")[0], lambda x: F.array_distinct(F.filter(x, lambda y: F.coalesce(y, F.lit("")) != ""))
    said = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit("")), base[b], F.lit(""))
    modules = F.array_distinct("c.module")
    return g.select(
        *scope, "g", said("g_headline", "headline").alias("headline"), F.coalesce(F.get(distinct(F.col("c.exact_quote")), F.lit(0)), F.lit("")).alias("exact_quote"), distinct(F.col("c.exact_quote")).alias("supporting_quotes"),
        F.when(F.size(modules) == 1, modules[0]).otherwise(F.coalesce(F.nullif("g_module", F.lit("")), base["module"], F.lit("general"))).alias("module"), said("g_type", "item_type").alias("item_type"), F.coalesce("g_theme", base["theme"]).alias("theme"),
        "importance", F.coalesce("g_priority", F.lit(3)).alias("visual_priority"), F.array_sort(F.array_distinct(F.flatten("c.pages"))).alias("source_pages"), distinct(F.flatten("c.chunks")).alias("chunk_ids"),
        F.col("c.item_id").alias("source_item_ids"), "merged_count", "composite_score", distinct(F.flatten("c.scopes")).alias("exclusion_scope"), "reason", base["bucket"].alias("source_bucket"),
    )


def filtered_order() -> list[Column]:
    return [F.asc("visual_priority"), F.desc("importance"), F.desc("composite_score"), F.asc("headline")]


def limited(entries: DataFrame, scope: list[str], most: int = TOTAL_MAX) -> DataFrame:
    """Of documents with more than ``most`` entries, the first ones in filtered order."""
    place = F.row_number().over(Window.partitionBy(*scope).orderBy(*filtered_order(), "g"))
    return entries.withColumn("__r", place).where(F.col("__r") <= most).drop("__r")


def filtered_summary(groups: DataFrame, items: DataFrame, scope: list[str], *, least: int = TOTAL_MIN, most: int = TOTAL_MAX, targets: Mapping[str, int] = TARGETS) -> DataFrame:
    """Entries of the final summary with the bucket they are shown in."""
    entries = limited(merged_entries(completed(groups, items, scope, targets=targets, least=least, most=most), scope), scope, most)
    return entries.withColumn("bucket", replaced_bucket(F.col("item_type"), F.col("source_bucket"))).drop("source_bucket")


def run_metadata(entries: DataFrame, groups: DataFrame, items: DataFrame, scope: list[str]) -> DataFrame:
    """One row a document: items, entries, chosen items, what was added, the reduction and the
    ids that no item has."""
    n = items.groupBy(*scope).agg(F.count(F.lit(1)).alias("input_items"))
    e = entries.groupBy(*scope).agg(F.count(F.lit(1)).alias("filtered_items"), F.sum("merged_count").alias("selected_source_items"), *(F.count_if(F.col("reason") == r).alias(f"{r}_items") for r in ("fallback", "minimum", "balance")))
    _, unknown = chosen_ids(groups, items, scope)
    ratio = F.bround(1 - F.col("filtered_items") / F.col("input_items"), 4)
    return n.join(e, scope, "left").join(unknown, scope, "left").withColumn("reduction_ratio", ratio).withColumn("invalid_ids", F.coalesce("invalid_ids", F.array().cast("array<string>")))


def prefiltered(items: DataFrame, scope: list[str], *, targets: Mapping[str, int] = TARGETS, most: int = 450, factor: int = 3) -> DataFrame:
    """All items of documents with at most ``most``; else ``factor`` times the target of each
    bucket (of each module in module buckets with a quota of their own) and then the best of
    the others, up to ``most``."""
    w = Window.partitionBy(*scope)
    b = F.col("bucket")
    quota = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for k, v in targets.items() for x in (k, v * factor))), b), F.lit(0))
    part = F.when(b.isin(*PER_MODULE), F.coalesce("module", F.lit("general")))
    ranked = items.withColumn("priority", visual_priority(F.col("item_type"), F.col("importance"))).withColumns({"__n": F.count(F.lit(1)).over(w), "__part": part})
    ranked = ranked.withColumn("__r", F.row_number().over(Window.partitionBy(*scope, "bucket", "__part").orderBy(*rank_key())))
    inside = F.col("__r") <= quota
    at = F.array_position(F.array(*map(F.lit, targets)), b)
    turn = [~inside, F.when(inside, F.col("__part").isNull()), F.when(inside, F.col("__part")), F.when(inside, at)]
    place = F.row_number().over(w.orderBy(*turn, *rank_key()))
    return ranked.withColumn("__place", place).where((F.col("__n") <= most) | (F.col("__place") <= most)).drop("__n", "__part", "__r", "__place", "priority")


def workload(items: DataFrame, candidates: DataFrame, doc_id: str, text: str, k: int = 8) -> DataFrame:
    """What a run would send: documents, items, candidates, characters, tokens (a quarter of
    them) and the ``k`` documents with most candidates."""
    per = candidates.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(text)).alias("chars"))
    top = per.orderBy(F.desc("n"), F.asc(doc_id)).limit(k).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(doc_id).cast("string").alias("d")))).alias("x")).select(F.array_join("x.d", ",").alias("largest"))
    total = per.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("candidates"), F.sum("chars").alias("chars"))
    return total.crossJoin(items.agg(F.count(F.lit(1)).alias("items"))).crossJoin(top).withColumn("tokens", F.floor(F.col("chars") / 4))


#: Dollars per million tokens in and out; models not named cost as the first.
PRICES = {"gpt-4o-mini": (0.15, 0.60), "gpt-4o": (2.50, 10.00)}


def run_cost(windows: DataFrame, words: str, model: str) -> DataFrame:
    """Windows, words, tokens in (1.3 a word, 800 a window) and out (250 a window), dollars."""
    price_in, price_out = PRICES.get(model, next(iter(PRICES.values())))
    n = windows.agg(F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum(words), F.lit(0)).alias("words"))
    n = n.select("windows", "words", (F.floor(F.col("words") * 1.3) + 800 * F.col("windows")).alias("tokens_in"), (250 * F.col("windows")).alias("tokens_out"))
    return n.withColumn("dollars", F.bround((F.col("tokens_in") * price_in + F.col("tokens_out") * price_out) / 1_000_000, 6))
