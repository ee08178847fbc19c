"""Scores, votes, quotas and greedy selection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of item types in the composite score.
TYPE_WEIGHTS = {"covered": 1.0, "not_covered": 0.9, "notification_duty": 0.85, "claim_obligation": 0.8, "limit": 0.8, "deadline": 0.8, "obligation": 0.7, "condition": 0.6}

#: Weights of phrases in a section's path.
SECTION_WEIGHTS = {
    "wat is verzekerd": 1.0,
    "dit is verzekerd": 1.0,
    "verzekerd": 0.9,
    "wat is niet verzekerd": 0.9,
    "dit is niet verzekerd": 0.9,
    "niet verzekerd": 0.85,
    "nooit verzekerd": 0.85,
    "eigen risico": 0.7,
    "maximale vergoeding": 0.7,
    "meldplicht": 0.65,
    "schade melden": 0.6,
    "verplichtingen": 0.6,
    "spelregels": 0.4,
    "klachtenregeling": 0.2,
    "begrippen": 0.1,
}


def section_score(path: Column, weights: Mapping[str, float] = SECTION_WEIGHTS, floor: float = 0.3) -> Column:
    """The largest weight of the keywords that the path contains, the floor at least."""
    hit = [F.when(F.lower(path).contains(k), F.lit(w)).otherwise(F.lit(floor)) for k, w in weights.items()]
    return F.greatest(F.lit(floor), F.lit(floor), *hit)


def composite_score(importance: Column, section: Column, item_type: Column, money: Column, deadline: Column, status: Column) -> Column:
    kind = F.lit(0.3)
    for k, w in TYPE_WEIGHTS.items():
        kind = F.when(item_type == k, F.lit(w)).otherwise(kind)
    specific = 0.5 * money.cast("double") + 0.5 * deadline.cast("double")
    score = 0.35 * (importance / 5) + 0.25 * section + 0.20 * kind + 0.10 * specific + 0.07
    return F.bround(F.when(status == "unverified", score * 0.7).otherwise(score), 4)


def visual_priority(item_type: Column, importance: Column) -> Column:
    return (
        F.when(item_type.isin("covered", "not_covered") & (importance >= 5), 1)
        .when(item_type.isin("limit", "deadline", "notification_duty", "claim_obligation") & (importance >= 4), 2)
        .when(importance >= 4, 3)
        .otherwise(4)
    )


def corrected_polarity(item_type: Column, insured: Column, not_insured: Column) -> Column:
    """Majority of column roles; a tie changes nothing."""
    return (
        F.when((insured > not_insured) & (item_type == "not_covered"), "covered")
        .when((not_insured > insured) & item_type.isin("covered", "condition", "limit"), "not_covered")
        .otherwise(item_type)
    )


def specificity(money: Column, deadlines: Column) -> tuple[Column, Column]:
    """Whether amounts and terms are named: null counts as none."""
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    return some(money), some(deadlines)


def polarity_override(items: DataFrame, roles: DataFrame, keys: list[str]) -> DataFrame:
    """Items with the type that most of their clauses' columns speak for, and whether that
    changed it (column_role_override). The matched clauses count, without any the cited ones;
    a clause named twice counts twice. Roles: doc_id, clause_id, column_role."""
    ids = F.when(F.coalesce(F.size("matched_clause_ids"), F.lit(0)) > 0, F.col("matched_clause_ids")).otherwise(F.col("supporting_clause_ids"))
    each = items.select("doc_id", *keys, F.explode(ids).alias("clause_id")).join(roles.select("doc_id", "clause_id", "column_role"), ["doc_id", "clause_id"])
    votes = each.groupBy("doc_id", *keys).agg(F.count_if(F.col("column_role") == "insured").alias("__yes"), F.count_if(F.col("column_role") == "not_insured").alias("__no"))
    rows = items.join(votes, ["doc_id", *keys], "left").fillna(0, ["__yes", "__no"])
    new = corrected_polarity(F.col("item_type"), F.col("__yes"), F.col("__no"))
    rows = rows.withColumn("__new", new).withColumn("column_role_override", F.col("__new") != F.col("item_type"))
    return rows.withColumn("item_type", F.col("__new")).drop("__new", "__yes", "__no")


def top_per_bucket(df: DataFrame, bucket: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*bucket).orderBy(*order))).where(F.col("rank") <= k)


def candidates(df: DataFrame, scope: list[str], bucket: list[str], order: list[Column], quota: int, most: int) -> DataFrame:
    """All rows of a scope with at most ``most``; else the quota of each bucket first, then
    the best of the rest, ``most`` in all."""
    w = Window.partitionBy(*scope)
    ranked = df.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("r", F.row_number().over(Window.partitionBy(*scope, *bucket).orderBy(*order)))
    place = F.row_number().over(w.orderBy((F.col("r") > quota).cast("int"), *order))
    return ranked.withColumn("place", place).where((F.col("n") <= most) | (F.col("place") <= most)).drop("n", "r", "place")


def greedy_dedup(df: DataFrame, scope: list[str], item: str, position: str) -> DataFrame:
    """An item stays in its first group only; twice in that group it stays twice."""
    first = F.min(position).over(Window.partitionBy(*scope, item))
    return df.withColumn("__first", first).where(F.col(position) == F.col("__first")).drop("__first")


def supplement(df: DataFrame, scope: list[str], selected: str, order: list[Column], least: int) -> DataFrame:
    """Selected rows and, up to ``least`` of a scope, the best of the others."""
    w = Window.partitionBy(*scope)
    n = F.sum(F.col(selected).cast("int")).over(w)
    r = F.row_number().over(Window.partitionBy(*scope, selected).orderBy(*order))
    return df.withColumn("__n", n).withColumn("__r", r).where(F.col(selected) | (F.col("__r") <= least - F.col("__n"))).drop("__n", "__r")


def merge_provenance(df: DataFrame, keys: list[str], order: str, ids: str, score: str) -> DataFrame:
    """Largest score, ids in order without repeats, and the number of merged rows."""
    c = F.array_sort(F.collect_list(F.struct(order, ids)))
    return df.groupBy(*keys).agg(F.max(score).alias("score"), F.count(F.lit(1)).alias("merged_count"), c.alias("c")).withColumn("ids", F.array_distinct(f"c.{ids}")).drop("c")


def fallback_place(df: DataFrame, scope: list[str], quotas: Mapping[str, int], module_buckets: tuple[str, ...], priority: str, order: list[Column], bucket: str = "bucket", module: str = "module") -> DataFrame:
    """Rows with their place in the choice without a model (null: outside the quotas): of each
    bucket the best by ``order`` up to its quota (of a module bucket, of each module), by
    priority. Equal priorities keep the order of choice: module buckets by module, then the
    other buckets as in ``quotas``."""
    names = list(quotas)
    at = lambda a, c: F.array_position(F.array(*map(F.lit, a)), c)
    b, of_module = F.col(bucket), F.col(bucket).isin(*module_buckets)
    limit = F.try_element_at(F.create_map(*(F.lit(x) for pair in quotas.items() for x in pair)), b)
    rows = df.withColumn("__p", F.when(of_module, F.coalesce(module, F.lit("general"))))
    rows = rows.withColumn("__q", F.row_number().over(Window.partitionBy(*scope, bucket, "__p").orderBy(*order)))
    rows = rows.withColumn("__in", F.coalesce(F.col("__q") <= limit, F.lit(False)))
    turn = [F.asc_nulls_last("__p"), F.when(of_module, at(module_buckets, b)).otherwise(at(names, b)), F.asc("__q")]
    place = F.row_number().over(Window.partitionBy(*scope, "__in").orderBy(F.asc(priority), *turn))
    return rows.withColumn("place", F.when(F.col("__in"), place)).drop("__p", "__q", "__in")


def fallback_selection(df: DataFrame, scope: list[str], quotas: Mapping[str, int], module_buckets: tuple[str, ...], priority: str, order: list[Column], most: int = 80, bucket: str = "bucket", module: str = "module") -> DataFrame:
    """The choice without a model: the ``most`` rows of a scope that ``fallback_place`` puts first."""
    return fallback_place(df, scope, quotas, module_buckets, priority, order, bucket, module).where(F.col("place") <= most)


def too_few(groups: Column, records: Column, least: int = 35, most: int = 80) -> Column:
    """A request to choose again if fewer groups came than asked for; else null."""
    asked = F.least(F.lit(least), records)
    ask = F.format_string(f"Only %d groups came back; at least %d are asked for, {most} at most. Choose again among the given ids, and answer as before.", groups.cast("int"), asked.cast("int"))
    return F.when(groups < asked, ask)


def run_totals(results: DataFrame, sums: list[str], before: str, after: str, invalid: str | None = None) -> DataFrame:
    """One row: documents, sums of columns, the mean of the documents' reduction (1 - after /
    before, 0 if nothing was there) and the number of distinct invalid ids of each document."""
    cut = F.when(F.col(before) > 0, F.bround(1 - F.col(after) / F.col(before), 4)).otherwise(0.0)
    wrong = [F.coalesce(F.sum(F.size(F.array_distinct(invalid))), F.lit(0)).alias("invalid_ids")] if invalid else []
    return results.agg(F.count(F.lit(1)).alias("n_docs"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums), F.coalesce(F.bround(F.avg(cut), 4), F.lit(0.0)).alias("avg_reduction_ratio"), *wrong)


def largest(sizes: DataFrame, by: str, key: str, k: int = 8) -> DataFrame:
    return sizes.orderBy(F.desc(by), F.asc(key)).limit(k)
