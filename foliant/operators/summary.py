"""Scored items as grouped summaries: modules, buckets, item ids, balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Module order, module aliases, relevant item types, buckets.
MODULES = ("wa", "beperkt_casco", "all_risk", "pechhulp", "rechtsbijstand", "inzittenden", "general")
ALIASES = {
    "assistance": "pechhulp",
    "replacement_vehicle": "pechhulp",
    "hulpverlening": "pechhulp",
    "pech": "pechhulp",
    "casco": "all_risk",
    "volledig_casco": "all_risk",
    "allrisk": "all_risk",
    "own_damage": "all_risk",
    "limited_casco": "beperkt_casco",
    "fire": "beperkt_casco",
    "theft": "beperkt_casco",
    "storm_weather": "beperkt_casco",
    "glass": "beperkt_casco",
    "accessories": "all_risk",
    "wettelijke_aansprakelijkheid": "wa",
    "aansprakelijkheid": "wa",
    "liability": "wa",
    "juridisch": "rechtsbijstand",
    "legal": "rechtsbijstand",
    "ongevallen_inzittenden": "inzittenden",
    "passengers": "inzittenden",
}
RELEVANT = ("covered", "not_covered", "condition", "limit", "deadline", "obligation", "notification_duty", "claim_obligation")
BUCKETS = ("coverage_by_module", "exclusions.common", "exclusions.by_module", "notification_duties", "claim_obligations", "deadlines", "conditions", "limits_by_module")
MODULE_BUCKETS = ("coverage_by_module", "exclusions.by_module", "limits_by_module")


def canonical_module(c: Column) -> Column:
    """Aliases to their module; others stay, null is general."""
    names = F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, c), c, F.lit("general"))


def relevant(items: DataFrame) -> DataFrame:
    """Items of the types that customers see, with their module's own name."""
    return items.where(F.col("item_type").isin(*RELEVANT)).withColumn("module", canonical_module(F.col("module")))


def entries(items: DataFrame) -> DataFrame:
    """Items as entries of a summary: the quote where there is no headline, all pages from the
    first to the last (none if the last comes before), matched clauses as chunk_ids, scopes by
    their modules' own names, from_table where a table's column changed the type."""
    ps, pe = F.col("page_start").cast("int"), F.col("page_end").cast("int")
    last = F.coalesce(F.nullif(pe, F.lit(0)), ps)
    pages = F.when(ps.isNotNull() & (last >= ps), F.sequence(ps, last)).otherwise(F.array().cast("array<int>"))
    none = F.array().cast("array<string>")
    quote = F.coalesce("exact_quote", F.lit(""))
    return items.withColumns({
        "headline": F.coalesce(F.nullif("headline", F.lit("")), quote), "exact_quote": quote, "module": F.coalesce("module", F.lit("general")), "importance": F.coalesce(F.col("importance").cast("int"), F.lit(3)), "source_pages": pages,
        "chunk_ids": F.coalesce("matched_clause_ids", none), "exclusion_scope": F.transform(F.coalesce("exclusion_scope", none), canonical_module), "from_table": F.coalesce("column_role_override", F.lit(False)),
    })


def bucket(item_type: Column, module: Column, scope: Column, modules: tuple[str, ...] = MODULES) -> Column:
    """Struct of bucket and group (a module or null). The bucket is null for items that no
    summary shows: irrelevant types, covered items and limits of unknown modules."""
    known, n = module.isin(*modules), F.coalesce(F.size(scope), F.lit(0))
    place = lambda b, g: F.struct(F.lit(b).alias("bucket"), g.cast("string").alias("group"))
    none = F.lit(None)
    return (
        F.when((item_type == "covered") & known, place("coverage_by_module", module))
        .when((item_type == "not_covered") & ((module == "general") | (n > 1)), place("exclusions.common", none))
        .when(item_type == "not_covered", place("exclusions.by_module", F.coalesce(F.get(scope, F.lit(0)), module)))
        .when(item_type.isin("notification_duty", "obligation"), place("notification_duties", none))
        .when(item_type == "claim_obligation", place("claim_obligations", none))
        .when((item_type == "limit") & known, place("limits_by_module", module))
        .when(item_type == "deadline", place("deadlines", none))
        .when(item_type == "condition", place("conditions", none))
        .otherwise(F.struct(none.cast("string").alias("bucket"), none.cast("string").alias("group")))
    )


def summarise(items: DataFrame, scope: list[str], order: list[Column], modules: tuple[str, ...] = MODULES) -> DataFrame:
    """Shown items of (item_type, module, exclusion_scope) with bucket, group and item_id
    (bucket, group and the place by ``order`` from 0)."""
    rows = items.withColumn("module", canonical_module(F.col("module"))).withColumn("__b", bucket(F.col("item_type"), F.col("module"), F.col("exclusion_scope"), modules))
    rows = rows.select("*", "__b.*").drop("__b").where("bucket IS NOT NULL")
    at = F.row_number().over(Window.partitionBy(*scope, "bucket", "group").orderBy(*order)) - 1
    return rows.withColumn("item_id", F.concat_ws(".", "bucket", "group", F.lpad(at.cast("string"), F.greatest(F.lit(3), F.length(at.cast("string"))), F.lit("0"))))


def replaced_bucket(item_type: Column, source: Column) -> Column:
    """Bucket of a merged entry by its type or the bucket that its first source came from."""
    return (
        F.when((item_type == "covered") | (source == "coverage_by_module"), "coverage_by_module")
        .when((item_type == "not_covered") | source.startswith("exclusions"), "exclusions")
        .when(item_type.isin("notification_duty", "obligation") | (source == "notification_duties"), "notification_duties")
        .when((item_type == "claim_obligation") | (source == "claim_obligations"), "claim_obligations")
        .when((item_type == "limit") | (source == "limits_by_module"), "limits_by_module")
        .when((item_type == "deadline") | (source == "deadlines"), "deadlines")
        .otherwise("conditions")
    )


def balance(df: DataFrame, scope: list[str], selected: str, bucket: str, module: str, order: list[Column], most: int, buckets: tuple[str, ...] = MODULE_BUCKETS, modules: tuple[str, ...] = MODULES) -> DataFrame:
    """Selected rows and, for each module that none of them shows in a module bucket, the best
    other row of it; by buckets, then known modules, then names, up to ``most`` of a scope."""
    of_module = Window.partitionBy(*scope, bucket, module)
    rows = df.withColumn("__n", F.count_if(selected).over(Window.partitionBy(*scope))).withColumn("__m", F.count_if(selected).over(of_module))
    rows = rows.withColumn("__r", F.row_number().over(Window.partitionBy(*scope, bucket, module, selected).orderBy(*order)))
    wanted = ~F.col(selected) & (F.col("__m") == 0) & (F.col("__r") == 1) & F.col(bucket).isin(*buckets)
    place = lambda names, c: F.array_position(F.array(*map(F.lit, names)), F.col(c))
    known = F.when(place(modules, module) == 0, len(modules) + 1).otherwise(place(modules, module))
    at = F.row_number().over(Window.partitionBy(*scope, "__w").orderBy(place(buckets, bucket), known, module))
    rows = rows.withColumn("__w", wanted).withColumn("__at", at)
    return rows.where(F.col(selected) | (F.col("__w") & (F.col("__at") <= most - F.col("__n")))).drop("__n", "__m", "__r", "__w", "__at")
