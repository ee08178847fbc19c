"""Queries of scores, choices and summaries on the driver's tables, with their SQL.

Parts stand for items and their brands for documents; groups are made up as a model's answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import box_of, escape_html, ids_of, integer_or, normalise_space, page_reference, short_clause_id, truncate, truncate_after, word_count
from foliant.operators.choice import TARGETS, filtered_summary, prefiltered, run_cost, run_metadata, workload
from foliant.operators.chunk_table import with_section_columns
from foliant.operators.extraction import group_rows, with_extraction_ids
from foliant.operators.quotes import validate_items
from foliant.operators.numbering import numbered
from foliant.operators.selection import composite_score, polarity_override, section_score, specificity, visual_priority
from foliant.operators.summary import MODULE_BUCKETS, MODULES, entries, summarise
from foliant.sources.stages import in_order

LEAST, MOST = 12, 14


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, w = F.col, F.lit
    pick = lambda names, x: F.get(F.array(*map(w, names)), F.pmod(x, w(len(names))).cast("int"))
    scope = F.when(c("p_size") % 3 == 0, F.array(w("wa"), w("all_risk"))).when(c("p_size") % 3 == 1, F.array(w("pechhulp"))).otherwise(F.array().cast("array<string>"))
    p = _t(spark, sf_dir, "part").select(
        c("p_brand").alias("doc_id"), c("p_partkey").alias("k"), pick(("covered", "not_covered", "limit", "deadline", "condition", "admin"), c("p_partkey")).alias("item_type"), pick(("wa", "casco", "general", "legal", "elsewhere"), F.floor(c("p_partkey") / 6)).alias("module"),
        scope.alias("exclusion_scope"), F.concat(w("H "), c("p_partkey") % 7).alias("headline"), F.when(c("p_partkey") % 5 == 0, "").otherwise(F.concat(w("Q"), c("p_partkey") % 11)).alias("exact_quote"), (c("p_partkey") % 5 + 1).cast("int").alias("importance"), c("p_retailprice").alias("composite_score"),
        F.lit(None).cast("string").alias("theme"), F.array(c("p_size") % 4, c("p_size") % 3).alias("source_pages"), F.array(F.concat(w("k"), c("p_partkey") % 6), F.concat(w("k"), c("p_size") % 6)).alias("chunk_ids"),
    )
    return summarise(p, ["doc_id"], [F.desc("composite_score"), F.asc("k")])


def _groups(items: DataFrame) -> DataFrame:
    """Four groups a document with ids that occur twice or are unknown; brands that end in 3
    know none of theirs."""
    c = F.col
    some = items.where(~c("doc_id").endswith("3"))
    each = some.where("k % 3 = 1").select("doc_id", (c("k") % 4).alias("group_index"), "item_id")
    each = each.unionByName(some.where("k % 9 = 1").select("doc_id", ((c("k") + 1) % 4).alias("group_index"), "item_id"))
    each = each.unionByName(items.select("doc_id", F.lit(0).cast("long").alias("group_index"), F.concat(F.lit("nope."), c("k") % 2).alias("item_id")).distinct())
    g = each.groupBy("doc_id", "group_index").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    i = c("group_index")
    return g.withColumns({"display_headline": F.when(i % 2 == 0, F.concat(F.lit("D"), i)), "item_type": F.when(i == 1, "covered"), "module": F.when(i == 3, "casco"), "theme": F.lit(None).cast("string"), "visual_priority": F.when(i != 2, i.cast("int"))})


def summary_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's groups completed, balanced, limited and merged into entries."""
    items = _items(spark, sf_dir)
    e = filtered_summary(_groups(items), items, ["doc_id"], least=LEAST, most=MOST)
    joined = [F.array_join(F.col(x).cast("array<string>"), ",").alias(x) for x in ("supporting_quotes", "source_pages", "chunk_ids", "source_item_ids", "exclusion_scope")]
    return e.select("doc_id", *(F.col(x).cast("long").alias(x) for x in ("g", "importance", "visual_priority", "merged_count")), "headline", "exact_quote", "module", "item_type", "composite_score", "reason", "bucket", *joined)


def choice_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run did to each document, and the ids it did not know."""
    items = _items(spark, sf_dir)
    groups = _groups(items)
    m = run_metadata(filtered_summary(groups, items, ["doc_id"], least=LEAST, most=MOST), groups, items, ["doc_id"])
    return m.withColumn("invalid_ids", F.array_join("invalid_ids", ","))


def bucket_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas of buckets and of modules, then the best of the rest."""
    return prefiltered(_items(spark, sf_dir), ["doc_id"], most=30, factor=1).select("doc_id", "item_id")


def run_workload(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    return workload(items, prefiltered(items, ["doc_id"], most=30, factor=1), "doc_id", "headline")


def run_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "conversations").select(word_count(normalise_space(F.col("text"))).cast("long").alias("w"))
    return run_cost(c, "w", "gpt-4o").unionByName(run_cost(c, "w", "unknown"))


def summary_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as items that become entries."""
    c, n = F.col, F.col("l_linenumber")
    x = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(n % 3 == 0, "").when(n % 3 == 1, "head").alias("headline"), c("l_returnflag").alias("exact_quote"), F.when(n % 2 == 0, "casco").alias("module"), F.when(n % 5 != 0, n).alias("importance"),
        F.when(n != 7, n).alias("page_start"), F.when(n % 3 != 0, c("l_partkey") % 6).alias("page_end"), F.when(n % 2 == 1, F.array(c("l_partkey").cast("string"))).alias("matched_clause_ids"), F.array(F.lit("pech"), F.lit("fire"), F.lit("other")).alias("exclusion_scope"), F.when(n % 4 == 0, c("l_partkey") % 2 == 0).alias("column_role_override"),
    )
    e = entries(x)
    return e.select("l_orderkey", *(F.col(x).cast("long").alias(x) for x in ("l_linenumber", "importance")), "l_partkey", "headline", "exact_quote", "module", F.array_join(F.col("source_pages").cast("array<string>"), ",").alias("pages"), F.array_join("chunk_ids", ",").alias("chunks"), F.array_join("exclusion_scope", ",").alias("scopes"), "from_table")


PATHS = ("Wat is niet verzekerd", "Eigen risico > Begrippen", "Klachtenregeling", "Meldplicht", "Schade melden", "Spelregels", "Overig", "Nooit verzekerd")


def section_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of section paths, named amounts and terms, scores and ranks."""
    c = F.col
    d = _t(spark, sf_dir, "documents")
    path = F.get(F.array(*map(F.lit, PATHS)), (c("doc_id") % len(PATHS)).cast("int"))
    some = lambda n: F.when(c("doc_id") % n == 0, F.array(c("source"))).when(c("doc_id") % n == 1, F.array().cast("array<string>"))
    money, terms = specificity(some(3), some(5))
    kind, weight = F.when(c("lang") == "en", "limit").otherwise("covered"), c("doc_id") % 5 + 1
    status = F.when(c("doc_id") % 4 == 0, "unverified").otherwise("verified")
    score = composite_score(weight, section_score(path), kind, money, terms, status)
    return d.select("doc_id", section_score(path).alias("weight"), score.alias("score"), visual_priority(kind, weight).cast("long").alias("priority"))


def column_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as items whose lines say on which side they stand."""
    c = F.col
    lines = _t(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("doc_id"), F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("clause_id"), F.when(c("l_returnflag") == "A", "insured").when(c("l_returnflag") == "R", "not_insured").otherwise("unknown").alias("column_role")).dropDuplicates(["doc_id", "clause_id"])
    ids = lines.groupBy("doc_id").agg(F.array_sort(F.collect_list("clause_id")).alias("ids"))
    kinds = F.array(*map(F.lit, ("covered", "not_covered", "limit", "deadline")))
    items = ids.select("doc_id", F.lit("i").alias("item"), F.get(kinds, (c("doc_id") % 4).cast("int")).alias("item_type"), F.when(c("doc_id") % 3 != 0, c("ids")).alias("matched_clause_ids"), F.slice("ids", 1, 2).alias("supporting_clause_ids"))
    return polarity_override(items, lines, ["item"]).select("doc_id", "item_type", "column_role_override")


def _fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes out of turns with one or four characters changed; even turns are cited."""
    c = F.col
    t = F.regexp_replace(F.lower(normalise_space(c("text"))), "[^a-z]", "_")
    turns = _t(spark, sf_dir, "conversations").select("conv_id", "turn", F.lpad(c("turn").cast("string"), 3, "0").alias("clause_id"), F.concat(F.lit("t"), c("turn"), F.lit("-"), t, F.lit("."), c("conv_id")).alias("clause_text"))
    q = F.substring("clause_text", 1, 50)
    hit = lambda x, at: F.concat(F.substring(x, 1, at - 1), F.lit("#"), F.substring(x, at + 1, 50))
    quote = F.when(c("conv_id") % 2 == 0, hit(q, 21)).otherwise(hit(hit(hit(hit(q, 4), 6), 8), 10))
    items = turns.where(F.length("clause_text") >= 60).select("conv_id", "turn", quote.alias("exact_quote"), F.when(c("turn") % 2 == 0, F.array("clause_id")).alias("supporting_clause_ids"))
    clauses = turns.select("conv_id", "turn", "clause_id", "clause_text", c("turn").alias("page_start"), c("turn").alias("page_end"), F.array(c("turn"), c("turn"), c("turn") + 1, c("turn") + 2).cast("array<double>").alias("bbox"))
    return validate_items(items, clauses, ["conv_id"], order=["turn"])


def fuzzy_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes that no clause holds: their best stretch, status, page and box."""
    return _fuzzy(spark, sf_dir).select("conv_id", "turn", F.col("validation_status").alias("status"), F.col("quote_match_score").alias("score"), F.array_join("matched_clause_ids", ",").alias("ids"), "page_start", F.get("bbox_union", F.lit(3)).alias("y1"))


def quote_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many quotes have each status."""
    return _fuzzy(spark, sf_dir).groupBy(F.col("validation_status").alias("status")).agg(F.count(F.lit(1)).alias("n"))


def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escapes, cuts, short ids, page references, numbers, boxes and lists of ids."""
    c, w, k = F.col, F.lit, F.col("doc_id")
    text = F.concat(w("<a href='"), F.regexp_replace(F.coalesce("text", w("")), "[^A-Za-z]+", " "), w('"&>'))
    number = F.when(k % 3 == 0, w("x1")).when(k % 3 == 1, F.concat(w(" "), k)).otherwise(k.cast("string"))
    box = F.when(k % 4 == 0, "null").when(k % 4 == 1, "[1, 2, 3]").when(k % 4 == 2, F.concat(w("[0, 1.5, 2, "), k, w("]")))
    ids = F.when(k % 4 == 0, F.concat(w('["a'), k, w('", "b"]'))).when(k % 4 == 1, "plain").when(k % 4 == 2, " ")
    return _t(spark, sf_dir, "documents").select(
        "doc_id", escape_html(text, quotes=True).alias("escaped"), truncate(text, 40).alias("cut"), truncate_after(text, 40).alias("cut_after"), short_clause_id(F.when(k % 2 == 0, F.concat(w("d:x_sc"), k, w(":rna:c"), k % 5)).otherwise(F.concat(w("d"), k))).alias("short_id"),
        page_reference(F.when(k % 3 != 0, F.array(k, k + 1))).alias("pages"), integer_or(number, 7).cast("long").alias("number"), F.get(box_of(box), w(3)).alias("y1"), F.array_join(ids_of(ids), "|").alias("ids"),
    )


def group_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that choose: groups under two names, ids under two names, what can't be read."""
    k, w = F.col("event_id"), F.lit
    one = F.concat(w('{"display_headline": "h'), F.col("user_id"), w('", "visual_priority": '), F.when(k % 3 == 0, '"x"').otherwise((k % 3).cast("string")), w(', "source_item_ids": ["a'), k, w('", "b"]}'))
    answer = F.when(k % 4 == 0, F.concat(w('```json\n{"selected_groups": ['), one, w(', {"item_ids": ["c"]}]}\n```'))).when(k % 4 == 1, F.concat(w('{"selected_items": ['), one, w("]}"))).when(k % 4 == 2, "no json")
    g = group_rows(_t(spark, sf_dir, "events").select("event_id", answer.alias("answer")), ["event_id"])
    return g.select("event_id", F.col("group_index").cast("long").alias("place"), F.array_join("item_ids", ",").alias("ids"), "display_headline", F.coalesce(F.col("visual_priority").cast("long"), F.lit(0)).alias("priority"))


def given_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in a caller's order: repeated ids stay, unknown ones go."""
    d = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"))
    return in_order(d, ["17", "3", "none", "17", "-1"]).select(F.col("place").cast("long").alias("place"), "doc_id")


def section_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as chunks that only know the id of their structure."""
    p = _t(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("struct_chunk_id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("section_path"))
    return with_section_columns(p).select("chunk_id", "section_path_original", "section_path_enriched", "title_text_original", "heading_source", F.col("heading_level_inferred").cast("long").alias("level"), "section_enrichment_confidence")


def extraction_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as items, numbered through all conversations."""
    c = _t(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("doc_id"), "conv_id", "turn")
    return with_extraction_ids(numbered(c, "doc_id", ["turn"], "n"), "n").select("conv_id", "turn", "extraction_id")


QUERIES = {f.__name__: f for f in (group_answers, given_order, section_columns, extraction_ids, summary_choice, choice_metadata, bucket_candidates, run_workload, run_dollars, summary_entries, section_scores, column_roles, fuzzy_quotes, quote_statuses, text_helpers)}

_list = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
_RANK = "prio, score DESC, headline, item_id"
_ITEMS = """p AS (SELECT *, ['covered', 'not_covered', 'limit', 'deadline', 'condition', 'admin'][1 + p_partkey % 6] AS item_type, ['wa', 'all_risk', 'general', 'rechtsbijstand', 'elsewhere'][1 + (p_partkey // 6) % 5] AS module, p_size % 3 AS s FROM part),
    b AS (SELECT *, CASE WHEN item_type = 'covered' AND module <> 'elsewhere' THEN 'coverage_by_module' WHEN item_type = 'not_covered' AND (module = 'general' OR s = 0) THEN 'exclusions.common' WHEN item_type = 'not_covered' THEN 'exclusions.by_module'
        WHEN item_type = 'limit' AND module <> 'elsewhere' THEN 'limits_by_module' WHEN item_type = 'deadline' THEN 'deadlines' WHEN item_type = 'condition' THEN 'conditions' END AS bucket,
        CASE WHEN item_type IN ('covered', 'limit') THEN module WHEN item_type = 'not_covered' AND module <> 'general' AND s <> 0 THEN CASE WHEN s = 1 THEN 'pechhulp' ELSE module END END AS grp FROM p),
    i AS (SELECT p_brand AS doc, p_partkey AS k, item_type, module, bucket, concat_ws('.', bucket, grp, printf('%03d', row_number() OVER (PARTITION BY p_brand, bucket, grp ORDER BY p_retailprice DESC, p_partkey) - 1)) AS item_id, 'H ' || (p_partkey % 7) AS headline,
        CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'Q' || (p_partkey % 11) END AS quote, p_partkey % 5 + 1 AS imp, p_retailprice AS score, [p_size % 4, p_size % 3] AS pages, ['k' || (p_partkey % 6), 'k' || (p_size % 6)] AS chunks,
        CASE s WHEN 0 THEN ['wa', 'all_risk'] WHEN 1 THEN ['pechhulp'] ELSE [] END AS scopes FROM b WHERE bucket IS NOT NULL),
    r AS (SELECT *, CASE WHEN item_type IN ('covered', 'not_covered') AND imp >= 5 THEN 1 WHEN item_type IN ('limit', 'deadline') AND imp >= 4 THEN 2 WHEN imp >= 4 THEN 3 ELSE 4 END AS prio,
        CASE WHEN bucket IN ('coverage_by_module', 'exclusions.by_module') THEN module END AS part FROM i)"""
_QUOTA = "CASE bucket " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TARGETS.items()) + " END"
_PLACE = f"list_position({_list(TARGETS)}, bucket)"
_DISTINCT = "array_to_string(list_transform(list_sort(list_distinct(list_filter(list_transform(range(1, len({0}) + 1), lambda j: [lpad(CAST(list_position({0}, {0}[j]) AS VARCHAR), 6, '0'), {0}[j]]), lambda y: y[2] <> ''))), lambda y: y[2]), ',')"
_CHAIN = f"""WITH {_ITEMS},
    w AS (SELECT doc, k % 4 AS gi, item_id FROM i WHERE k % 3 = 1 AND NOT ends_with(doc, '3') UNION ALL SELECT doc, (k + 1) % 4, item_id FROM i WHERE k % 9 = 1 AND NOT ends_with(doc, '3') UNION ALL SELECT DISTINCT doc, 0, 'nope.' || (k % 2) FROM i),
    u AS (SELECT *, row_number() OVER (PARTITION BY doc, gi ORDER BY item_id) - 1 AS pos FROM w), v AS (SELECT u.*, min(gi) OVER (PARTITION BY u.doc, u.item_id) AS f FROM u SEMI JOIN r USING (doc, item_id)),
    m AS (SELECT doc, item_id, pos, gi, dense_rank() OVER (PARTITION BY doc ORDER BY gi) - 1 AS g FROM v WHERE gi = f),
    fb AS (SELECT *, row_number() OVER (PARTITION BY doc, bucket, part ORDER BY {_RANK}) AS rn FROM r WHERE doc NOT IN (SELECT doc FROM m)),
    fq AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY prio, part NULLS LAST, {_PLACE}, rn) AS place FROM fb WHERE rn <= {_QUOTA}),
    r1 AS (SELECT doc, item_id, pos, g, 'model' AS reason, gi FROM m UNION ALL SELECT doc, item_id, 0, place - 1, 'fallback', NULL FROM fq WHERE place <= {MOST}),
    n AS (SELECT doc, count(*) AS n FROM r GROUP BY doc), n1 AS (SELECT doc, max(g) + 1 AS ng FROM r1 GROUP BY doc),
    s AS (SELECT doc, item_id, ng, n, row_number() OVER (PARTITION BY doc ORDER BY {_RANK}) AS x FROM (SELECT * FROM r ANTI JOIN r1 USING (doc, item_id)) JOIN n USING (doc) JOIN n1 USING (doc)),
    r2 AS (SELECT * FROM r1 UNION ALL SELECT doc, item_id, 0, ng + x - 1, 'minimum', NULL FROM s WHERE x <= least({LEAST}, n) - ng), n2 AS (SELECT doc, max(g) + 1 AS ng FROM r2 GROUP BY doc),
    h AS (SELECT doc, g, arg_min(bucket, pos) AS bucket, CASE WHEN min(module) = max(module) THEN min(module) WHEN any_value(gi) = 3 THEN 'all_risk' ELSE arg_min(module, pos) END AS module FROM r2 JOIN r USING (doc, item_id) GROUP BY doc, g),
    b1 AS (SELECT *, row_number() OVER (PARTITION BY doc, bucket, module ORDER BY {_RANK}) AS rn FROM (SELECT * FROM r ANTI JOIN r2 USING (doc, item_id)) q ANTI JOIN h USING (doc, bucket, module) WHERE bucket IN ({_list(MODULE_BUCKETS)[1:-1]})),
    b2 AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY list_position({_list(MODULE_BUCKETS)}, bucket), coalesce(list_position({_list(MODULES)}, module), 99), module) AS x FROM b1 WHERE rn = 1),
    r3 AS (SELECT * FROM r2 UNION ALL SELECT doc, item_id, 0, ng + x - 1, 'balance', NULL FROM b2 JOIN n USING (doc) JOIN n2 USING (doc) WHERE x <= least({MOST}, n) - ng),
    e AS (SELECT doc, g, any_value(reason) AS reason, any_value(gi) AS gi, count(*) AS merged_count, max(imp) AS importance, max(score) AS composite_score, arg_min(headline, pos) AS head, arg_min(quote, pos) AS q0, arg_min(item_type, pos) AS kind, arg_min(module, pos) AS m0, count(DISTINCT module) AS nm, arg_min(bucket, pos) AS source_bucket,
        arg_min(prio, pos) AS p0, string_agg(item_id, ',' ORDER BY pos, item_id) AS ids, list(quote ORDER BY pos, item_id) AS quotes, flatten(list(chunks ORDER BY pos, item_id)) AS chunks, flatten(list(scopes ORDER BY pos, item_id)) AS scopes, list_sort(list_distinct(flatten(list(pages)))) AS pages FROM r3 JOIN r USING (doc, item_id) GROUP BY doc, g),
    y AS (SELECT doc AS doc_id, g, importance, CASE WHEN reason <> 'model' THEN p0 WHEN gi = 2 THEN 3 ELSE gi END AS visual_priority, merged_count, CASE WHEN reason = 'model' AND gi % 2 = 0 THEN 'D' || gi ELSE head END AS headline, coalesce(list_filter(quotes, lambda z: z <> '')[1], '') AS exact_quote,
        CASE WHEN nm = 1 THEN m0 WHEN gi = 3 THEN 'casco' ELSE m0 END AS module, CASE WHEN gi = 1 THEN 'covered' ELSE kind END AS item_type, composite_score, reason, source_bucket, {_DISTINCT.format('quotes')} AS supporting_quotes, array_to_string(pages, ',') AS source_pages, {_DISTINCT.format('chunks')} AS chunk_ids, ids AS source_item_ids, {_DISTINCT.format('scopes')} AS exclusion_scope FROM e),
    z AS (SELECT * EXCLUDE (source_bucket, o), CASE WHEN item_type = 'covered' OR source_bucket = 'coverage_by_module' THEN 'coverage_by_module' WHEN item_type = 'not_covered' OR starts_with(source_bucket, 'exclusions') THEN 'exclusions' WHEN item_type = 'limit' OR source_bucket = 'limits_by_module' THEN 'limits_by_module'
        WHEN item_type = 'deadline' OR source_bucket = 'deadlines' THEN 'deadlines' ELSE 'conditions' END AS bucket FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY visual_priority, importance DESC, composite_score DESC, headline, g) AS o FROM y) WHERE o <= {MOST})"""  # fmt: skip
_CANDIDATES = f"""{_ITEMS}, cq AS (SELECT *, count(*) OVER (PARTITION BY doc) AS n, row_number() OVER (PARTITION BY doc, bucket, part ORDER BY {_RANK}) <= {_QUOTA} AS inside FROM r),
    cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY NOT inside, CASE WHEN inside THEN part IS NULL END, CASE WHEN inside THEN part END, CASE WHEN inside THEN {_PLACE} END, {_RANK}) AS o FROM cq) WHERE n <= 30 OR o <= 30)"""
_FUZZY = r"""c AS (SELECT conv_id, turn, 't' || turn || '-' || regexp_replace(lower(trim(regexp_replace(replace(coalesce(text, ''), chr(173), ''), '[\s\p{Z}\x0B]+', ' ', 'g'))), '[^a-z]', '_', 'g') || '.' || conv_id AS t FROM conversations),
    s AS (SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 THEN 'verified' ELSE 'fuzzy_match' END AS status, CASE WHEN conv_id % 2 = 0 THEN 0.98::DOUBLE ELSE 0.92::DOUBLE END AS score FROM c WHERE length(t) >= 60)"""

ORACLE_SQL = {
    "group_answers": """WITH e AS (SELECT event_id AS k, user_id FROM events WHERE event_id % 4 < 2)
        SELECT k AS event_id, CAST(0 AS BIGINT) AS place, 'a' || k || ',b' AS ids, 'h' || user_id AS display_headline, CASE WHEN k % 3 <> 0 THEN k % 3 ELSE 0 END AS priority FROM e UNION ALL SELECT k, 1, 'c', NULL, 0 FROM e WHERE k % 4 = 0""",
    "given_order": "SELECT CAST(o.place AS BIGINT) AS place, o.doc_id FROM (VALUES (0, '17'), (1, '3'), (2, 'none'), (3, '17'), (4, '-1')) o(place, doc_id) WHERE o.doc_id IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)",
    "section_columns": "SELECT CAST(p_partkey AS VARCHAR) AS chunk_id, p AS section_path_original, p AS section_path_enriched, '' AS title_text_original, 'original' AS heading_source, CAST(0 AS BIGINT) AS level, 1.0::DOUBLE AS section_enrichment_confidence FROM (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS p FROM part)",
    "extraction_ids": "SELECT conv_id, turn, 'ext_' || lpad(CAST(row_number() OVER (ORDER BY CAST(conv_id AS VARCHAR), turn) - 1 AS VARCHAR), 6, '0') AS extraction_id FROM conversations",
    "summary_choice": f"{_CHAIN} SELECT * FROM z",
    "choice_metadata": f"""{_CHAIN}, k AS (SELECT doc_id, count(*) AS filtered_items, CAST(sum(merged_count) AS BIGINT) AS selected_source_items, count(*) FILTER (reason = 'fallback') AS fallback_items, count(*) FILTER (reason = 'minimum') AS minimum_items, count(*) FILTER (reason = 'balance') AS balance_items FROM z GROUP BY doc_id),
        bad AS (SELECT doc, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM w WHERE starts_with(item_id, 'nope') GROUP BY doc)
        SELECT k.*, n.n AS input_items, round_even(1 - filtered_items / n.n, 4) AS reduction_ratio, bad.ids AS invalid_ids FROM k JOIN n ON n.doc = k.doc_id JOIN bad ON bad.doc = k.doc_id""",
    "bucket_candidates": f"WITH {_CANDIDATES} SELECT doc AS doc_id, item_id FROM cand",
    "run_workload": f"""WITH {_CANDIDATES}, d AS (SELECT doc, count(*) AS n, sum(length(headline)) AS chars FROM cand GROUP BY doc)
        SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS candidates, CAST(sum(chars) AS BIGINT) AS chars, (SELECT count(*) FROM i) AS items, (SELECT string_agg(doc, ',' ORDER BY n DESC, doc) FROM (SELECT * FROM d ORDER BY n DESC, doc LIMIT 8)) AS largest, CAST(sum(chars) // 4 AS BIGINT) AS tokens FROM d""",
    "run_dollars": r"""WITH c AS (SELECT count(*) AS windows, CAST(sum(len(list_filter(regexp_split_to_array(text, '[\s\p{Z}]+'), lambda w: w <> ''))) AS BIGINT) AS words FROM conversations), t AS (SELECT windows, words, CAST(floor(words * 1.3::DOUBLE) AS BIGINT) + 800 * windows AS tokens_in, 250 * windows AS tokens_out FROM c)
        SELECT *, round_even((tokens_in * 2.5::DOUBLE + tokens_out * 10.0::DOUBLE) / 1000000, 6) AS dollars FROM t UNION ALL SELECT *, round_even((tokens_in * 0.15::DOUBLE + tokens_out * 0.6::DOUBLE) / 1000000, 6) FROM t""",
    "summary_entries": """WITH l AS (SELECT *, l_linenumber AS n, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS ps, CASE WHEN l_linenumber % 3 <> 0 THEN l_partkey % 6 END AS pe FROM lineitem)
        SELECT l_orderkey, CAST(n AS BIGINT) AS l_linenumber, CAST(CASE WHEN n % 5 <> 0 THEN n ELSE 3 END AS BIGINT) AS importance, l_partkey, CASE WHEN n % 3 = 1 THEN 'head' ELSE l_returnflag END AS headline, l_returnflag AS exact_quote, CASE WHEN n % 2 = 0 THEN 'casco' ELSE 'general' END AS module,
            coalesce(array_to_string(range(ps, CASE WHEN coalesce(pe, 0) = 0 THEN ps ELSE pe END + 1), ','), '') AS pages, CASE WHEN n % 2 = 1 THEN CAST(l_partkey AS VARCHAR) ELSE '' END AS chunks, 'pechhulp,beperkt_casco,other' AS scopes, n % 4 = 0 AND l_partkey % 2 = 0 AS from_table FROM l""",
    "section_scores": """WITH d AS (SELECT doc_id, lang, [0.9::DOUBLE, 0.7, 0.3, 0.65, 0.6, 0.4, 0.3, 0.9][doc_id % 8 + 1] AS weight, doc_id % 5 + 1 AS imp FROM documents),
        s AS (SELECT *, 0.35::DOUBLE * (imp / 5) + 0.25::DOUBLE * weight + 0.2::DOUBLE * CASE WHEN lang = 'en' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END + 0.1::DOUBLE * (0.5::DOUBLE * CAST(doc_id % 3 = 0 AS INT) + 0.5::DOUBLE * CAST(doc_id % 5 = 0 AS INT)) + 0.07::DOUBLE AS x FROM d)
        SELECT doc_id, weight, round_even(CASE WHEN doc_id % 4 = 0 THEN x * 0.7::DOUBLE ELSE x END, 4) AS score, CAST(CASE WHEN lang <> 'en' AND imp = 5 THEN 1 WHEN lang = 'en' AND imp >= 4 THEN 2 WHEN imp >= 4 THEN 3 ELSE 4 END AS BIGINT) AS priority FROM s""",
    "column_roles": """WITH l AS (SELECT DISTINCT ON (l_orderkey, l_linenumber, l_partkey, l_suppkey) l_orderkey AS d, concat_ws('-', l_linenumber, l_partkey, l_suppkey) AS c, l_returnflag AS f FROM lineitem), o AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY c) AS i FROM l),
        v AS (SELECT d, count(*) FILTER (f = 'A') AS yes, count(*) FILTER (f = 'R') AS no FROM o WHERE d % 3 <> 0 OR i <= 2 GROUP BY d), t AS (SELECT *, ['covered', 'not_covered', 'limit', 'deadline'][d % 4 + 1] AS t FROM v)
        SELECT d AS doc_id, CASE WHEN yes > no AND t = 'not_covered' THEN 'covered' WHEN no > yes AND t IN ('covered', 'limit') THEN 'not_covered' ELSE t END AS item_type, (yes > no AND t = 'not_covered') OR (no > yes AND t IN ('covered', 'limit')) AS column_role_override FROM t""",
    "fuzzy_quotes": f"WITH {_FUZZY} SELECT conv_id, turn, status, score, lpad(CAST(turn AS VARCHAR), 3, '0') AS ids, turn AS page_start, CAST(turn + 2 AS DOUBLE) AS y1 FROM s",
    "quote_statuses": f"WITH {_FUZZY} SELECT status, count(*) AS n FROM s GROUP BY status",
    "text_helpers": """WITH d AS (SELECT doc_id AS k, '<a href=''' || regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g') || '"&>' AS t FROM documents), x AS (SELECT *, trim(regexp_replace(t, ' +', ' ', 'g')) AS n FROM d)
        SELECT k AS doc_id, replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped, CASE WHEN length(n) <= 40 THEN n ELSE rtrim(substr(n, 1, 37)) || '...' END AS cut, CASE WHEN length(n) <= 40 THEN n ELSE rtrim(substr(n, 1, 40)) || '...' END AS cut_after,
            CASE WHEN k % 2 = 0 THEN 'sc' || k || ':c' || (k % 5) ELSE 'd' || k END AS short_id, CASE WHEN k % 3 <> 0 THEN ' <span class=''page-ref''>(p. ' || k || ', ' || (k + 1) || ')</span>' ELSE '' END AS pages, CASE WHEN k % 3 = 0 THEN 7 ELSE k END AS number, CASE WHEN k % 4 = 2 THEN CAST(k AS DOUBLE) END AS y1,
            CASE k % 4 WHEN 0 THEN 'a' || k || '|b' WHEN 1 THEN 'plain' ELSE '' END AS ids FROM x""",
}
