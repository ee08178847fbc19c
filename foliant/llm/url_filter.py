"""Operator 5: URL verdicts from rules and a path-template tree, in DataFrame functions only.

Rules (host, path, verdict) fit their host and its subdomains where the path starts with the
rule's; the longest wins. They also label the tree that judges the URLs no rule fits:

1. Path segments are typed (numbers, hexadecimal runs); URLs of one host and typed path are
   one shape, aggregated before anything is joined. Paths of any depth are told apart.
2. Every prefix of a shape is a node of its host's tree, with counts of URLs and labels. A
   child whose share of blocked labels does not differ from its parent's (chi-square below
   ``z2``), or that has no labels, merges into the parent's wildcard; the others stay.
3. A template is a shape after these decisions. Its purity, the share of blocked labels, is
   smoothed towards its host's, that towards the same template's on all hosts, and that
   towards all labels. From 0.5 on the template is rejected.

Defined results: a null URL or one without "://" has an empty host and path and is judged by
the tree like any other. Null ids and repeated rows are judged as rows of their own. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MAX_RULES = 1000  # rules are one expression; more belong in a table of their own


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    at = F.instr(F.col(url_col), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    return (
        pages.withColumn("__rest", F.coalesce(rest, F.lit("")))
        .withColumn("__host", F.regexp_extract("__rest", r"^([^/?#]*)", 1))
        .withColumn("path", F.regexp_extract(F.expr("substring(__rest, length(__host) + 1)"), r"^([^?#]*)", 1))
        .withColumn("host", F.translate("__host", UPPER, LOWER))
        .drop("__rest", "__host")
    )


def _first_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[F.Column, F.Column]:
    """The longest rule that fits, and its verdict."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    z2: float = 3.84,
    smooth: float = 2.0,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of every row."""
    rule, says = _first_rule(rules)
    typed = lambda s: F.when(s.rlike("^[0-9]+$"), "<n>").when(s.rlike("^[0-9a-f]{8,}$"), "<h>").otherwise(F.translate(s, UPPER, LOWER))
    urls = (
        with_host_and_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
        .withColumn("rule", rule)
        .withColumn("says", says)
        .withColumn("segs", F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), typed))
        .withColumn("shape", F.array_join("segs", "/"))
    )
    labelled, blocked = F.col("rule").isNotNull().cast("long"), F.coalesce((F.col("says") == "block").cast("long"), F.lit(0))
    shapes = urls.groupBy("host", "shape").agg(F.sum(labelled).alias("l"), F.sum(blocked).alias("b"))
    at = F.explode(F.sequence(F.lit(1), F.size("segs")))
    steps = (
        shapes.where("shape <> ''")
        .withColumn("segs", F.split("shape", "/"))
        .select("host", "shape", "l", "b", "segs", at.alias("i"))
        .select("host", "shape", "l", "b", "i", F.expr("unhex(md5(array_join(slice(segs, 1, i - 1), '/')))").alias("parent"), F.expr("segs[i - 1]").alias("seg"))
    )
    nodes = steps.groupBy("host", "i", "parent", "seg").agg(F.sum("l").alias("l"), F.sum("b").alias("b"))
    parents = nodes.groupBy("host", "i", "parent").agg(F.sum("l").alias("pl"), F.sum("b").alias("pb"))
    spread = (F.col("l") * F.col("pb") * (F.col("pl") - F.col("pb"))).cast("double")
    gap = (F.col("b") * F.col("pl") - F.col("pb") * F.col("l")).cast("double")
    differs = (spread > 0) & (gap * gap >= spread * z2)
    kept = nodes.join(parents, ["host", "i", "parent"]).select("host", "i", "parent", "seg", F.when(differs, F.col("seg")).otherwise("*").alias("t"))
    templates = (
        steps.join(kept, ["host", "i", "parent", "seg"])
        .groupBy("host", "shape")
        .agg(F.array_sort(F.collect_list(F.struct("i", "t"))).alias("ts"))
        .select("host", "shape", F.array_join(F.transform("ts", lambda x: x["t"]), "/").alias("template"))
    )
    placed = shapes.join(templates, ["host", "shape"], "left").withColumn("template", F.coalesce("template", F.lit("")))
    by = lambda *keys: placed.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("b").alias("b"))
    own, hosts, across, total = by("host", "template"), by("host"), by("template"), by()
    total = total.select(((F.coalesce("b", F.lit(0)) + 1) / (F.coalesce("l", F.lit(0)) + 2)).alias("g"))
    across = across.crossJoin(F.broadcast(total)).select("template", ((F.col("b") + smooth * F.col("g")) / (F.col("l") + smooth)).alias("a"))  # total is one row
    hosts = hosts.select("host", F.col("l").alias("hl"), F.col("b").alias("hb"))
    rate = (F.col("hb") + smooth * F.col("a")) / (F.col("hl") + smooth)
    purity = (F.col("b") + smooth * rate) / (F.col("l") + smooth)
    judged = own.join(hosts, "host").join(across, "template").select("host", "template", purity.alias("purity"))
    verdicts = placed.select("host", "shape", "template").join(judged, ["host", "template"])
    return (
        urls.select("page_id", "host", "path", "rule", "says", "shape")
        .join(verdicts, ["host", "shape"])
        .select("page_id", "host", "path", "rule", F.coalesce("says", F.when(F.col("purity") >= 0.5, "block").otherwise("allow")).alias("verdict"), "template", "purity")
    )


SQL = r"""
    WITH r AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), p AS (
        SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS h FROM r
    ), q AS (
        SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(substr(rest, length(h) + 1), '^([^?#]*)', 1) AS path FROM p
    ), u AS (
        SELECT *, CASE
            WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
        END AS rule,
        array_to_string(list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: CASE
            WHEN regexp_full_match(s, '[0-9]+') THEN '<n>' WHEN regexp_full_match(s, '[0-9a-f]{8,}') THEN '<h>'
            ELSE translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END), '/') AS shape
        FROM q
    ), v AS (
        SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS says FROM u
    ), shapes AS (
        SELECT host, shape, CAST(count(rule) AS BIGINT) AS l, CAST(count(*) FILTER (says = 'block') AS BIGINT) AS b FROM v GROUP BY host, shape
    ), steps AS (
        SELECT host, shape, l, b, i, array_to_string(segs[1 : i - 1], '/') AS parent, segs[i] AS seg
        FROM (SELECT *, unnest(range(1, len(segs) + 1)) AS i FROM (SELECT *, string_split(shape, '/') AS segs FROM shapes WHERE shape <> ''))
    ), nodes AS (
        SELECT host, i, parent, seg, CAST(sum(l) AS BIGINT) AS l, CAST(sum(b) AS BIGINT) AS b FROM steps GROUP BY ALL
    ), parents AS (
        SELECT host, i, parent, CAST(sum(l) AS BIGINT) AS pl, CAST(sum(b) AS BIGINT) AS pb FROM nodes GROUP BY ALL
    ), kept AS (
        SELECT host, i, parent, seg, CASE WHEN l * pb * (pl - pb) > 0
            AND CAST(b * pl - pb * l AS DOUBLE) * CAST(b * pl - pb * l AS DOUBLE) >= CAST(l * pb * (pl - pb) AS DOUBLE) * 3.84::DOUBLE THEN seg ELSE '*' END AS t
        FROM nodes JOIN parents USING (host, i, parent)
    ), templates AS (
        SELECT host, shape, string_agg(t, '/' ORDER BY i) AS template FROM steps JOIN kept USING (host, i, parent, seg) GROUP BY host, shape
    ), placed AS (
        SELECT host, shape, l, b, coalesce(template, '') AS template FROM shapes LEFT JOIN templates USING (host, shape)
    ), total AS (SELECT (coalesce(sum(b), 0) + 1)::DOUBLE / (coalesce(sum(l), 0) + 2)::DOUBLE AS g FROM placed
    ), across AS (
        SELECT template, (sum(b)::DOUBLE + 2.0::DOUBLE * g) / (sum(l)::DOUBLE + 2.0::DOUBLE) AS a FROM placed, total GROUP BY template, g
    ), hosts AS (SELECT host, sum(l)::DOUBLE AS hl, sum(b)::DOUBLE AS hb FROM placed GROUP BY host
    ), judged AS (
        SELECT host, template, (sum(b)::DOUBLE + 2.0::DOUBLE * ((hb + 2.0::DOUBLE * a) / (hl + 2.0::DOUBLE))) / (sum(l)::DOUBLE + 2.0::DOUBLE) AS purity
        FROM placed JOIN hosts USING (host) JOIN across USING (template) GROUP BY host, template, hb, hl, a
    )
    SELECT page_id, host, path, rule, coalesce(says, CASE WHEN purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template, purity
    FROM v JOIN placed USING (host, shape) JOIN judged USING (host, template)
"""
