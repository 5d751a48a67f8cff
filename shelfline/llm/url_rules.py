"""URL filters by a sort-merge range join of canonical keys.

A rule (host, path, verdict) fits a url whose host is the rule's host or a subdomain of it and
whose path starts with the rule's path. A host is turned round label by label
(``blog.example.net`` gives ``net.example.blog``), so that a host and its subdomains share a
prefix; a reversed host, a space and a path make the canonical key, and every rule is the interval of the
keys that start with its own. A url is looked up once for each of its enclosing hosts that any
rule names, since a path rule of a parent host has one interval per enclosing host.

The sweep sorts rules and urls by key. Intervals are nested or apart, so the state of the sweep
is the stack of rules open at this place. A rule brings its whole stack (itself and the rules around
it) along; a url takes the last stack seen and drops from its top what has already ended.
The innermost rule left on the stack is the longest that fits within that host.

Everything is a DataFrame expression. Keys are distinct before the sweep, so a url on a third of all
rows is one row in it. A host with many urls is cut into slices; each slice holds the rules of
that host and a share of its urls, and slices are so many that rules are not copied more often than
there are urls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import lowered, table
from shelfline.operators.lookups import if_small, join_folded

SEPARATOR = " "  # sorts before every character of a host or path but control characters
SLICE_ROWS = 512

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    return F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def _enclosing_hosts(host: Column) -> Column:
    """The host and every domain around it, reversed."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, 1, n), "."))


def _with_stacks(rules: DataFrame) -> DataFrame:
    """Each rule with the rules of the same host around it, outermost first, itself last."""
    prefixes = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    inner = rules.select("node", "path", F.explode(prefixes).alias("outer_path"))
    outer = rules.select("node", F.col("path").alias("outer_path"), F.struct("path", "rule", "verdict").alias("one"))
    return inner.join(outer, ["node", "outer_path"]).groupBy("node", "path").agg(F.array_sort(F.collect_list("one")).alias("stack"))


def match_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of those names are replaced.

    The longest rule (host and path together) wins; of rules as long as each other the one with the longer
    host, and of equal rules that disagree the one to block. Rules with a null host or path are
    left out. A url that no rule fits, one without ``://`` and a null url get a null rule and the
    ``default`` verdict. Repeated pages stay repeated; an empty table gives an empty result.
    """
    pages = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).drop("rule", "verdict")
    rules = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(lowered(F.col("host")).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # "block" sorts after "allow"
        .select(_reversed_host(F.col("host")).alias("node"), "path", F.concat("host", "path").alias("rule"), "verdict")
    )
    urls = pages.select("host", "path").distinct()
    # Hosts with rules are broadcast if they are few, and so are their slices, no more rows.
    plain = rules.select("node").distinct()
    nodes = if_small(plain)
    looked_up = join_folded(urls.select("host", "path", F.explode(_enclosing_hosts(F.col("host"))).alias("node")), nodes, ["node"], "inner")

    # As many slices as keep both the urls and the copies of the rules in a slice in proportion.
    sizes = looked_up.groupBy("node").agg(F.count(F.lit(1)).alias("n_urls"))
    sizes = sizes.join(rules.groupBy("node").agg(F.count(F.lit(1)).alias("n_rules")), "node").select(
        "node", F.ceil(F.col("n_urls") / F.greatest(F.col("n_rules"), F.lit(slice_rows))).cast("int").alias("slices")
    )
    sizes = sizes if nodes is plain else F.broadcast(sizes)
    key = F.concat("node", F.lit(SEPARATOR), "path")
    points = join_folded(looked_up, sizes, ["node"], "inner").select(
        "node", F.pmod(F.xxhash64("host", "path"), F.col("slices")).cast("int").alias("slice"), key.alias("key"),
        F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("array<struct<path:string,rule:string,verdict:string>>").alias("stack"),
    )
    starts = _with_stacks(rules).join(sizes, "node").select(
        "node", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), key.alias("key"),
        F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "stack",
    )
    sweep = Window.partitionBy("node", "slice").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    # The slices of a host go to different tasks, whatever it was joined by.
    swept = points.unionByName(starts).repartition("node", "slice").withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    still_open = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]))
    innermost = F.element_at(still_open, -1)
    best = (
        swept.where(F.size(still_open) > 0)
        .select("host", "path", innermost["rule"].alias("rule"), innermost["verdict"].alias("verdict"), F.length("node").alias("host_length"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "host_length", "rule", "verdict")).alias("__best"))
    )
    return join_folded(pages, best, ["host", "path"]).select(
        *[F.col(f"`{c}`") for c in pages.columns], F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict")
    )


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return match_urls(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = r"""
with parsed as (
    select page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
), rules(rule_host, rule_path, rule_verdict) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged as (
    select page_id, host, path, (
        select max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, verdict := rule_verdict))
        from rules
        where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    ) as best
    from parsed
)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from judged
"""
