"""URL verdicts by a sort-merge range join.

A rule (host, path) fits its host, every subdomain of it, and paths that start with
its path. Its canonical key is the host's labels in reverse, a slash, and the path,
so the keys it fits form one interval: those that start with it. A page has one key
for each suffix of its host that has no more labels than the longest rule's, cut to the
length of the longest rule, so a long URL costs no more than its own length. Rules and keys are sorted together; a sweep carries the
stack of rules that are nested around the last rule passed, and a key takes the
innermost rule of the stack that still holds. Ranges of the sorted order are swept
apart; each starts with the rules that are open at its first key. The longest rule
over all keys of a page wins (text length, then the longer host; of two equal rules
the one that blocks).

Defined results: a null url, or one without ``://``, has empty host and path. A page
no rule fits gets the default verdict and a null rule. Rules with a null host or path
fit nothing. Repeated pages are judged alike and all returned. Without rules every page
gets the default; without pages there are no rows. Hosts and paths may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages

DEFAULT_VERDICT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def prefixes(key: Column, lengths: list[int]) -> Column:
    """The starts of a key that are as long as some rule's key."""
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(key))
    return F.transform(fitting, lambda n: F.substring(key, F.lit(1), n))


def open_rules(keys: DataFrame, by: str, rules: DataFrame, lengths: list[int]) -> DataFrame:
    """For every row of ``keys`` (columns ``by``, key) the rules whose key starts its own, outermost first."""
    starts = keys.select(by, F.explode(prefixes(F.col("key"), lengths)).alias("key"))
    return (
        starts.join(rules, "key")
        .groupBy(by)
        .agg(F.array_sort(F.collect_list(F.struct(F.length("key").alias("size"), "key", "rule", "host_size", "verdict"))).alias("stack"))
    )


def judge(pages: DataFrame, page_id: str, url: str, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``; ``rules`` has host, path, verdict."""
    stages = Stages(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    held = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .withColumn("host", F.translate("host", UPPER, LOWER))
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat(F.array_join(reversed_labels(F.col("host")), "."), F.lit("/"), "path").alias("key"),
            F.concat("host", "path").alias("rule"),
            F.length("host").alias("host_size"),
            F.size(reversed_labels(F.col("host"))).alias("labels"),
            "verdict",
        )
    )
    held = stages.write("rules", held)
    # numbers up to the longest rule's; no page is looked at in more detail than some rule has
    lengths = sorted(r[0] for r in held.select(F.length("key")).distinct().collect())
    longest, labels_used = max(lengths, default=0), held.agg(F.max("labels")).first()[0] or 1
    held = held.drop("labels")
    asked = (
        pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
        .groupBy("page_id", "url")
        .agg(F.count("*").alias("copies"))
        .select("page_id", "copies", "url", host.alias("host"), path.alias("path"))
    )
    labels = F.slice(reversed_labels(F.col("host")), 1, labels_used)
    start = F.substring("path", 1, longest)
    keys = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.left(F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit("/"), start), F.lit(longest)),
    )
    probes = asked.select("page_id", "copies", "url", "host", "path", F.explode(keys).alias("key"), F.lit(1).alias("kind"))
    starts = open_rules(held.select(F.col("key").alias("of"), "key"), "of", held, lengths).select(F.col("of").alias("key"), "stack", F.lit(0).alias("kind"))
    # sorted runs of the whole order; page and url part the keys that many pages share
    swept = stages.write(
        "sweep",
        probes.unionByName(starts, allowMissingColumns=True)
        .repartitionByRange("key", "kind", "page_id", "url")
        .withColumn("run", F.spark_partition_id()),
    )
    first = swept.groupBy("run").agg(F.min("key").alias("key"))
    seeds = open_rules(first, "run", held, lengths).join(first, "run").withColumn("kind", F.lit(-1))
    order = W.partitionBy("run").orderBy("key", "kind", "page_id", "url").rowsBetween(W.unboundedPreceding, 0)
    stack = F.last("stack", ignorenulls=True).over(order)
    hits = (
        swept.unionByName(seeds, allowMissingColumns=True)
        .withColumn("stack", stack)
        .where("kind = 1")
        .withColumn("hit", F.get(F.filter("stack", lambda r: F.startswith(F.col("key"), r["key"])), F.lit(-1) + F.size(F.filter("stack", lambda r: F.startswith(F.col("key"), r["key"])))))
    )
    best = hits.groupBy("page_id", "url", "host", "path", "copies").agg(
        F.max(
            F.when(
                F.col("hit").isNotNull(),
                F.struct(F.length("hit.rule").alias("size"), "hit.host_size", "hit.rule", "hit.verdict"),
            )
        ).alias("best")
    )
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


RULES = "VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')"

SQL = f"""
WITH rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path,
         row_number() OVER () AS n
  FROM rest
), rules(rule_host, rule_path, verdict) AS ({RULES}),
best AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path) * 1000 + length(rule_host)) AS rule,
         arg_max(r.verdict, length(rule_host || rule_path) * 1000 + length(rule_host)) AS verdict
  FROM parts p JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT_VERDICT}') AS verdict FROM parts LEFT JOIN best USING (n)
"""


@query("op10_url_filter", SQL)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.sql(f"SELECT * FROM {RULES} AS rules(host, path, verdict)")
    return judge(pages, "page_id", "url", rules)
