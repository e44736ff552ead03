"""URL allow and block rules by a sort-merge range join, in DataFrame functions only.

The canonical key of a host is its labels in reverse order, each followed by a dot, so a host
and all its subdomains are one interval of keys, and the intervals of rules are nested or
apart. Urls and rule hosts are sorted by key and swept together: at each rule host the sweep
takes up the stack of rules whose intervals are open there, which is the rules of the host
and of its parents, and an url meets the stack taken up last. Rules whose interval has
ended are no prefixes of the url's key and fall out of the stack; of those left, the
longest whose path starts the url's path decides.

Urls are dealt over `runs` sorted runs by a hash of all their columns, so a host with a
third of all urls spreads; each run gets the rule hosts, so rules should be few beside urls.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there
up to `?`, `#` or the end; both empty for a null url or one without `://`. Longest is by the
length of host and path together, then of the host; of an allow and a block rule with
the same host and path the block rule holds. Rules without a host are ignored, a null path
is empty. An url that meets no rule gets a null rule and the default verdict. Repeated
rows stay repeated, null ids are carried, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS_PER_PARTITION = 4


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    """Labels in reverse order, each with a dot after it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (action, host, path)."""
    return spark.createDataFrame(rules, "action string, host string, path string")


def open_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): for each rule host the rules of the host and of all its parents."""
    rules = rules.filter("host != ''").select(
        F.translate("host", UPPER, LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "action",
    )
    rules = rules.distinct().withColumn("key", host_key(F.col("host")))
    entry = F.struct(
        (F.length("host") + F.length("path")).alias("length"),
        F.length("host").alias("host_length"),
        "action",  # block sorts after allow
        "key",
        "path",
        F.concat("host", "path").alias("rule"),
    )
    own = rules.groupBy("key").agg(F.collect_list(entry).alias("own"))
    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.")
    depth = F.explode(F.sequence(F.lit(1), F.size(labels)))
    parents = own.select("key", depth.alias("n"), labels.alias("labels")).select(
        "key", F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("n")), "."), F.lit(".")).alias("parent")
    )
    above = own.select(F.col("key").alias("parent"), "own")
    return parents.join(above, "parent").groupBy("key").agg(F.flatten(F.collect_list("own")).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", runs: int | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every url."""
    spark = pages.sparkSession
    if runs is None:
        runs = RUNS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"), F.xxhash64("page_id", "url").alias("_h"))
    urls = urls.select(
        F.pmod("_h", F.lit(runs)).alias("run"),
        host_key(F.col("host")).alias("key"),
        F.lit(1).alias("kind"),
        "page_id",
        "host",
        "path",
    )
    heads = open_stacks(rules).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long"))).alias("run"),
        "key",
        F.lit(0).alias("kind"),
        "stack",
    )
    swept = urls.unionByName(heads, allowMissingColumns=True)
    order = Window.partitionBy("run").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = swept.withColumn("stack", F.last("stack", ignorenulls=True).over(order)).filter("kind = 1")
    fits = F.filter(
        "stack", lambda r: F.startswith(F.col("key"), r["key"]) & F.startswith(F.col("path"), r["path"])
    )
    best = F.array_max(fits)
    return swept.select(
        "page_id",
        "host",
        "path",
        best["rule"].alias("rule"),
        F.coalesce(best["action"], F.lit(default)).alias("verdict"),
    )
