"""URL filters as a sort-merge range join, in DataFrame operations only.

A host turned round label by label ("net.example.blog.") makes "this host and its subdomains" a prefix,
and a prefix is an interval of the sorted keys. Rules and URLs are merged into one sorted run; a sweep
over it keeps the rules that are open at each point as a stack with one place per depth in labels: a
rule that starts takes the place of its depth, and an entry whose key no longer begins the URL's key
has ended. Runs are cut by top label; those of hot labels are cut again by a salt, with the label's rules repeated for each, so
that a hot domain spreads over tasks. A label has as many salts as its pages ask for, but never more than keep its
repeated rules below its pages, so rules add no more rows than there are pages.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ROW, ascii_lower, packed, unpacked, written

ROWS_PER_SALT = 1 << 17  # at most, and at most a part in SHARES of all pages
SHARES = 64
HOT_TOPS = 1 << 16  # labels with a larger share of the pages than one in so many may have salts, so fewer labels than that do
#: The production rule list: host, path, action.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without "://" or for null."""
    cut = F.instr(url, "://")
    rest = F.when(cut > 0, F.substr(url, cut + 3)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by a dot; empty for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """(host, path, action) of a list of rules, as literals of the plan."""
    fields = ("host", "path", "action")
    rows = [F.struct(*[F.lit(v).cast("string").alias(k) for k, v in zip(fields, rule)]) for rule in rules]
    none = F.expr("cast(array() as array<struct<host:string,path:string,action:string>>)")
    return spark.range(1).select(F.inline(F.array(*rows) if rows else none))


def hot_tops(pages: DataFrame, rules: DataFrame, rows_per_salt: int | None = None) -> DataFrame:
    """(top, salts) of the labels with more than one salt, from a row (top) for each page and each rule; HOT_TOPS rows at most."""
    total = pages.count()
    if rows_per_salt is None:
        rows_per_salt = max(1, min(ROWS_PER_SALT, math.ceil(total / SHARES)))
    least = max(rows_per_salt, math.ceil(total / HOT_TOPS))
    pages = pages.groupBy("top").agg(F.count("*").alias("n")).filter(F.col("n") > least)
    rules = rules.groupBy("top").agg(F.count("*").alias("rules"))
    most = F.floor(F.col("n") / F.greatest(F.coalesce("rules", F.lit(0)), F.lit(1)))
    salts = F.least(F.ceil(F.col("n") / rows_per_salt), most).cast("int").alias("salts")
    return pages.join(rules, "top", "left").select("top", salts).filter("salts > 1")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT, salts: int | None = None) -> DataFrame:
    """pages with host, path, rule and verdict. rules: (host, path, action).

    A rule fits its host and all subdomains if the URL's path starts with the rule's; the one with most
    labels wins, then the longest path, then the smallest action. Rules with a null or empty host fit
    nothing. A URL that no rule fits has rule null and the default verdict; null or malformed URLs have an
    empty host and path and fit no rule. Repeated pages are judged one by one; very long URLs are judged whole;
    empty tables are allowed. Input columns named like a result column give way.
    """
    entry = F.struct(F.length("path").alias("n"), "path", "action", F.concat("host", "path").alias("rule"))
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action").filter("host <> ''")
    rules = rules.withColumn("key", host_key(F.col("host"))).withColumn("depth", F.size(F.split("host", r"\.", -1)))
    depth = rules.agg(F.max("depth")).first()[0] or 0  # one number; DNS allows 127 labels
    rules = rules.groupBy("key", "depth").agg(F.collect_set(entry).alias("entries"))
    top = lambda key: F.xxhash64(F.substring_index(key, ".", 1))
    rules = rules.select(top(F.col("key")).alias("top"), "key", F.lit(0).alias("kind"), "depth", "entries")
    rows = pages.select(packed(pages), F.col(url).alias("__ls_url"))
    host, path = host_and_path(F.col("__ls_url"))
    rows = rows.withColumns({"host": host, "path": path}).withColumn("key", host_key(F.col("host")))
    rows = rows.withColumns({"top": top(F.col("key")), "kind": F.lit(1)})
    if salts is None:
        cuts = F.broadcast(written(hot_tops(rows.select("top"), rules.select("top"))))
        rows, rules = (t.join(cuts, "top", "left").withColumn("salts", F.coalesce("salts", F.lit(1))) for t in (rows, rules))
    else:
        rows, rules = (t.withColumn("salts", F.lit(salts)) for t in (rows, rules))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(ROW), F.col("salts")).cast("int")).drop("salts")
    rules = rules.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).drop("salts")
    sweep = W.partitionBy("top", "salt").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    merged = rows.unionByName(rules, allowMissingColumns=True)
    slots = [F.last(F.when(F.col("depth") == d, F.struct("key", "entries")), ignorenulls=True).over(sweep) for d in range(depth, 0, -1)]
    merged = merged.withColumn("stack", F.array(*slots) if slots else F.expr("cast(array() as array<struct<key:string,entries:array<struct<n:int,path:string,action:string,rule:string>>>>)"))
    merged = merged.filter("kind = 1")
    open_ = F.filter("stack", lambda s: s.isNotNull() & F.startswith(F.col("key"), s["key"]))
    fit = F.flatten(F.transform(open_, lambda s: F.array_sort(
        F.filter(s["entries"], lambda e: F.startswith(F.col("path"), e["path"])),
        lambda a, b: F.when(a["n"] != b["n"], b["n"] - a["n"]).when(a["action"] < b["action"], -1).when(a["action"] > b["action"], 1).otherwise(0),
    )))
    merged = merged.withColumn("won", F.try_element_at(fit, F.lit(1)))
    return unpacked(merged, pages.columns, {
        "host": F.col("host"), "path": F.col("path"), "rule": F.col("won.rule"),
        "verdict": F.coalesce(F.col("won.action"), F.lit(default)),
    })


ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rhost, rpath, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT h.*, rhost || rpath AS rule, action,
             row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS rn
      FROM h LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE rn = 1
"""
