"""URL filters (operator 7): allow and block rules as a sort-merge range join.

A rule is a host and a path prefix; it fits a url whose host is the rule's or a
subdomain of it and whose path starts with the rule's. A host is written with
its labels reversed, followed by a separator and the path. In that canonical
key a rule is a prefix, so it is the interval of keys that start with it, and
intervals either nest or are apart.

Each different (host, path) of the urls gives one key per host suffix that is a
rule's host. Keys and rules are sorted together; a window sweep carries along
the stack of the latest rule (itself and the rules around it), and a key keeps
the deepest rule of that stack that is still open, that is, a prefix of the key.

Skew: rows are first brought down to different (host, path) with partial
aggregates, and the keys of one host suffix are dealt over ``SALTS`` slices, to
each of which its rules are copied, so no host lands in one task.

Only DataFrame functions are used. Defined cases: a null url or one without
``://`` has empty host and path and no rule unless a rule's host is empty;
repeated rows stay; a page without a fitting rule gets ``default``; a rule with a
null host or path is left out; of rules with the same host and path the smallest
verdict by code point holds; no pages give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from responsekit.llm.common import pack_row, read
from responsekit.session import materialize

SALTS = 128
#: Slices of one salt; the keys of different host suffixes are spread over them.
HOST_SLICES = 16
#: Rule hosts up to this number are broadcast to drop other host suffixes early (at 100 bytes a host: 10 MB).
MAX_BROADCAST_HOSTS = 100_000

#: The rules of the registered query (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def canonical_rules(rules: DataFrame) -> DataFrame:
    """Rules (verdict, host, path) with their reversed host ``h`` and ``stack``: the rules of the same
    host whose path is a prefix of theirs, themselves included, outermost first.

    Prefixes are looked up by equality (each rule lists the prefixes of its own path)."""
    one = (rules.where("host is not null and path is not null").groupBy("host", "path")
           .agg(F.min("verdict").alias("verdict"))
           .select(reversed_host(F.translate("host", UPPER, LOWER)).alias("h"), "path", "verdict",
                   F.concat("host", "path").alias("rule")))
    prefixes = one.select("h", F.col("path").alias("inner"), F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n"))
    prefixes = prefixes.select("h", "inner", F.expr("substring(inner, 1, n)").alias("path"))
    return (prefixes.join(one, ["h", "path"]).groupBy("h", F.col("inner").alias("path"))
            .agg(F.sort_array(F.collect_list(F.struct(F.length("path").alias("n"), "path", "rule", "verdict"))).alias("stack")))


def judge_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of every different (host, path) of ``urls`` that has one:
    host, path, rule, verdict. Of equally long rules the one with the longer host holds."""
    ruled = canonical_rules(rules)
    hosts = ruled.select("h").distinct()
    keys = urls.select("host", "path").distinct()
    labels = F.split(F.col("host"), r"\.")
    keys = (keys.select("host", "path", F.reverse(labels).alias("labels"))
            .select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size("labels")),
                                                          lambda n: F.array_join(F.slice("labels", 1, n), "."))).alias("h")))
    keys = keys.join(F.broadcast(hosts) if rules.count() <= MAX_BROADCAST_HOSTS else hosts, "h", "left_semi")
    slice_of = F.pmod(F.xxhash64("h"), F.lit(HOST_SLICES)) * SALTS
    points = keys.select((slice_of + F.pmod(F.xxhash64("path", "host"), F.lit(SALTS))).alias("slice"),
                         "h", "path", F.lit(1).alias("kind"), "host",
                         F.lit(None).cast(ruled.schema["stack"].dataType).alias("stack"))
    copies = ruled.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    starts = copies.select((slice_of + F.col("salt")).alias("slice"), "h", "path", F.lit(0).alias("kind"),
                           F.lit(None).cast("string").alias("host"), "stack")
    sweep = Window.partitionBy("slice").orderBy("h", "path", "kind").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.last(F.when(F.col("kind") == 0, F.struct("h", "stack")), ignorenulls=True).over(sweep)
    swept = points.unionByName(starts).withColumn("latest", latest).where("kind = 1 and latest.h = h")
    still_open = F.filter("latest.stack", lambda r: F.startswith(F.col("path"), r["path"]))
    fits = swept.select("host", "path", F.length("h").alias("host_chars"), F.element_at(F.when(F.size(still_open) > 0, still_open), -1).alias("r"))
    return (fits.where("r is not null").groupBy("host", "path")
            .agg(F.max(F.struct(F.length("r.rule").alias("n"), "host_chars", "r.rule", "r.verdict")).alias("best"))
            .select("host", "path", "best.rule", "best.verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` as struct ``row``, with host, path, rule and verdict."""
    parts = pages.select(pack_row(pages), url_host(F.col(url_col)).alias("host"),
                         url_path(F.col(url_col)).alias("path"))
    # written before it is joined back, so that adaptive execution can split a url that very many pages have
    judged = materialize(judge_urls(parts, rules))
    return (parts.join(judged, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rules).select("row.page_id", "host", "path", "rule", "verdict")


_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

SQL = f"""
WITH rules(verdict, rhost, rpath) AS (VALUES {_RULES_SQL}),
cut AS (SELECT page_id, url, CASE WHEN strpos(coalesce(url, ''), '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, row_number() OVER () AS rn,
          translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT rn, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY rn ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
         FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (rn)
"""
