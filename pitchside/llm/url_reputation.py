"""Operator 7: empirical-Bayes host reputation and URL rules (DataFrame functions only).

Labelled page outcomes (bad = the page's label says low quality) are counted per host.
Beta-binomial priors shrink the share of bad pages step by step: every suffix towards the
whole, every registered domain towards its suffix, every host towards its domain.  The
strength of a prior is the method-of-moments estimate of how much the children of a level
really differ.  A host is blocked when the lower posterior bound of its bad share lies
above ``max_bad``; a host without labels inherits its domain's estimate and its wide bound.

Written rules come first: the longest rule that fits a url decides, reputation decides the rest.

Defined cases: a null url, or one without ``://``, has an empty host and path and is judged
by the reputation of the empty host; a page with several label rows counts once, as bad if
any says so; null labels say nothing; repeated page rows all count and are all returned;
without any labels every host has the bound of an even prior, which blocks nothing; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.llm.common import materialize

#: verdict, host, path (fixed values)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
Z = 1.645          # one-sided 95 % bound
MAX_BAD = 0.5      # block above this share of bad pages
M_MIN, M_MAX = 1.0, 1000.0   # bounds of a prior's strength, in pages


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    u = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(u, URL, 1), UPPER, LOWER), F.regexp_extract(u, URL, 2)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict; null where none fits.  ``rules`` is a written list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_levels(host: Column) -> tuple[Column, Column]:
    """Registered domain (the last two labels; a numeric address whole) and suffix (the last label)."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    numeric = name.rlike("^[0-9.]+$")
    return (F.when(numeric, name).otherwise(F.substring_index(name, ".", -2)),
            F.when(numeric, F.lit("")).otherwise(F.substring_index(name, ".", -1)))


def _strength(children: DataFrame, parent_mean: str) -> float:
    """Pages' worth of a prior, from how far the children's shares lie from their parents' means."""
    v = F.col(parent_mean) * (1 - F.col(parent_mean))
    gap = F.col("bad") / F.col("n") - F.col(parent_mean)
    row = (children.where(F.col("n") > 0)
           .agg(F.sum(F.col("n") * gap * gap - v).alias("over"), F.sum((F.col("n") - 1) * v).alias("room")).first())
    if not row["room"] or row["over"] is None:
        return M_MAX
    rho = min(max(row["over"] / row["room"], 1 / (1 + M_MAX)), 1 / (1 + M_MIN))
    return 1 / rho - 1


def host_reputation(pages: DataFrame, labels: DataFrame, z: float = Z) -> DataFrame:
    """One row a host of ``pages(page_id, host)``: n, bad, mean and lower bound of its bad share.

    ``labels(page_id, bad)``.  Hosts, domains and suffixes stay distributed; three numbers
    (one prior strength a level) and two totals reach the driver.
    """
    marks = labels.where(F.col("bad").isNotNull() & F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    counted = (pages.join(marks, "page_id", "left")
               .groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    domain, suffix = host_levels(F.col("host"))
    hosts = materialize(counted.withColumns({"domain": domain, "suffix": suffix}), "hosts")

    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    whole = (total["bad"] + 1) / (total["n"] + 2)

    m = _strength(suffixes.withColumn("above", F.lit(whole)), "above")
    suffixes = suffixes.select("suffix", ((m * whole + F.col("bad")) / (m + F.col("n"))).alias("suffix_mean"))
    domains = domains.join(suffixes, "suffix")
    m = _strength(domains, "suffix_mean")
    domains = domains.select("domain", "suffix", ((m * F.col("suffix_mean") + F.col("bad")) / (m + F.col("n"))).alias("domain_mean"))
    hosts = hosts.join(domains, ["domain", "suffix"])
    m = _strength(hosts, "domain_mean")
    a = m * F.col("domain_mean") + F.col("bad")
    b = m * (1 - F.col("domain_mean")) + F.col("n") - F.col("bad")
    mean = a / (a + b)
    return hosts.select("host", "n", "bad", mean.alias("mean"),
                        (mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("bound"))


def _judged(pages: DataFrame, labels: DataFrame, rules=RULES, z: float = Z, max_bad: float = MAX_BAD) -> DataFrame:
    """Every row of ``pages(page_id, url)`` as ``_row``, with host, path, rule and verdict of its own url."""
    host, path = url_parts(F.col("url"))
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row")
    parts = pages.select(row, "page_id", host.alias("host"), path.alias("path"))
    reputation = host_reputation(parts.select("page_id", "host"), labels, z).select("host", "bound")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    return (parts.join(reputation, "host", "left")
            .select("_row", "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict")))


def judge_urls(pages: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``pages(page_id, url)`` with host, path, the fitting rule and the verdict."""
    return _judged(pages.select("page_id", "url"), labels, **options).drop("_row")


def filter_pages(pages: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``pages`` whose own url is allowed, all their columns kept; rows that share an id are judged one by one."""
    return _judged(pages, labels, **options).where("verdict = 'allow'").select("_row.*")


#: The same verdicts over the registered tables, in DuckDB SQL.
ORACLE_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
marks AS (SELECT doc_id, max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels
          WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
counted AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad
            FROM parts LEFT JOIN marks ON page_id = doc_id GROUP BY host),
named AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM counted),
hosts AS (SELECT host, n, bad,
                 CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name
                      ELSE array_to_string(list_slice(string_split(name, '.'), greatest(len(string_split(name, '.')) - 1, 1), len(string_split(name, '.'))), '.') END AS domain,
                 CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN '' ELSE string_split(name, '.')[-1] END AS suffix
          FROM named),
whole AS (SELECT (coalesce(sum(bad), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) AS p FROM hosts),
suf AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM hosts GROUP BY suffix),
dom AS (SELECT domain, suffix, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM hosts GROUP BY domain, suffix),
m1 AS (SELECT CASE WHEN coalesce(sum((n - 1) * p * (1 - p)), 0) = 0 THEN 1000.0 ELSE
         1.0 / least(greatest(sum(n * (bad / n - p) * (bad / n - p) - p * (1 - p)) / sum((n - 1) * p * (1 - p)), 1.0 / 1001), 0.5) - 1 END AS m
       FROM suf, whole WHERE n > 0),
suf2 AS (SELECT suffix, (m * p + bad) / (m + n) AS mean FROM suf, whole, m1),
dom2 AS (SELECT dom.*, mean AS up FROM dom JOIN suf2 USING (suffix)),
m2 AS (SELECT CASE WHEN coalesce(sum((n - 1) * up * (1 - up)), 0) = 0 THEN 1000.0 ELSE
         1.0 / least(greatest(sum(n * (bad / n - up) * (bad / n - up) - up * (1 - up)) / sum((n - 1) * up * (1 - up)), 1.0 / 1001), 0.5) - 1 END AS m
       FROM dom2 WHERE n > 0),
dom3 AS (SELECT domain, suffix, (m * up + bad) / (m + n) AS up FROM dom2, m2),
host2 AS (SELECT hosts.host, n::DOUBLE AS n, bad::DOUBLE AS bad, up FROM hosts JOIN dom3 USING (domain, suffix)),
m3 AS (SELECT CASE WHEN coalesce(sum((n - 1) * up * (1 - up)), 0) = 0 THEN 1000.0 ELSE
         1.0 / least(greatest(sum(n * (bad / n - up) * (bad / n - up) - up * (1 - up)) / sum((n - 1) * up * (1 - up)), 1.0 / 1001), 0.5) - 1 END AS m
       FROM host2 WHERE n > 0),
post AS (SELECT host, (m * up + bad) / (m + n) AS mean, m + n AS weight FROM host2, m3),
bounds AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) AS bound FROM post),
rules(kind, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
urls AS (SELECT DISTINCT host, path FROM parts),
fits AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(kind, length(h || p)) AS kind
         FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, parts.host AS host, parts.path AS path, rule,
       coalesce(kind, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts JOIN bounds ON parts.host = bounds.host
LEFT JOIN fits ON parts.host = fits.host AND parts.path = fits.path
"""
