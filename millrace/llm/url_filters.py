"""URL filters by hash lookup of host-suffix and path-prefix expressions, DataFrame only.

Every URL is expanded into all combinations of a suffix of its host, at label
bounds, and a prefix of its path, at slashes. Expressions join the rules on a
short prefix of their SHA-256 digest; the full digest then confirms a match, so
a clash of prefixes never decides. Of the confirmed rules the longest one wins.

Distinct URLs are judged once. Rules are broadcast in blocks of a bounded
number of rows, so URLs are shuffled for their final join only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_RULES = 200_000  # rows broadcast at once; a row has two digests and the rule
_PREFIX = 8  # hex digits of the short digest


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def expressions(host: Column, path: Column) -> Column:
    """Host suffixes times path prefixes, as ``host/path/`` texts; none without a host."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.split(path, "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda i: F.concat(F.array_join(F.slice(steps, 1, i), "/"), F.lit("/")))
    prefixes = F.when(F.size(steps) > 1, prefixes).otherwise(F.array().cast("array<string>"))
    both = F.flatten(F.transform(hosts, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    return F.when(host != "", F.array_distinct(both)).otherwise(F.array().cast("array<string>"))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", prefix: str = "url_") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` as columns named with ``prefix``.

    ``rules(rule, verdict)``: a rule is a host and a path that ends with a slash,
    written together (``example.com/en/``); it fits the host and its subdomains if
    the path begins with the rule's. The longest fitting rule wins; of equal
    rules with two verdicts, ``block``. Without one the rule is NULL and the verdict
    ``default``. A NULL URL or one without ``://`` has an empty host and path.
    """
    own = rules.filter("rule IS NOT NULL").groupBy("rule").agg(F.max("verdict").alias("verdict"))
    bad = F.raise_error(F.concat(F.lit("the path of a URL rule must end with a slash: "), F.col("rule")))
    own = own.select(F.when(F.col("rule").endswith("/"), F.col("rule")).otherwise(bad).alias("rule"), "verdict")
    own = own.withColumn("digest", F.sha2("rule", 256)).withColumn("short", F.substring("digest", 1, _PREFIX))
    n = own.count() // BLOCK_RULES + 1
    blocks = [F.broadcast(own.filter(F.pmod(F.xxhash64("rule"), F.lit(n)) == k)) for k in range(n)]

    # Names that no column of ``pages`` has, whatever its columns are called.
    asked_url, found = (next(n for n in (f"{x}{'_' * k}" for k in range(1, len(pages.columns) + 2)) if n not in pages.columns) for x in ("url", "found"))
    url = F.coalesce(F.col("u"), F.lit(""))
    urls = pages.select(F.col(url_col).alias("u")).filter("u IS NOT NULL").distinct()
    asked = urls.select("u", F.explode(expressions(url_host(url), url_path(url))).alias("e")).withColumn("full", F.sha2("e", 256))
    asked = asked.withColumn("short", F.substring("full", 1, _PREFIX))
    fits = reduce(DataFrame.union, [asked.join(b, "short").filter("full = digest").select("u", "rule", "verdict") for b in blocks])
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule")).alias(found)
    best = fits.groupBy(F.col("u").alias(asked_url)).agg(best)
    whole = F.coalesce(F.col(url_col), F.lit(""))
    return pages.join(best, F.col(url_col) == F.col(asked_url), "left").select(
        *pages.columns,
        url_host(whole).alias(f"{prefix}host"), url_path(whole).alias(f"{prefix}path"),
        F.col(f"{found}.rule").alias(f"{prefix}rule"), F.coalesce(f"{found}.verdict", F.lit(default)).alias(f"{prefix}verdict"),
    )
