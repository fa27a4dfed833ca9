"""URL filter: host-suffix and path-prefix expressions joined with a rule table by short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import ascii_lower

PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """Lower-cased host: after the first `://` up to `/`, `?`, `#` or the end; empty without `://`."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Path behind the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _labels(host: Column) -> Column:
    return F.when(host == "", F.lit(0)).otherwise(F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1)


def _folder(path: Column) -> Column:
    """The path up to its last slash."""
    return F.regexp_extract(path, r"(?s)^.*/", 0)


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _counts(least: int, most: int, present: Column) -> Column:
    """The numbers from `least` to `most` that are not above `present`."""
    return F.filter(F.sequence(F.lit(least), F.lit(most)), lambda n: n <= present)


def _host_suffixes(host: Column, least: int, most: int) -> Column:
    parts = F.split(host, r"\.")
    return F.transform(_counts(least, most, _labels(host)), lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))


def _path_prefixes(path: Column, least: int, most: int) -> Column:
    parts = F.split(path, "/")
    return F.transform(
        _counts(least, most, _slashes(path)),
        lambda n: F.when(n == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/"))),
    )


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), folder).cast("binary"), 256)


def rule_index(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with the digest of host and folder, each rule once.

    A rule with a null host or path counts as one with an empty host or path; of equal rules
    with different actions `block` stays.
    """
    clean = rules.select(
        ascii_lower(F.coalesce("host", F.lit(""))).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("action"),
    ).where(F.col("action").isNotNull())
    one = clean.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
    digest = _digest(F.col("rule_host"), _folder(F.col("rule_path")))
    return one.select("*", digest.alias("digest"), F.substring(digest, 1, PREFIX_DIGITS).alias("short"))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """`key`, host, path, rule and verdict of every row.

    A rule fits its host and all subdomains where the path starts with the rule's path; the longest
    rule wins, and among equally long ones the longer host, then `block`, then the later text. Without
    a fitting rule the rule is null and the verdict is `default`. An URL expands into no more host
    suffixes and path folders than the deepest rule has, so long URLs stay cheap. Rows are counted by
    (key, url) before they expand and come back as often as they were there; null keys and urls
    are kept. An empty table of pages gives no rows, an empty rule table only defaults. Other columns are
    not looked at, whatever they are called.
    """
    index = rule_index(rules)
    least_labels, most_labels, least_depth, most_depth = index.agg(
        *(f(_labels(F.col("rule_host"))) for f in (F.min, F.max)),
        *(f(_slashes(_folder(F.col("rule_path")))) for f in (F.min, F.max)),
    ).first()
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url")).groupBy("key", "url").agg(F.count(F.lit(1)).alias("copies"))
    parts = rows.select("key", "url", "copies", host_of(F.coalesce("url", F.lit(""))).alias("host"), path_of(F.coalesce("url", F.lit(""))).alias("path"))
    if least_labels is None:
        judged = parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    else:
        expanded = (
            parts.select("*", F.explode_outer(_host_suffixes(F.col("host"), least_labels, most_labels)).alias("suffix"))
            .select("*", F.explode_outer(_path_prefixes(F.col("path"), least_depth, most_depth)).alias("prefix"))
            .withColumn("full", _digest(F.col("suffix"), F.col("prefix")))
        )
        joined = expanded.join(index, F.substring("full", 1, PREFIX_DIGITS) == F.col("short"), "left")
        fits = (F.col("full") == F.col("digest")) & F.col("path").startswith(F.col("rule_path"))
        rank = F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("length"),
            F.length("rule_host").alias("host_length"),
            F.col("action"),
            F.concat("rule_host", "rule_path").alias("rule"),
        )
        best = joined.groupBy("key", "url").agg(
            F.any_value("copies").alias("copies"), F.any_value("host").alias("host"), F.any_value("path").alias("path"), F.max(F.when(fits, rank)).alias("best")
        )
        judged = best.select("*", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
    return judged.select(F.col("key").alias(key), "host", "path", "rule", "verdict", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
