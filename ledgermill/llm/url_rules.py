"""URL rules by hashed host-suffix and path-prefix expressions.

A rule ``host/path`` fits its host and all subdomains if the url's path starts with the rule's path.
Every url is expanded into expressions: its host suffixes joined with its path prefixes. Prefix
lengths come from the rules of that host suffix, so a url makes no more expressions than could fit.
Expressions meet rules by a short prefix of their digest, then the full digest confirms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hexadecimal digits of a digest on which urls and rules are joined.
SHORT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) pairs, a rule being ``host/path`` or a bare host, as a frame."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _host_suffixes(host: Column, deepest: Column) -> Column:
    """The last labels of the host, 1 to ``deepest`` of them and no more than it has; none for an empty host.

    A suffix with more labels than any rule's host fits no rule, so a host of any length has few.
    """
    most = F.least(_labels(host), deepest)
    return F.when(
        (host != "") & (most >= 1),
        F.transform(F.sequence(F.lit(1), most), lambda k: F.call_function("substring_index", host, F.lit("."), -k)),
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest fitting rule wins; of two equally long ones that with the longer host, then the one
    that blocks. A page that no rule fits has a null rule and the ``default`` verdict. A null url,
    one without ``://`` and an empty host fit no rule. Repeated rows are returned as often as they
    occur; rules that are null or have no host are ignored; extra columns are not read.
    """
    slash = F.instr("rule", "/")
    known = rules.filter("rule is not null and verdict is not null").select(
        F.col("verdict").alias("rule_verdict"),
        F.col("rule").alias("rule_text"),
        F.translate(
            F.when(slash > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule")), _UPPER, _LOWER
        ).alias("rule_host"),
        F.when(slash > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit("")).alias("rule_path"),
    ).filter("rule_host <> ''")
    # One number, read when the query runs; null without rules.
    deepest = known.agg(F.max(_labels(F.col("rule_host"))).alias("n")).scalar()
    known = known.select(
        "rule_verdict", "rule_text", "rule_host", F.length("rule_path").alias("rule_length"),
        _digest(F.concat("rule_host", "rule_path")).alias("rule_digest"),
    ).withColumn("rule_short", F.substring("rule_digest", 1, SHORT))
    # Prefix lengths that occur per host; at most one number per character of the longest rule.
    hosts = known.groupBy("rule_host").agg(F.collect_set("rule_length").alias("lengths")).select(
        "lengths", _digest(F.col("rule_host")).alias("host_digest"),
        F.substring(_digest(F.col("rule_host")), 1, SHORT).alias("host_short"),
    )

    # Equal rows are judged once and returned as often as they came.
    urls = (
        pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .groupBy("page_id", "host", "path").agg(F.count(F.lit(1)).alias("copies"))
    )
    suffix = _digest(F.col("suffix"))
    expressions = (
        urls.withColumn("deepest", deepest)
        .select("*", F.explode(_host_suffixes(F.col("host"), F.col("deepest"))).alias("suffix"))
        .withColumn("short", F.substring(suffix, 1, SHORT))
        .join(hosts, F.col("short") == F.col("host_short"))
        .filter(suffix == F.col("host_digest"))
        .select(
            "page_id", "host", "path", "copies", "suffix",
            F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"),
        )
        .select(
            "page_id", "host", "path", "copies",
            _digest(F.concat("suffix", F.expr("substring(path, 1, n)"))).alias("digest"),
        )
    )
    fits = (
        expressions.withColumn("short", F.substring("digest", 1, SHORT))
        .join(known, F.col("short") == F.col("rule_short"))
        .filter("digest = rule_digest")
        .select(
            "page_id", "host", "path", "copies",
            F.struct(
                F.length("rule_text").alias("n"), F.length("rule_host").alias("h"),
                (F.col("rule_verdict") == "block").alias("b"),
                F.col("rule_text").alias("rule"), F.col("rule_verdict").alias("verdict"),
            ).alias("fit"),
        )
    )
    none = F.lit(None).cast(fits.schema["fit"].dataType)
    return (
        fits.unionByName(urls.withColumn("fit", none))
        .groupBy("page_id", "host", "path", "copies").agg(F.max("fit").alias("fit"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(
            "page_id", "host", "path", F.col("fit.rule").alias("rule"),
            F.coalesce("fit.verdict", F.lit(default)).alias("verdict"),
        )
    )
