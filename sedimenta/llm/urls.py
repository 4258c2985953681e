"""URL filtering by host-suffix and path-prefix expressions.

A rule names a host and a path prefix. It fits the host itself and all its subdomains, for
paths that start with the prefix. Each URL is expanded into every expression "host suffix +
path prefix" that a rule could have. Expressions and rules meet in an equi-join on the first
bytes of their digests; the full digests then confirm. Of the rules that fit, the longest
decides, of equally long ones a blocking one.

Nothing is compared pairwise: a URL makes as many expressions as the deepest rule has labels
times path segments. Equal host and path pairs are judged once, so a host with a third of
all rows costs its distinct paths only.

Defined results: a null URL, or one without "://", has empty host and path and fits no rule; a
URL that no rule fits gets `default`. Repeated rows are judged alike. Columns of the input
named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import ascii_lower

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX_HEX = 8  # 32 bits of the digest


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def host_suffixes(host: Column, most: int) -> Column:
    """The last 1 to `most` labels of a host, and the host itself if it has no more."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most))),
        lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."),
    )


def path_prefixes(path: Column, most: int) -> Column:
    """The prefixes of a path that end in its first `most` slashes."""
    parts = F.split(path, "/")
    slashes = F.least(F.size(parts) - 1, F.lit(most))
    return F.when(
        slashes > 0,
        F.transform(
            F.sequence(F.lit(1), slashes),
            lambda k: F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")),
        ),
    ).otherwise(F.array().cast("array<string>"))


def digested(rules: DataFrame) -> DataFrame:
    """rule, digest, prefix and verdict; one row per rule, a blocking one before others.

    Rules have columns host, path and verdict. A path must start and end with a slash:
    prefixes of URLs are taken at slashes only.
    """
    expression = F.concat(ascii_lower(F.col("host")), F.col("path"))
    digest = F.sha2(expression, 256)
    checked = F.when(F.col("path").rlike("(?s)^/(.*/)?$"), expression).otherwise(
        F.raise_error(F.concat(F.lit("a rule's path must start and end with /: "), "path"))
    )
    return rules.groupBy(checked.alias("rule"), digest.alias("rule_digest")).agg(
        F.max_by("verdict", F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("rule_verdict")
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX))


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule (null where none fits) and verdict to every row."""
    depth = rules.agg(
        F.max(F.size(F.split("host", r"\."))), F.max(F.size(F.split("path", "/")) - 1)
    ).first()
    labels, segments = (d or 1 for d in depth)
    parted = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    places = parted.select(F.col("host").alias("_h"), F.col("path").alias("_p")).distinct()
    expanded = places.select(
        "_h", "_p", F.explode(host_suffixes(F.col("_h"), labels)).alias("_suffix")
    ).select(
        "_h",
        "_p",
        F.explode(
            F.transform(path_prefixes(F.col("_p"), segments), lambda p: F.concat("_suffix", p))
        ).alias("_expression"),
    ).withColumn("_digest", F.sha2("_expression", 256))
    known = digested(rules)
    fitting = expanded.join(
        known,
        (F.substring(F.col("_digest"), 1, PREFIX_HEX) == known.prefix)
        & (F.col("_digest") == known.rule_digest),
    )
    best = fitting.groupBy("_h", "_p").agg(
        F.max_by(F.struct("rule", "rule_verdict"), F.struct(F.length("rule"), "rule")).alias("_best")
    )
    joined = parted.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    return joined.withColumns(
        {
            "rule": F.col("_best.rule"),
            "verdict": F.coalesce(F.col("_best.rule_verdict"), F.lit(default)),
        }
    ).drop("_h", "_p", "_best")
