"""URL rules by host suffix and path prefix, looked up by hashed expressions.

A rule ``host + path`` fits the urls of its host and of all subdomains whose path starts with the
rule's. Each url is expanded into the expressions that a rule could have: every suffix of the host
at a dot, times every prefix of the path with a length that some rule has. Expressions meet rules
in an equi-join on the first hex digits of their digest; the full digest then confirms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8

_AFTER = "://([^/?#]*)"
_PATH = "://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.coalesce(F.regexp_extract(url, _AFTER, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _digest(host: Column, path: Column) -> Column:
    # The length of the host keeps ("a", "b/c") and ("ab", "/c") apart.
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path), 256)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows of ``pages`` plus ``host``, ``path``, ``rule`` (host and path of the winning rule,
    NULL if none fits) and ``verdict`` (the rule's, else ``default``).

    The longest rule wins (host and path together); of rules equally long the one with the longer
    host, then the one that blocks, then the first by text. NULL urls and urls without ``://`` have
    an empty host and path, which no rule with a host fits. Rules with a NULL host, path or verdict
    are left out; a repeated rule counts once. Rows of ``pages`` may repeat. Columns of ``pages``
    named like a result column are replaced.

    Equal pairs of host and path are judged once, whatever number of rows has them. The rules join
    as an ordinary table: Spark broadcasts them only below its threshold for the size of a side.
    """
    row = F.struct(*pages.drop("host", "path", "rule", "verdict").columns)
    rows = pages.select(row.alias("__row"), host_of(F.col(url)).alias("__host"), path_of(F.col(url)).alias("__path"))
    rules = rules.select("verdict", "host", "path").dropna().distinct()
    table = rules.select(
        _digest(F.col("host"), F.col("path")).alias("__digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"),
            F.length("host").alias("host_size"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("verdict"),
        ).alias("__fit"),
    ).withColumn("__short", F.substring("__digest", 1, PREFIX_DIGITS))
    # One value; path lengths are few however many rules there are.
    lengths = rules.agg(F.sort_array(F.collect_set(F.length("path")))).scalar()

    distinct = rows.select("__host", "__path").distinct()
    labels = F.split("__host", "\\.", -1)
    expressions = (
        distinct.withColumns({"__labels": labels, "__lengths": lengths})
        .withColumn("__n", F.explode(F.sequence(F.lit(1), F.size("__labels"))))
        .withColumn("__suffix", F.array_join(F.slice("__labels", F.col("__n"), 1 << 20), "."))
        .withColumn("__size", F.explode(F.filter("__lengths", lambda n: n <= F.length("__path"))))
        .withColumn("__digest", _digest(F.col("__suffix"), F.expr("substring(__path, 1, __size)")))
        .withColumn("__short", F.substring("__digest", 1, PREFIX_DIGITS))
    )
    best = (
        expressions.alias("e")
        .join(table.alias("r"), "__short")
        .filter(F.col("e.__digest") == F.col("r.__digest"))
        .groupBy("__host", "__path")
        .agg(F.max("__fit").alias("__fit"))
    )
    out = rows.join(best, ["__host", "__path"], "left")
    return out.select(
        "__row.*",
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__fit.rule").alias("rule"),
        F.coalesce("__fit.verdict", F.lit(default)).alias("verdict"),
    )
