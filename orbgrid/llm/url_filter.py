"""URL rules by host suffix and path prefix, found through short hash prefixes."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of the digest that candidates are joined on.
PREFIX_BYTES = 4


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return host, path


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def _expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every (host suffix, path prefix) of a url, for the path lengths that rules have."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                fitting, lambda n: F.struct(s.alias("host"), F.substring(path, F.lit(1), n).alias("path"))
            ),
        )
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block).  A rule
    fits its host and all subdomains when the url's path starts with the
    rule's path.  The longest rule text (host and path together) wins; at
    equal length the longer host, and block before allow.  Without a rule the
    verdict is ``default`` (this is a block list: allow).  A null url, or one without
    ``://``, has empty host and path and meets the default.  Rules with a null
    host or path are ignored; a page that repeats is judged each time.

    Each distinct host and path is expanded into its suffix and prefix
    expressions; those meet the rules on the first bytes of their SHA-256, and
    the whole digest and the text confirm.  Nothing is grouped by host alone,
    so a host with a third of the pages is no more than many paths.
    """
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    wanted = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("_rh"), F.col("path").alias("_rp"), "verdict")
        .groupBy("_rh", "_rp")
        .agg(F.max("verdict").alias("_rv"))  # "block" sorts after "allow"
        .withColumn("_full", _digest(F.concat_ws("\n", "_rh", "_rp")))
        .withColumn("_key", F.substring("_full", 1, PREFIX_BYTES))
    )
    # As many numbers as rule paths have lengths.
    lengths = sorted(r[0] for r in wanted.select(F.length("_rp")).distinct().collect())
    distinct = urls.select("host", "path").distinct()
    if lengths:
        tried = distinct.select("host", "path", F.explode(_expressions(F.col("host"), F.col("path"), lengths)).alias("_e"))
    else:
        tried = distinct.where(F.lit(False)).select("host", "path", F.struct("host", "path").alias("_e"))
    tried = tried.withColumn("_d", _digest(F.concat_ws("\n", "_e.host", "_e.path"))).withColumn(
        "_key", F.substring("_d", 1, PREFIX_BYTES)
    )
    found = (
        tried.join(wanted, "_key")
        .where((F.col("_d") == F.col("_full")) & (F.col("_e.host") == F.col("_rh")) & (F.col("_e.path") == F.col("_rp")))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("_rh") + F.length("_rp")).alias("n"),
                    F.length("_rh").alias("h"),
                    F.col("_rv").alias("v"),
                    F.concat("_rh", "_rp").alias("rule"),
                )
            ).alias("_best")
        )
    )
    # The key is made after the aggregation: both sides are shuffled for the join alone, and a hot url's rows can be split.
    judged = found.select(F.struct("host", "path").alias("_url"), "_best")
    return urls.withColumn("_url", F.struct("host", "path")).join(judged, "_url", "left").select(
        "page_id",
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.v"), F.lit(default)).alias("verdict"),
    )
