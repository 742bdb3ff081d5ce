"""Preservation completeness: which enumerated URLs each channel holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls


def inventory(rows: DataFrame) -> DataFrame:
    """Normal URLs of rows (url and, if there, synthetic, state, title): url, is_synthetic. Bad URLs abort."""
    col = lambda name, kind: F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)
    flag = text.is_synthetic(col("synthetic", "boolean"), col("state", "string"), col("title", "string"))
    return rows.select(urls.require_urls(F.col("url")).alias("url"), flag.alias("is_synthetic"))


def inventory_counts(found: DataFrame) -> DataFrame:
    """One row: distinct urls, duplicates and synthetic urls; synthetic rows count as neither of the first two."""
    real = F.when(~F.col("is_synthetic"), F.col("url"))
    return found.agg(F.count_distinct(real).alias("n_urls"), (F.count(real) - F.count_distinct(real)).alias("n_duplicates"), F.count_distinct(F.when(F.col("is_synthetic"), F.col("url"))).alias("n_synthetic"))


def membership(expected: DataFrame, channels: dict[str, DataFrame]) -> DataFrame:
    """Every known url with booleans: expected, and one per channel.

    One aggregate over the union of tagged urls; no join per channel.
    """
    tagged = [df.select("url", F.lit(name).alias("channel")) for name, df in {"expected": expected, **channels}.items()]
    names = ["expected", *channels]
    together = reduce(DataFrame.unionByName, tagged)
    return together.groupBy("url").agg(*[F.bool_or(F.col("channel") == n).alias(n) for n in names])


def channel_metrics(member: DataFrame, channels: list[str]) -> DataFrame:
    """Per channel: observed, matched, missing, unexpected, percent (4 places), complete.

    Without expected urls the percentage is 0 and the channel is incomplete.
    """
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias("held")) for c in channels])).alias("r")
    flat = member.select("expected", rows).select("expected", "r.*")
    both = F.col("expected") & F.col("held")
    out = flat.groupBy("channel").agg(F.count_if("held").alias("observed"), F.count_if(both).alias("matched"), F.count_if(F.col("expected") & ~F.col("held")).alias("missing"), F.count_if(~F.col("expected") & F.col("held")).alias("unexpected"), F.count_if("expected").alias("n"))
    share = F.when(F.col("n") == 0, F.lit(0.0)).otherwise(F.bround(100 * F.col("matched") / F.col("n"), 4))
    return out.select("channel", "observed", "matched", "missing", "unexpected", share.alias("percent"), ((F.col("n") > 0) & (F.col("missing") == 0)).alias("complete"))


def url_lists(member: DataFrame, channel: str) -> tuple[DataFrame, DataFrame]:
    """Missing and unexpected urls of a channel, as tables."""
    return member.where(F.col("expected") & ~F.col(channel)).select("url"), member.where(~F.col("expected") & F.col(channel)).select("url")


def redundancy(member: DataFrame, channels: list[str]) -> DataFrame:
    """One row over expected urls: held at least once, by the first two, by two or more."""
    held = reduce(lambda a, b: a + b, [F.col(c).cast("int") for c in channels])
    known = member.where("expected")
    return known.agg(F.count("*").alias("denominator"), F.count_if(held >= 1).alias("at_least_one"), F.count_if(F.col(channels[0]) & F.col(channels[1])).alias("dual"), F.count_if(held >= 2).alias("redundant"))


def report(expected: DataFrame, channels: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Channel metrics and redundancy."""
    member = membership(expected, channels)
    return channel_metrics(member, list(channels)), redundancy(member, list(channels))
