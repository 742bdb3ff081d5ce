"""Running sums and maxima over a whole table without putting it into one task.

A running aggregate in a global order is a scan in two levels: rows are cut into ranges of
the order, each range gives one total, and every row adds what the ranges before its own
have given to what its own range has given before it. Cuts come from a bounded sample
taken by hash; ranges differ in size, results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

SAMPLE = 4096


def cuts_of(df: DataFrame, order: list[str], parts: int) -> list[tuple]:
    """At most ``parts`` - 1 keys that cut the order into ranges of about equal size.

    One count, and a sample of about ``SAMPLE`` keys (at most four times as many), reach the driver.
    """
    n = df.count()
    if n < 2 or parts < 2:
        return []
    kept = df.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(1 << 30)) <= min(1 << 30, (1 << 30) * SAMPLE // n)).distinct()
    keys = sorted((tuple(r) for r in kept.limit(4 * SAMPLE).collect()), key=lambda k: tuple((x is not None, x) for x in k))
    return [keys[len(keys) * i // parts] for i in range(1, parts) if i == 1 or len(keys) * i // parts > len(keys) * (i - 1) // parts] if keys else []


def range_of(df: DataFrame, order: list[str], cuts: list[tuple]) -> Column:
    """Number of the range of a row's key, by a balanced tree of comparisons."""
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    kinds = [df.schema[c].dataType for c in order]
    edge = lambda cut: F.struct(*[F.lit(x).cast(t).alias(f"k{i}") for i, (x, t) in enumerate(zip(cut, kinds, strict=True))])

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key < edge(cuts[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))

    return tree(0, len(cuts))


def _literal(value) -> Column:
    return F.struct(*[_literal(x).alias(n) for n, x in value.asDict().items()]) if isinstance(value, Row) else F.lit(value)


def scan(df: DataFrame, order: list[str], sums: Mapping[str, Column] | None = None, maxima: Mapping[str, Column] | None = None, parts: int = 64) -> DataFrame:
    """Adds, under the given names, sums and maxima over all rows before a row in the order.

    Sums start at 0 and skip nulls; a maximum is null where nothing came before. The order
    should be total: rows that tie in all of it are taken in any order, as in a window. One row
    a range reaches the driver; no exchange has a single partition.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    cuts = cuts_of(df, order, parts)
    dealt = df.withColumn("_range", range_of(df, order, cuts))
    totals = {r["_range"]: r for r in dealt.groupBy("_range").agg(*[F.sum(c).alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in maxima.items()]).collect()}
    inner = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    kinds = {f.name: f.dataType for f in dealt.groupBy().agg(*[F.sum(c).alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in maxima.items()]).schema}
    new = {}
    for name, column in (sums | maxima).items():
        carried, held = [], 0 if name in sums else None
        for i in range(len(cuts) + 1):
            carried.append(held)
            got = totals[i][name] if i in totals else None
            if got is not None:
                held = held + got if name in sums else got if held is None else max(held, got)
        carry = F.array(*[_literal(x).cast(kinds[name]) for x in carried])[F.col("_range")]
        new[name] = F.coalesce(F.sum(column).over(inner), F.lit(0)) + carry if name in sums else F.array_max(F.array(F.max(column).over(inner), carry))
    return dealt.withColumns(new).drop("_range")


def ordinals(df: DataFrame, order: list[str], name: str = "ordinal", parts: int = 64) -> DataFrame:
    """Adds the place of every row in the order, from 0."""
    return scan(df, order, {name: F.lit(1).cast("bigint")}, parts=parts)
