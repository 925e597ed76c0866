"""Running totals over a whole table without one task that holds it.

Rows are dealt to ranges of (group, order, ties) by a sort-range repartition, so neither a frequent value nor a large group
lands in one task; totals run inside each range in parallel, and each range then adds what came before it. The number of
ranges follows the number of rows; a table of few rows is one range a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.shared import kept

#: Rows of a range, and ranges at most.
RANGE_ROWS = 100_000
RANGES = 20_000


def running(df: DataFrame, by: list[str], order: str, values: list[str], *, ties: str | None = None, descending: bool = False, ranges: int | None = None, keep: bool = True) -> DataFrame:
    """df with cum_<v> for each value: its sum over rows of the same group up to and with this one, in order.

    Rows that are equal in `order` are ordered by `ties`; without ties they should be unique in a group. df is written once
    and read for its size, its ranges and its rows (keep=False: it is a stored table already); callers pass the columns they
    need. ranges: how many, by default from the number of rows.
    """
    df = kept(df, "ordered") if keep else df
    ranges = ranges or min(RANGES, -(-df.count() // RANGE_ROWS))
    down = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    inside = [down(order), *([F.col(ties).asc()] if ties else [])]
    upto = (Window.unboundedPreceding, 0)
    if ranges <= 1:
        own = Window.partitionBy(*by).orderBy(*inside).rowsBetween(*upto)
        return df.select(*df.columns, *(F.sum(v).over(own).alias(f"cum_{v}") for v in values))
    dealt = in_ranges(df, [*(F.col(b) for b in by), *inside], ranges)
    inner = Window.partitionBy(*by, "_range").orderBy(*inside).rowsBetween(*upto)
    outer = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each group and range
    totals = dealt.groupBy(*by, "_range").agg(*(F.sum(v).alias(v) for v in values))
    keys = [*by, "_range"]
    before = totals.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)), *(F.coalesce(F.sum(v).over(outer), F.lit(0)).alias(f"_before_{v}") for v in values))
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    summed = dealt.withColumns({f"cum_{v}": F.sum(v).over(inner) for v in values})
    joined = summed.join(before, same)
    return joined.select(*df.columns, *((F.col(f"cum_{v}") + F.col(f"_before_{v}")).alias(f"cum_{v}") for v in values))


def in_ranges(df: DataFrame, order: list[Column], ranges: int) -> DataFrame:
    """df with _range, stored, so that all that follows sees one dealing: ranges follow one another in the order."""
    return kept(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def numbered(df: DataFrame, by: list[str], order: str, ties: str, *, descending: bool = False, name: str = "row", keep: bool = True, ranges: int | None = None) -> DataFrame:
    """df with the place (from 1) of each row in its group's order."""
    out = running(df.withColumn("_one", F.lit(1)), by, order, ["_one"], ties=ties, descending=descending, keep=keep, ranges=ranges)
    return out.withColumnRenamed("cum__one", name).drop("_one")
