"""Exact order statistics of many groups at once, by histograms refined around the wanted places.

A pass counts the rows of each group by bin of an interval (one aggregate, combined before the shuffle) and keeps the bin
in which a wanted place lies, with the least and greatest value in it. The first pass bins by magnitude and sign, so that a
range of any width shrinks to one of a few powers of two; the next ones bin evenly. An interval is done when it holds one
value; one of a few rows is ordered at last. No task ever holds a group's values, nor its distinct ones, and the number
of passes depends on the width of a double, not on the table.

Every place is found from weights: that of weight K is the least value v for which the rows up to v weigh K or more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.shared import kept

BINS = 1024
#: An interval of so many rows is ordered within one task.
FEW = 4096
#: Intervals are broadcast while there are at most so many; else the same join shuffles.
BROADCAST = 100_000
LARGEST = 1.7976931348623157e308


def _magnitude(x: Column) -> Column:
    """An increasing function that is about the signed binary logarithm, 1100 added to it: at most 2,200 either way."""
    size = F.abs(x)
    power = F.floor(F.log2(size)).cast("double")
    # in two steps, as 2^power alone may be no finite number
    mantissa = size / F.power(F.lit(2.0), F.floor(power / 2)) / F.power(F.lit(2.0), power - F.floor(power / 2))
    return F.when(size > 0, F.signum(x) * (1100 + power + mantissa)).otherwise(F.lit(0.0))


def _bin(x: Column, lo: Column, hi: Column, bins: int, first: bool) -> Column:
    if first:
        at, width = _magnitude(x) - _magnitude(lo), _magnitude(hi) - _magnitude(lo)
    else:  # halves where the width alone is no finite number; no halves else, they lose the least numbers' last bit
        wide = hi - lo > LARGEST
        at, width = F.when(wide, x / 2 - lo / 2).otherwise(x - lo), F.when(wide, hi / 2 - lo / 2).otherwise(hi - lo)
    place = F.least(F.floor(at / width * bins), F.lit(bins - 1)).cast("int")
    return F.when(width > 0, place).otherwise(F.lit(0))  # neighbours may be of one magnitude


def _rows(df: DataFrame, by: list[str], column: str, weight: str | None) -> DataFrame:
    """_g (the group), _x and _w of rows with a number; infinities count as the largest finite number."""
    x = F.col(column).cast("double")
    held = F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST))
    group = F.struct(*(F.col(b) for b in by)) if by else F.struct(F.lit(0).alias("all"))
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return df.filter(x.isNotNull() & ~F.isnan(x)).select(group.alias("_g"), held.alias("_x"), w.alias("_w"))


def _in_intervals(rows: DataFrame, open_: DataFrame, *, small: bool) -> DataFrame:
    """The rows that lie in an open interval, with it; a group's intervals are equal or apart."""
    intervals = open_.select("_g", "_lo", "_hi", "_before").distinct()
    here = rows.withColumnRenamed("_g", "_h").join(F.broadcast(intervals) if small else intervals, (F.col("_h") == F.col("_g")) & (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
    return here.drop("_h")


def _narrowed(counts: DataFrame, open_: DataFrame) -> DataFrame:
    """Open places with the bin (_b, from _lo2 to _hi2, of weight _c and _r rows) in which they lie."""
    own = Window.partitionBy("_g", "_lo").orderBy("_b")
    upto = counts.withColumn("_upto", F.col("_before") + F.sum("_c").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    part = upto.select(F.col("_g").alias("_h"), F.col("_lo").alias("_l"), "_lo2", "_hi2", "_c", "_r", "_upto")
    met = open_.select("_g", "_k", "_lo").join(part, (F.col("_g") == F.col("_h")) & (F.col("_lo") == F.col("_l")) & (F.col("_k") > F.col("_upto") - F.col("_c")) & (F.col("_k") <= F.col("_upto")))
    return met.select("_g", "_k", F.col("_lo2").alias("_lo"), F.col("_hi2").alias("_hi"), (F.col("_upto") - F.col("_c")).alias("_before"), F.col("_r").alias("_rows"))


def _places(rows: DataFrame, wanted: DataFrame, bins: int, few: int) -> DataFrame:
    """_g, _k and _v for wanted: rows (_g, _k, _lo, _hi, _before, _rows), an interval that holds each place."""
    state, first = wanted, True
    while True:
        wide = F.col("_lo") < F.col("_hi")
        left = state.agg(F.max(F.when(wide, F.col("_rows"))).alias("most"), F.count_if(wide).alias("open")).first()
        if not left["open"]:
            return state.select("_g", "_k", F.col("_lo").alias("_v"))
        last = left["most"] <= few
        far = wide if last else wide & (F.col("_rows") > few)
        open_ = state.filter(far)
        inside = _in_intervals(rows, open_, small=left["open"] <= BROADCAST)
        # at last every value is a bin of its own
        place = F.col("_x") if last else _bin(F.col("_x"), F.col("_lo"), F.col("_hi"), bins, first)
        binned = inside.withColumn("_b", place).groupBy("_g", "_lo", "_before", "_b")
        counts = binned.agg(F.sum("_w").alias("_c"), F.count("*").alias("_r"), F.min("_x").alias("_lo2"), F.max("_x").alias("_hi2"))
        state, first = state.filter(~far).unionByName(_narrowed(counts, open_)), False
        if last:
            return state.select("_g", "_k", F.col("_lo").alias("_v"))
        state = kept(state, "places")


def _whole(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_g").agg(F.sum("_w").alias("_total"), F.count("*").alias("_rows"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))


def bars(df: DataFrame, by: list[str], column: str, wanted: Column, *, weight: str | None = None, keep: bool = True, bins: int = BINS, few: int = FEW) -> DataFrame:
    """by, bar, total (weight of the group): the least value up to which rows weigh `wanted` (a column over _total, the group's weight) or more.

    bar is null where wanted is below 1; a greater one than the total is the total. keep=False: df is read again at each
    pass instead of being written once as groups and numbers.
    """
    rows = _rows(df, by, column, weight)
    rows = kept(rows, "numbers") if keep else rows
    whole = kept(_whole(rows).withColumn("_k", F.least(F.coalesce(wanted, F.lit(0)), F.col("_total")).cast("long")), "groups")
    state = whole.filter("_k >= 1").select("_g", "_k", "_lo", "_hi", F.lit(0).cast("long").alias("_before"), "_rows")
    found = _places(rows, state, bins, few).select(F.col("_g").alias("_h"), "_v")
    out = whole.join(found, F.col("_g") == F.col("_h"), "left")
    return out.select(*(F.col("_g")[b].alias(b) for b in by), F.col("_v").alias("bar"), F.col("_total").alias("total"))


def quantiles(df: DataFrame, by: list[str], column: str, shares: list[float], *, keep: bool = True, name: str = "q", ends: bool = False, bins: int = BINS, few: int = FEW) -> DataFrame:
    """by and an array of the exact quantiles at shares, linear between neighbours; null and NaN are left out.

    ends: with columns least and greatest."""
    rows = _rows(df, by, column, None)
    rows = kept(rows, "numbers") if keep else rows
    whole = kept(_whole(rows), "groups")
    given = F.array(*(F.lit(float(s)) for s in shares))
    at = lambda s: s * (F.col("_total") - 1) + 1
    both = F.flatten(F.transform(given, lambda s: F.array(F.floor(at(s)).cast("long"), F.ceil(at(s)).cast("long"))))
    state = whole.select("_g", F.explode(F.array_distinct(both)).alias("_k"), "_lo", "_hi", F.lit(0).cast("long").alias("_before"), "_rows")
    found = _places(rows, state, bins, few).groupBy(F.col("_g").alias("_h")).agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("_m"))
    out = whole.join(found, F.col("_g") == F.col("_h"))

    def value(s: Column) -> Column:
        below, above = F.floor(at(s)).cast("long"), F.ceil(at(s)).cast("long")
        low, high = F.col("_m")[below], F.col("_m")[above]
        return F.when(below == above, low).otherwise(low * (above - at(s)) + high * (at(s) - below))

    extremes = [F.col("_lo").alias("least"), F.col("_hi").alias("greatest")] if ends else []
    return out.select(*(F.col("_g")[b].alias(b) for b in by), F.transform(given, value).alias(name), *extremes)


def quantile(df: DataFrame, column: str, share: float, **how) -> float | None:
    """One quantile of a whole column."""
    got = quantiles(df, [], column, [share], **how).first()
    return got["q"][0] if got else None
