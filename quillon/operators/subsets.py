"""Random subsets of labelled scores, stratified and of fixed size, counted without being drawn row by row.

A subset without replacement is the k rows of a class with the least hash, a hash for each subset. One pass counts, by class
and bin between thresholds, the rows whose hash lies surely below the k-th: one aggregate with a column a subset, so a row
stays a row. The rows near the k-th, about six deviations either way and few (a share that falls with the root of the
class size), are ordered exactly. With replacement the k draws of a class fall on its bins as on its rows, so their counts
are drawn from the counts by bin (multinomial), whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.shared import kept

#: Hashes are numbers below this prime.
PRIME = 2**31 - 1
_FIRST, _SECOND = 48271, 69621
DEVIATIONS = 6.0


def hash_parts(key: Column, seed: int) -> tuple[Column, Column]:
    """Two numbers below PRIME from one digest of key and seed."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))
    part = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long") % PRIME
    return part(1), part(9)


def factors(subset: int) -> tuple[int, int]:
    """What the two numbers are multiplied by for a subset: powers of two roots, so no two subsets share an order."""
    return pow(_FIRST, subset + 1, PRIME), pow(_SECOND, subset + 1, PRIME)


def subset_hash(a: Column, b: Column, subset: int) -> Column:
    m, n = factors(subset)
    return (a * m + b * n) % PRIME


def draw_sizes(counts: DataFrame, by: list[str], size: float | int) -> DataFrame:
    """by, y, n, k from counts (by, y, n): a fraction is rounded for each class; a whole number is the size of both classes
    together, dealt in proportion (the larger remainder first, of equals the positives'), the whole table at most."""
    if isinstance(size, float):
        return counts.withColumn("k", F.round(F.lit(size) * F.col("n")).cast("long"))
    group = Window.partitionBy(*by)  # two rows a group
    total = F.least(F.lit(size), F.sum("n").over(group))
    ones = F.round(total * F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).over(group) / F.sum("n").over(group)).cast("long")
    return counts.withColumn("k", F.when(F.col("y") == 1, ones).otherwise(total - ones).cast("long"))


def subset_counts(rows: DataFrame, by: list[str], id_col: str, *, subsets: int = 100, size: float | int = 0.2, replacement: bool = False, seed: int = 42) -> DataFrame:
    """by, y, subset, bin, w (rows drawn, 0 left out) of rows (by, id, y, bin)."""
    keys = [*by, "y"]
    bins = kept(rows.groupBy(*keys, "bin").agg(F.count("*").alias("c")), "bins")
    sizes = draw_sizes(bins.groupBy(*keys).agg(F.sum("c").alias("n")), by, size)
    # a class of a group, as one column that joins null names too
    sizes = kept(sizes.select(F.struct(*keys).alias("_g"), "n", "k"), "sizes")
    if replacement:
        out = _multinomial(bins.select(F.struct(*keys).alias("_g"), "bin", "c"), sizes, subsets, seed)
    else:
        out = _least_hashes(rows.select(F.struct(*keys).alias("_g"), "bin", F.col(id_col).cast("string").alias("_id")), sizes, subsets, seed)
    return out.select(*(F.col("_g")[c].alias(c) for c in keys), "subset", "bin", "w")


def _least_hashes(rows: DataFrame, sizes: DataFrame, subsets: int, seed: int) -> DataFrame:
    share = F.col("k") / F.col("n")
    width = F.sqrt(share * (1 - share) / F.col("n")) + 2.0 / PRIME
    a, b = hash_parts(F.col("_id"), seed)
    hashed = kept(rows.withColumns({"_a": a, "_b": b}), "hashed")
    full = F.explode(F.sequence(F.lit(0), F.lit(subsets - 1))).alias("subset")
    reach = DEVIATIONS
    while True:
        low = F.greatest(F.floor((share - reach * width) * PRIME), F.lit(0)).cast("long")
        high = F.least(F.ceil((share + reach * width) * PRIME), F.lit(PRIME)).cast("long")
        known = hashed.join(F.broadcast(sizes.select("_g", "k", low.alias("_low"), high.alias("_high"))), "_g")
        below = known.groupBy("_g", "bin").agg(*(F.count_if(subset_hash(F.col("_a"), F.col("_b"), s) < F.col("_low")).alias(f"s{s}") for s in range(subsets)))
        sure = below.select("_g", "bin", F.posexplode(F.array(*(F.col(f"s{s}") for s in range(subsets)))).alias("subset", "w"))
        sure = kept(sure.filter("w > 0"), "sure")
        each = F.array(*(F.struct(F.lit(s).alias("subset"), *(F.lit(f).alias(f"f{i}") for i, f in enumerate(factors(s)))) for s in range(subsets)))
        hashes = F.transform(each, lambda f: F.struct(f["subset"].alias("subset"), ((F.col("_a") * f["f0"] + F.col("_b") * f["f1"]) % PRIME).alias("u")))
        band = known.select("_g", "bin", "_id", "_a", "_b", "k", F.inline(F.filter(hashes, lambda x: (x["u"] >= F.col("_low")) & (x["u"] < F.col("_high")))))
        place = F.row_number().over(Window.partitionBy("_g", "subset").orderBy("u", "_a", "_b", "_id"))
        before = sure.groupBy("_g", "subset").agg(F.sum("w").alias("_sure"))
        placed = band.withColumn("_place", place).join(before, ["_g", "subset"], "left")
        chosen = placed.filter(F.col("_place") <= F.col("k") - F.coalesce("_sure", F.lit(0)))
        chosen = kept(chosen.groupBy("_g", "subset", "bin").agg(F.count("*").alias("w")), "near")
        out = sure.unionByName(chosen).groupBy("_g", "subset", "bin").agg(F.sum("w").alias("w"))
        drawn = out.groupBy("_g", "subset").agg(F.sum("w").alias("_drawn"))
        wrong = sizes.filter("k > 0").select("_g", "k", full).join(drawn, ["_g", "subset"], "left").filter(F.coalesce("_drawn", F.lit(0)) != F.col("k"))
        if wrong.isEmpty():
            return out
        reach *= 4  # some k-th hash lies further out: rare, and sure to end, for the reach grows to all hashes


def _multinomial(bins: DataFrame, sizes: DataFrame, subsets: int, seed: int) -> DataFrame:
    keys = [f"_g.{f.name}" for f in bins.schema["_g"].dataType.fields]
    rows = bins.join(F.broadcast(sizes.select("_g", "k")), "_g").withColumn("_seed", F.xxhash64(F.lit(seed), *(F.col(c).cast("string") for c in keys)))

    def draw(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("bin")
        counts = part["c"].to_numpy(dtype=float)
        rng = np.random.default_rng(int(part["_seed"].iloc[0]) % 2**63)
        w = rng.multinomial(int(part["k"].iloc[0]), counts / counts.sum(), size=subsets)
        s, i = np.nonzero(w)
        return pd.DataFrame({"_name": part["_name"].iloc[0], "subset": s.astype("int32"), "bin": part["bin"].to_numpy()[i].astype("int32"), "w": w[s, i]})

    # one group is the bins of one class: as many rows as there are thresholds; groups go by their text
    named = rows.withColumn("_name", F.to_json("_g"))
    drawn = named.groupBy("_name").applyInPandas(draw, "_name string, subset int, bin int, w long")
    return drawn.join(F.broadcast(named.select("_name", "_g").distinct()), "_name").drop("_name")


def binned(df: DataFrame, thresholds: list[float]) -> Column:
    """How many thresholds a score reaches."""
    return F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda t: F.col("p") >= t))


def cells(counts: DataFrame, by: list[str], thresholds: list[float]) -> DataFrame:
    """by, threshold, tp, tn, fp, fn from counts (by, y, bin, w): cumulated from the highest bin down."""
    upper = lambda y, i: F.sum(F.when((F.col("y") == y) & (F.col("bin") >= i), F.col("w")).otherwise(0)).alias(f"c{y}_{i}")
    wide = counts.groupBy(*by).agg(*(upper(y, i) for y in (0, 1) for i in range(len(thresholds) + 1)))
    cell = lambda i, t: F.struct(F.lit(t).alias("threshold"), F.col(f"c1_{i}").alias("tp"), F.col(f"c0_{i}").alias("fp"), (F.col("c1_0") - F.col(f"c1_{i}")).alias("fn"), (F.col("c0_0") - F.col(f"c0_{i}")).alias("tn"))
    return wide.select(*by, F.inline(F.array(*(cell(i + 1, t) for i, t in enumerate(thresholds)))))
