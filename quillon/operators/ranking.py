"""Ranking, agreement and distribution tables over scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.ordered import numbered, running
from quillon.functions.selection import bars
from quillon.functions.shared import kept
from quillon.operators.metrics import score_counts


def hit_list(pooled: DataFrame, scores: DataFrame, n: int = 25) -> DataFrame:
    """The n highest pooled scores (ties by id) with call, deviation over descriptors and domain; the limit is the feature."""
    top = pooled.orderBy(F.desc("clf"), "compound_id").limit(n)
    spread = scores.join(F.broadcast(top.select("compound_id")), "compound_id", "left_semi").groupBy("compound_id").agg(F.stddev_pop("p").alias("std"))
    rank = F.row_number().over(Window.orderBy(F.desc("clf"), "compound_id"))  # n rows
    return top.join(spread, "compound_id", "left").withColumn("rank", rank).select("rank", "compound_id", "clf", "clf_bin", "std", "clf_ad")


def rank_curve(pooled: DataFrame) -> DataFrame:
    """compound_id, clf, pct: the share of the library at or above each entity's place, in per cent."""
    placed = numbered(pooled.select("compound_id", "clf"), [], "clf", "compound_id", descending=True, name="place")
    n = pooled.agg(F.count("*").alias("n"))
    return placed.join(F.broadcast(n)).select("compound_id", "clf", (100 * F.col("place") / F.col("n")).alias("pct"))


def active_share(pooled: DataFrame, cutoff: float = 0.5) -> DataFrame:
    return pooled.agg(F.avg((F.col("clf") >= cutoff).cast("double")).alias("share"))


def consensus(scores: DataFrame, pooled: DataFrame) -> DataFrame:
    """compound_id, clf, std and mean over descriptors."""
    per = scores.groupBy("compound_id").agg(F.stddev_pop("p").alias("std"), F.avg("p").alias("mean"))
    return pooled.select("compound_id", "clf").join(per, "compound_id")


def average_ranks(scores: DataFrame) -> DataFrame:
    """compound_id, descriptor, r: tie-averaged rank by score within the descriptor; scores are counted before ranking."""
    counts = score_counts(scores.withColumn("y", F.lit(0)), ["descriptor"]).select("descriptor", "p", "n")
    ranks = running(counts, ["descriptor"], "p", ["n"]).select("descriptor", "p", (F.col("cum_n") - (F.col("n") - 1) / 2).alias("r"))
    return scores.join(ranks, ["descriptor", "p"]).select("compound_id", "descriptor", "r")


def spearman_matrix(scores: DataFrame, descriptors: list[str]) -> DataFrame:
    """a, b, rho for each pair of descriptors: correlation of tie-averaged ranks, all pairs in one pass."""
    wide = average_ranks(scores).groupBy("compound_id").pivot("descriptor", descriptors).agg(F.first("r"))
    pairs = [(a, b) for i, a in enumerate(descriptors) for b in descriptors[i + 1 :]]
    got = wide.agg(*(F.corr(f"`{a}`", f"`{b}`").alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    return got.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("rho")) for i, (a, b) in enumerate(pairs)))))


def depths(n: int, count: int = 40) -> list[int]:
    """Geometric depths from max(1, round(0.005 n)) to n."""
    lo = max(1, round(0.005 * n))
    return sorted({min(n, max(1, int(round(lo * (n / lo) ** (i / (count - 1)))))) for i in range(count)}) if n else []


def topk_overlap(scores: DataFrame, descriptors: list[str], count: int = 40) -> DataFrame:
    """k, mean, p10, p90 of the overlap share of the k best between pairs of descriptors; needs 5 rows and 2 descriptors."""
    placed = numbered(scores, ["descriptor"], "p", "compound_id", descending=True, name="place")
    wide = placed.groupBy("compound_id").pivot("descriptor", descriptors).agg(F.first("place"))
    n = wide.count()
    ks = depths(n, count)
    pairs = [(a, b) for i, a in enumerate(descriptors) for b in descriptors[i + 1 :]]
    if n < 5 or not pairs:
        return wide.sparkSession.createDataFrame([], "k int, mean double, p10 double, p90 double")
    worst = F.array(*(F.struct(F.lit(i).alias("pair"), F.greatest(f"`{a}`", f"`{b}`").alias("d")) for i, (a, b) in enumerate(pairs)))
    need = F.size(F.filter(F.array(*map(F.lit, ks)), lambda k: k < F.col("d")))  # first depth at which both have it
    hist = wide.select(F.inline(worst)).filter(F.col("d").isNotNull()).groupBy("pair", need.alias("i")).agg(F.count("*").alias("c"))
    grid = hist.groupBy("pair").agg(*(F.sum(F.when(F.col("i") <= i, F.col("c")).otherwise(0)).alias(f"s{i}") for i in range(len(ks))))
    long = grid.select("pair", F.inline(F.array(*(F.struct(F.lit(k).alias("k"), (F.col(f"s{i}") / k).alias("share")) for i, k in enumerate(ks)))))
    return long.groupBy("k").agg(F.avg("share").alias("mean"), F.percentile("share", 0.1).alias("p10"), F.percentile("share", 0.9).alias("p90"))


def histogram(df: DataFrame, column: str, by: list[str], *, bins: int, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """by, bin (from 0), n and density over equal bins of [low, high]; the last bin holds its upper end."""
    v = F.col(column).cast("double")
    at = F.least(F.floor((v - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    inside = df.filter((v >= low) & (v <= high) & ~F.isnan(v))
    counts = inside.groupBy(*by, at.alias("bin")).agg(F.count("*").alias("n"))
    total = counts.groupBy(*by).agg(F.sum("n").alias("_t"))
    joined = counts.join(F.broadcast(total), by) if by else counts.join(F.broadcast(total))
    return joined.withColumn("density", F.col("n") / F.col("_t") / ((high - low) / bins)).drop("_t")


def bin_count(n: int, floor: int, cap: int) -> int:
    return max(floor, min(cap, n // 5))


def domain_coverage(pooled: DataFrame, bins: int = 20) -> DataFrame:
    """bin, n, density of the domain fraction; `outside` is the count at or below 0, on every row."""
    outside = pooled.agg(F.count_if(F.col("clf_ad") <= 0).alias("outside"))
    return histogram(pooled, "clf_ad", [], bins=bins).join(F.broadcast(outside))


def rank_distribution(pooled: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(pooled, "clf_rank", [], bins=bins)


def projection_points(projections: DataFrame, data: DataFrame, cap: int = 10_000) -> DataFrame:
    """name, compound_id, x, y, bin of finite, labelled points: at most cap a class and projection, chosen by hash (the cap
    is the feature: a figure's points)."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = projections.join(data.select("compound_id", "bin"), "compound_id").filter(finite("x") & finite("y") & F.col("bin").isNotNull())
    digest = F.md5(F.col("compound_id").cast("string"))
    rows = kept(rows.withColumn("_u", F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")), "points")
    # rows above the cap-th least hash are left out first, so that no task orders more than about cap of a class
    bar = bars(rows, ["name", "bin"], "_u", F.lit(cap)).select(F.col("name").alias("_name"), F.col("bin").alias("_bin"), "bar")
    near = rows.join(F.broadcast(bar), (F.col("name") == F.col("_name")) & (F.col("bin") == F.col("_bin")) & (F.col("_u") <= F.col("bar"))).drop("_name", "_bin", "bar", "_u")
    order = Window.partitionBy("name", "bin").orderBy(digest, "compound_id")
    return near.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= cap).drop("_r")


def class_percent(data: DataFrame) -> DataFrame:
    return data.agg(F.rint(100 * F.avg("bin")).cast("int").alias("active"), (100 - F.rint(100 * F.avg("bin"))).cast("int").alias("inactive"))


def training_reference(scores: DataFrame, data: DataFrame) -> DataFrame:
    """compound_id, clf, bin of training entities with a finite score and a label."""
    v = F.col("clf")
    return scores.join(data.select("compound_id", "bin"), "compound_id").filter(v.isNotNull() & ~F.isnan(v) & F.col("bin").isNotNull()).select("compound_id", "clf", "bin")

