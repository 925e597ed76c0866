"""Calibration of scores by isotonic regression: pool adjacent violators, in ranges and then over their blocks.

Rows are first counted by score. The counts are dealt to sort ranges; each range is pooled by itself to blocks of rising
rates, and neighbouring ranges are pooled together, sixteen at a time, until a group is one range. Pooling blocks gives the
same as pooling their rows, so the result is that of one pass over all scores in order, while no task holds a group's scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.ordered import RANGE_ROWS, RANGES, in_ranges
from quillon.functions.shared import kept

#: Ranges that are pooled together at a time.
TOGETHER = 16


def pool_blocks(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, n1: np.ndarray) -> list[list[float]]:
    """Blocks [lo, hi, n, n1] of strictly rising rates n1 / n, from blocks in order of score."""
    out: list[list[float]] = []
    for block in zip(lo.tolist(), hi.tolist(), n.tolist(), n1.tolist(), strict=True):
        new = list(block)
        while out and out[-1][3] * new[2] >= new[3] * out[-1][2]:  # rates compared without a division
            last = out.pop()
            new = [last[0], new[1], last[2] + new[2], last[3] + new[3]]
        out.append(new)
    return out


def isotonic_blocks(counts: DataFrame, by: list[str], *, ranges: int | None = None) -> DataFrame:
    """by, lo, hi, n, n1, rate from counts (by, p, n, n1), one row a score: the blocks of an isotonic fit of the labels."""
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    rows = kept(counts.select(group.alias("_g"), F.col("p").cast("double").alias("lo"), F.col("p").cast("double").alias("hi"), "n", "n1"), "counts")
    ranges = ranges or max(1, min(RANGES, -(-rows.count() // RANGE_ROWS)))
    level = in_ranges(rows, [F.col("_g").asc(), F.col("lo").asc()], ranges) if ranges > 1 else rows.withColumn("_range", F.lit(0))
    names = level.select(F.to_json("_g").alias("_name"), "_g").distinct()
    level = level.select(F.to_json("_g").alias("_name"), "lo", "hi", "n", "n1", "_range")

    def pooled(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("lo")
        blocks = pool_blocks(*(part[c].to_numpy() for c in ("lo", "hi", "n", "n1")))
        out = pd.DataFrame(blocks, columns=["lo", "hi", "n", "n1"])
        return out.assign(_name=part["_name"].iloc[0], _range=part["_range"].iloc[0])[["_name", "lo", "hi", "n", "n1", "_range"]]

    while True:
        level = kept(level.groupBy("_name", "_range").applyInPandas(pooled, "_name string, lo double, hi double, n long, n1 long, _range int"), "blocks")
        if ranges == 1:
            break
        ranges = -(-ranges // TOGETHER)
        level = level.withColumn("_range", F.floor(F.col("_range") / TOGETHER).cast("int"))
    out = level.join(F.broadcast(names), "_name")
    return out.select(*(F.col("_g")[b].alias(b) for b in by), "lo", "hi", "n", "n1", (F.col("n1") / F.col("n")).alias("rate"))


def fit_isotonic(df: DataFrame, by: list[str], score: str = "p_raw", y: str = "y") -> DataFrame:
    """The blocks of (by, score, y); rows without either are left out."""
    s = F.col(score).cast("double")
    usable = df.filter(s.isNotNull() & ~F.isnan(s) & F.col(y).isNotNull())
    counts = usable.groupBy(*by, s.alias("p")).agg(F.count("*").alias("n"), F.sum(F.col(y).cast("long")).alias("n1"))
    return isotonic_blocks(counts, by)


def knots_of(blocks: DataFrame, by: list[str]) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
    """Scores and rates of each group's blocks, both ends of each: a few numbers a block, for broadcast."""
    got: dict[tuple, list] = {}
    for r in blocks.collect():
        got.setdefault(tuple(r[b] for b in by), []).append((r["lo"], r["hi"], r["rate"]))
    out = {}
    for g, rows in got.items():
        rows.sort()
        out[g] = np.array([x for lo, hi, _ in rows for x in (lo, hi)]), np.array([v for *_, v in rows for _ in (0, 1)])
    return out


def calibrated(df: DataFrame, knots: dict[tuple, tuple[np.ndarray, np.ndarray]], by: list[str], score: str = "p_raw", name: str = "p") -> DataFrame:
    """df with `name`: the score by its group's knots, linear between them and held beyond; null where either lacks."""
    shared = df.sparkSession.sparkContext.broadcast(knots)

    @F.pandas_udf("double")
    def value(rows: pd.DataFrame) -> pd.Series:
        out = np.full(len(rows), np.nan)
        x = rows["_score"].to_numpy(dtype=float)
        keys = [tuple(None if pd.isna(v) else v for v in key) for key in zip(*(rows[b] for b in by), strict=True)] if by else [()] * len(rows)
        where: dict[tuple, list[int]] = {}
        for i, key in enumerate(keys):
            where.setdefault(key, []).append(i)
        for key, at in where.items():
            if key in shared.value:
                out[at] = np.interp(x[at], *shared.value[key])
        return pd.Series(out)

    got = value(F.struct(*by, F.col(score).cast("double").alias("_score")))
    return df.withColumn(name, F.nanvl(got, F.lit(None).cast("double")))


def cross_calibrated(oof: DataFrame, fold: str, by: list[str] | None = None, score: str = "p_raw") -> DataFrame:
    """oof (by, score, y, fold) with p: each fold's scores by the blocks of all other folds, so no row's own label is in its
    value. Scores are counted by fold once; a count goes to the fit of every other fold."""
    by = by or []
    s = F.col(score).cast("double")
    usable = oof.filter(s.isNotNull() & ~F.isnan(s) & F.col("y").isNotNull())
    counts = kept(usable.groupBy(*by, fold, s.alias("p")).agg(F.count("*").alias("n"), F.sum(F.col("y").cast("long")).alias("n1")), "counts")
    folds = F.broadcast(counts.select(F.col(fold).alias("_without")).distinct())
    others = counts.join(folds, F.col("_without") != F.col(fold)).groupBy(*by, "_without", "p").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    knots = knots_of(isotonic_blocks(others.withColumnRenamed("_without", fold), [*by, fold]), [*by, fold])
    return calibrated(oof, knots, [*by, fold], score)
