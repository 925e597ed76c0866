"""Exact order statistics, running totals and fixed-size subsets against brute force."""

import math
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions import ordered, selection
from quillon.operators import metrics, subsets

SHARES = [0.0, 0.05, 0.25, 0.5, 0.66, 0.95, 1.0]


def odd_numbers():
    rng = np.random.default_rng(1)
    wide = rng.normal(size=600) * 10.0 ** rng.integers(-300, 300, 600)
    return np.concatenate([wide, np.zeros(300), rng.random(800), [5e-324, -5e-324, 1.7e308, -1.7e308, 1024.0, np.nextafter(8, 0), 8.0]]).tolist()


@pytest.mark.parametrize(("few", "bins"), [(4096, 1024), (5, 64)])
def test_quantiles(spark, few, bins):
    """Groups of any width, null among their names, one value, no value; also with intervals narrowed again and again."""
    rows = [(g, x) for g in (1, None) for x in odd_numbers()] + [(7, 3.0)] * 500 + [(8, float("nan")), (9, None), (10, 2.5)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r["g"]: r for r in selection.quantiles(df, ["g"], "x", SHARES, few=few, bins=bins, ends=True).collect()}
    assert set(got) == {1, None, 7, 10}
    for g, r in got.items():
        own = np.array([x for h, x in rows if h == g and x is not None])
        assert np.allclose(r["q"], np.quantile(own, SHARES), rtol=1e-12, atol=0)
        assert (r["least"], r["greatest"]) == (own.min(), own.max())


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g int, x double")
    assert selection.quantiles(empty, ["g"], "x", SHARES).collect() == [] and selection.quantile(empty, "x", 0.5) is None
    assert selection.bars(empty, ["g"], "x", F.lit(1)).collect() == []


@pytest.mark.parametrize("few", [4096, 3])
def test_weighted_bars(spark, few):
    rows = [(i % 3, float((i * 7919) % 1009), i % 50) for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, x double, w long")
    for wanted, least in ((F.round(0.2 * F.col("_total")), lambda t: math.floor(0.2 * t + 0.5)), (F.lit(0), lambda t: 0), (F.col("_total") + 5, lambda t: t)):
        for r in selection.bars(df, ["g"], "x", wanted, weight="w", few=few, bins=16).collect():
            own = sorted((x, w) for g, x, w in rows if g == r["g"])
            total, seen, best = sum(w for _, w in own), 0, None
            for x, w in own:
                seen += w
                if best is None and seen >= least(total) >= 1:
                    best = x
            assert (r["total"], r["bar"]) == (total, best)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("ranges", [None, 7])
def test_running_totals_split_ties(spark, ranges, descending):
    rows = [(g, 0.0 if i % 10 else float(i % 7), f"id{i:05d}", i % 5) for g in ("a", None) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, x double, id string, v long")
    got = {(r["g"], r["id"]): r["cum_v"] for r in ordered.running(df, ["g"], "x", ["v"], ties="id", descending=descending, ranges=ranges).collect()}
    for g in ("a", None):
        total = 0
        for _, _, i, v in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1] if descending else r[1], r[2])):
            total += v
            assert got[g, i] == total


def test_a_frequent_value_is_dealt_to_many_ranges(spark):
    """Nine tenths of the rows share one value; no range holds more than a few times the median."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 0.0).otherwise(F.col("id").cast("double")).alias("x"), F.col("id").cast("string").alias("t"))
    sizes = sorted(r["count"] for r in ordered.in_ranges(df, [F.col("x").asc(), F.col("t").asc()], 16).groupBy("_range").count().collect())
    assert len(sizes) == 16 and sizes[-1] < 3 * sizes[len(sizes) // 2]


def scored(n=700):
    rng = np.random.default_rng(2)
    out = []
    for g in ("a", "b", None):
        for i in range(n):
            y = int(rng.random() < (0.15 if g == "a" else 0.7))
            out.append((g, f"c{i}", y, float(np.clip(rng.normal(0.35 + 0.3 * y, 0.2), 0, 1))))
    return out


SCORES = "g string, id string, y int, p double"


@pytest.mark.parametrize("size", [0.2, 0.01, 1.0, 150])
def test_subsets_have_their_size(spark, size):
    rows = scored()
    df = spark.createDataFrame(rows, SCORES)
    binned = df.select("g", "id", "y", subsets.binned(df, [0.3, 0.6]).alias("bin"))
    got = subsets.subset_counts(binned, ["g"], "id", subsets=12, size=size).collect()
    n = Counter((g, y) for g, _, y, _ in rows)
    drawn = defaultdict(int)
    for r in got:
        drawn[r["g"], r["y"], r["subset"]] += r["w"]
    for g in ("a", "b", None):
        ones = size * n[g, 1] / 700 if isinstance(size, int) else size * n[g, 1]
        for s in range(12):
            assert drawn[g, 1, s] == math.floor(ones + 0.5)
            assert drawn[g, 0, s] == (size - drawn[g, 1, s] if isinstance(size, int) else math.floor(size * n[g, 0] + 0.5))


def test_subsets_are_the_least_hashes(spark):
    rows = [r for r in scored(300) if r[0] == "a"]
    df = spark.createDataFrame(rows, SCORES).select("id", "y", F.lit(0).alias("bin"), *(h.alias(n) for n, h in zip("uv", subsets.hash_parts(F.col("id"), 42), strict=True)))
    parts = {r["id"]: (r["u"], r["v"], r["y"]) for r in df.collect()}
    marks = spark.createDataFrame([(i, y, int(i[1:]) % 50) for _, i, y, _ in rows], "id string, y int, bin int")
    got = {(r["y"], r["subset"], r["bin"]): r["w"] for r in subsets.subset_counts(marks, [], "id", subsets=9).collect()}
    for s in range(9):
        m, n = subsets.factors(s)
        for y in (0, 1):
            order = sorted((i for i in parts if parts[i][2] == y), key=lambda i: ((parts[i][0] * m + parts[i][1] * n) % subsets.PRIME, *parts[i][:2], i))
            wanted = Counter(int(i[1:]) % 50 for i in order[: math.floor(0.2 * len(order) + 0.5)])
            assert wanted == {b: w for (z, t, b), w in got.items() if z == y and t == s}


def test_draws_with_replacement(spark):
    rows = scored()
    df = spark.createDataFrame(rows, SCORES)
    binned = df.select("g", "id", "y", subsets.binned(df, [0.3, 0.6]).alias("bin"))
    draw = lambda: sorted(map(str, subsets.subset_counts(binned, ["g"], "id", subsets=400, replacement=True).collect()))
    assert draw() == draw()
    got = subsets.subset_counts(binned, ["g"], "id", subsets=400, replacement=True).groupBy("g", "y", "bin").agg(F.sum("w").alias("w")).collect()
    counts = Counter((r["g"], r["y"], r["bin"]) for r in binned.collect())
    n = Counter((g, y) for g, _, y, _ in rows)
    for r in got:
        k = math.floor(0.2 * n[r["g"], r["y"]] + 0.5)
        share = counts[r["g"], r["y"], r["bin"]] / n[r["g"], r["y"]]
        assert abs(r["w"] / 400 - k * share) < 5 * math.sqrt(k * share / 400) + 0.01
    one = subsets.subset_counts(binned, ["g"], "id", subsets=3, replacement=True).groupBy("g", "y", "subset").agg(F.sum("w").alias("w")).collect()
    assert all(r["w"] == math.floor(0.2 * n[r["g"], r["y"]] + 0.5) for r in one) and len(one) == 18


def test_grid_follows_the_prevalence(spark):
    df = spark.createDataFrame(scored(), SCORES)
    got = defaultdict(list)
    for r in metrics.threshold_kappa(df, ["g"], "id", subsets=5).collect():
        got[r["g"]].append(r["threshold"])
    prevalence = defaultdict(list)
    for g, _, y, _ in scored():
        prevalence[g].append(y)
    for g, ts in got.items():
        assert sorted(ts) == metrics.threshold_grid(sum(prevalence[g]) / 700)
    assert metrics.threshold_grid(0.1)[-1] == 0.55 and metrics.threshold_grid(0.72)[-1] == 0.7
    assert all(a < b for a, b in pairwise(metrics.threshold_grid(0.9)))


def test_performance_searches_its_cutoff(spark):
    rows = scored()
    df = spark.createDataFrame(rows, SCORES)
    train, test = df.filter("id < 'c4'"), df.filter("id >= 'c4'")
    got = {r["g"]: r for r in metrics.performance(test.filter("g IS NOT NULL"), ["g"], "id", train=train.filter("g IS NOT NULL")).collect()}
    chosen = {r["g"]: r["cutoff"] for r in metrics.cutoffs(train, ["g"], "id").collect()}
    for g in ("a", "b"):
        side = [r for r in rows if r[0] == g and r[1] < "c4"]
        assert got[g]["cutoff"] == chosen[g] and (got[g]["num_train"], got[g]["num_train_1"]) == (len(side), sum(r[2] for r in side))
        assert got[g]["tp"] == sum(r[2] for r in rows if r[0] == g and r[1] >= "c4" and r[3] >= chosen[g])
    one = metrics.performance(test.filter("g = 'a'"), [], "id", train=train.filter("g = 'a'")).first()
    assert one["cutoff"] == chosen["a"]
