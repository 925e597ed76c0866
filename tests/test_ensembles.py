"""Logistic fits, power transforms, baggers and isotonic calibration against plain Python."""

import math
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.catalog import QUERIES
from quillon.operators import bagging, calibrate, logistic
from quillon.plans import fixtures as fx

BY = ["descriptor"]


def train_rows():
    rng = np.random.default_rng(4)
    out = []
    for i in range(400):
        y = int(rng.random() < 0.4)
        for d, gain in (("a", 1.5), ("b", 0.5), ("c", 0.0)):
            out.append((f"c{i}", d, float(1 / (1 + np.exp(-rng.normal(gain * (y - 0.4), 1)))), y))
    return out


SCHEMA = "compound_id string, descriptor string, p double, y int"


def newton(x, y, penalty=1.0):
    s, b = 0.0, 0.0
    for _ in range(200):
        q = 1 / (1 + np.exp(-(s * x + b)))
        w = q * (1 - q)
        g = np.array([np.sum((y - q) * x) - penalty * s, np.sum(y - q)])
        h = np.array([[np.sum(w * x * x) + penalty, np.sum(w * x)], [np.sum(w * x), np.sum(w)]])
        ds, db = np.linalg.solve(h, g)
        s, b = s + ds, b + db
    return s, b


def test_lines_equal_a_plain_fit(spark):
    rows = train_rows() + [("z", None, 0.1 * i, i % 2) for i in range(9)] + [("z", "one", 0.5, 1), ("z", "none", None, 1)]
    # classes that a threshold parts: the penalty keeps the slope finite
    rows += [("z", "parted", i / 10, int(i > 4)) for i in range(10)] + [("z", "far", 1000.0 * (i - 5), int(i > 4)) for i in range(10)]
    got = {r["descriptor"]: (r["slope"], r["intercept"]) for r in logistic.fit_lines(spark.createDataFrame(rows, SCHEMA), BY, "p", "y").collect()}
    assert set(got) == {"a", "b", "c", None, "one", "parted", "far"} and got["one"] == (0.0, 16.0)
    for d in ("a", "b", "c", None, "parted"):
        x = np.array([p for _, e, p, _ in rows if e == d])
        y = np.array([z for _, e, _, z in rows if e == d])
        assert np.allclose(got[d], newton(x, y), atol=1e-7)
    s, b = got["far"]
    assert s > 0 and all((s * 1000 * (i - 5) + b > 0) == (i > 4) for i in range(10))
    assert logistic.fit_lines(spark.createDataFrame([], SCHEMA), BY, "p", "y").collect() == []


def yeo_johnson(x, lam):
    if x >= 0:
        return math.log1p(x) if abs(lam) < 1e-9 else ((1 + x) ** lam - 1) / lam
    return -math.log1p(-x) if abs(lam - 2) < 1e-9 else -((1 - x) ** (2 - lam) - 1) / (2 - lam)


def test_powers_equal_a_plain_fit(spark):
    rng = np.random.default_rng(5)
    rows = [("x", g, float(v), 0) for g, many in (("skewed", rng.lognormal(0, 1, 200)), ("both", rng.normal(0, 2, 200)), (None, rng.random(50))) for v in many] + [("x", "flat", 2.0, 0)] * 5
    got = {r["descriptor"]: r for r in bagging.fit_powers(spark.createDataFrame(rows, SCHEMA), BY, "p").collect()}
    for g in ("skewed", "both", None):
        x = [p for _, e, p, _ in rows if e == g]
        logs = sum(math.copysign(1, v) * math.log1p(abs(v)) for v in x)

        def likelihood(lam, x=x, logs=logs):
            t = [yeo_johnson(v, lam) for v in x]
            return round(-0.5 * len(x) * math.log(max(statistics.pvariance(t), 1e-300)) + (lam - 1) * logs, 6)

        best = max(bagging.LAMBDAS, key=lambda lam: (likelihood(lam), lam))
        t = [yeo_johnson(v, best) for v in x]
        assert got[g]["lambda"] == best and math.isclose(got[g]["mean"], statistics.fmean(t), rel_tol=1e-9) and math.isclose(got[g]["std"], statistics.pstdev(t), rel_tol=1e-9)
    assert got["flat"]["std"] == 1.0


def test_bag_modes(spark):
    rows = train_rows()
    train = spark.createDataFrame(rows, SCHEMA)
    new = spark.createDataFrame([("n1", "a", 0.9, 0), ("n1", "b", 0.8, 0), ("n1", "c", 0.2, 0), ("n2", "a", 0.1, 0), ("n2", "unknown", 0.9, 0)], SCHEMA).drop("y")
    lines = {d: newton(np.array([p for _, e, p, _ in rows if e == d]), np.array([y for _, e, _, y in rows if e == d])) for d in "abc"}
    call = lambda d, p: 1 / (1 + math.exp(-(lines[d][0] * p + lines[d][1])))
    model = {r["compound_id"]: r["clf"] for r in bagging.apply_bag(new, bagging.fit_bag(train, "model")).collect()}
    assert math.isclose(model["n1"], statistics.median([call("a", 0.9), call("b", 0.8), call("c", 0.2)]), abs_tol=1e-8)
    assert math.isclose(model["n2"], call("a", 0.1), abs_tol=1e-8)
    median = {r["compound_id"]: r["clf"] for r in bagging.apply_bag(new, bagging.Bag("median")).collect()}
    assert median == {"n1": 0.8, "n2": 0.5}
    bag = bagging.fit_bag(train, "weighting")
    assert len(bag.schemes) == 2 and math.isclose(sum(bag.schemes[1].values()), 1.0) and max(bag.schemes[1], key=bag.schemes[1].get) == "a"
    both = {r["compound_id"]: r for r in bagging.apply_bag(new, bag).collect()}
    assert both["n1"]["clf"] > 0.4 > both["n2"]["clf"] and both["n2"]["clf_bin"] == 0
    zero = bagging.Bag("weighting", powers=bag.powers, lines=bag.lines, schemes=[{"a": 0.0, "b": 0.0, "c": 0.0}])
    plain = bagging.Bag("weighting", powers=bag.powers, lines=bag.lines, schemes=[])
    same = lambda b: {r["compound_id"]: round(r["clf"], 9) for r in bagging.apply_bag(new, b).collect()}
    assert same(zero) == same(plain)
    with pytest.raises(ValueError, match="modes"):
        bagging.fit_bag(train, "scaling")


def test_regression_bags(spark):
    rows = [(f"c{i}", d, i * k + 1.0, 2 * i) for i in range(20) for d, k in (("a", 1.0), ("b", -0.5))]
    train = spark.createDataFrame(rows, SCHEMA)
    got = {r["compound_id"]: r["reg"] for r in bagging.apply_bag(train.drop("y"), bagging.fit_bag(train, "model", "regression")).collect()}
    assert all(math.isclose(got[f"c{i}"], 2 * i, abs_tol=1e-9) for i in range(20))
    scaled = bagging.apply_bag(train.drop("y"), bagging.fit_bag(train, "scaling", "regression"))
    assert scaled.columns == ["compound_id", "reg"] and scaled.count() == 20


def isotonic(points):
    """Rates by the definition: for each score the greatest, over starts, of the least rate over ends."""
    points = sorted(points)
    out = {}
    for i, (p, _, _) in enumerate(points):
        best = -1.0
        for j in range(i + 1):
            n = n1 = 0
            worst = 2.0
            for k in range(j, len(points)):
                n, n1 = n + points[k][1], n1 + points[k][2]
                if k >= i:
                    worst = min(worst, n1 / n)
            best = max(best, worst)
        out[p] = best
    return out


@pytest.mark.parametrize("ranges", [1, 40])
def test_isotonic(spark, ranges):
    """Pooling in ranges and then over their blocks equals the definition, for any number of ranges."""
    rng = np.random.default_rng(6)
    points = {g: [(round(float(p), 6), int(n), int(rng.binomial(n, min(1, max(0, p + rng.normal(0, 0.2)))))) for p, n in zip(rng.random(60), rng.integers(1, 9, 60), strict=True)] for g in ("a", None)}
    counts = spark.createDataFrame([(g, *p) for g, ps in points.items() for p in ps], "descriptor string, p double, n long, n1 long")
    got = calibrate.isotonic_blocks(counts, BY, ranges=ranges).collect()
    for g, ps in points.items():
        wanted = isotonic(ps)
        blocks = sorted((r["lo"], r["hi"], r["rate"]) for r in got if r["descriptor"] == g)
        assert all(a[2] < b[2] and a[1] < b[0] for a, b in zip(blocks, blocks[1:], strict=False))
        for p, rate in wanted.items():
            assert any(lo <= p <= hi and math.isclose(v, rate, abs_tol=1e-12) for lo, hi, v in blocks)


def test_calibrated_values(spark):
    knots = {("a",): (np.array([0.2, 0.4, 0.6, 0.6]), np.array([0.1, 0.1, 0.9, 0.9]))}
    df = spark.createDataFrame([("a", 0.1), ("a", 0.5), ("a", 0.9), ("a", None), ("b", 0.5)], "descriptor string, p_raw double")
    got = [r["p"] for r in calibrate.calibrated(df, knots, BY).collect()]
    assert np.allclose(got[:3], [0.1, 0.5, 0.9]) and got[3:] == [None, None]


def test_calibration_leaves_the_own_fold_out(spark):
    """A label changed in one fold changes no value of that fold."""
    rng = np.random.default_rng(7)
    rows = [(i, float(rng.random()), i % 2, i % 3) for i in range(120)]
    flipped = [(i, p, 1 - y if f == 1 else y, f) for i, p, y, f in rows]
    run = lambda data: {r["i"]: r["p"] for r in calibrate.cross_calibrated(spark.createDataFrame(data, "i int, p_raw double, y int, f int"), "f").collect()}
    a, b = run(rows), run(flipped)
    assert all(a[i] == b[i] for i, _, _, f in rows if f == 1) and any(a[i] != b[i] for i, _, _, f in rows if f != 1)
    whole = calibrate.fit_isotonic(spark.createDataFrame(rows, "i int, p_raw double, y int, f int"), [])
    assert whole.agg(F.sum("n")).first()[0] == 120


def test_scores_of_odd_texts(spark, sf_dir):
    """Blanks and digits are those of ASCII, whatever the other characters' length; null counts as empty."""
    docs = [(1, "a 1 b 22", 8), (2, "\u00e9 \u20ac\u00a0\u0664 7\U0001f600 ", 8), (3, None, 0), (4, None, 5), (5, "", 0), (6, "  9", 1)]
    got = {(r["compound_id"], r["descriptor"]): r["p"] for r in fx.scores(spark, sf_dir, spark.createDataFrame(docs, "doc_id long, text string, n_chars long")).collect()}
    share = lambda n, c: min(1.0, n / c) if c else 0.0
    for i, t, c in docs:
        assert got[i, "space"] == share((t or "").count(" "), c) and got[i, "digit"] == share(len(re.findall("[0-9]", t or "")), c)
        assert math.isclose(got[i, "len"], 1 / (1 + math.exp(-(math.log(c + 1) - 7))))


@pytest.mark.parametrize("name", ["bag_forest", "bag_weighting", "bag_model", "bag_reg_model", "bag_scaling"])
def test_bags_read_texts_once(spark, sf_dir, monkeypatch, name):
    reads = []
    read = fx.read
    monkeypatch.setattr(fx, "read", lambda s, d, table: reads.append(table) or read(s, d, table))
    assert QUERIES[name](spark, sf_dir).count() == read(spark, sf_dir, "documents").count()
    assert reads.count("documents") == 1


def test_labels_meet_no_texts(spark, sf_dir, capsys):
    """Labels that are too many for a broadcast join counts of texts: no exchange holds a text."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        capsys.readouterr()
        fx.labelled(spark, sf_dir).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffled = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert len(shuffled) >= 2 and not any("text#" in s for s in shuffled)


def test_powers_of_a_bag_are_stored(spark):
    """Applying a bag does not fit its powers again."""
    bag = bagging.fit_bag(spark.createDataFrame(train_rows(), SCHEMA), "weighting", schemes=[])
    assert bag.powers.inputFiles() and bag.powers.count() == 3


def test_forest_repeats_however_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(bagging, "FOREST_ROWS", 150, raising=False)
    train = spark.createDataFrame(train_rows(), SCHEMA)
    names = ["spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(n) for n in names]
    got = []
    try:
        for n in (2, 5):
            for name, value in zip(names, ("false", str(n)), strict=True):
                spark.conf.set(name, value)
            got.append(bagging.forest_weights(train.repartition(n + 1, "p")))
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert got[0] == got[1] and max(got[0], key=got[0].get) == "a"
