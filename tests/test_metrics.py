import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillon.functions.curves import interpolate
from quillon.functions.ordered import running
from quillon.operators import estimate, metrics, pooling, ranking


def frame(spark, pairs):
    return spark.createDataFrame([(i, float(p), y) for i, (p, y) in enumerate(pairs)], "compound_id long, p double, y int")


def brute_auroc(pairs):
    pos, neg = [p for p, y in pairs if y == 1], [p for p, y in pairs if y == 0]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_running_totals_equal_a_plain_loop(spark):
    rng = random.Random(0)
    rows = [(rng.choice("ab"), rng.choice([0.1, 0.5, 0.5, rng.random()]), i, 1) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x double, id long, one int")
    for down in (False, True):
        got = {r.id: r.cum_one for r in running(df, ["g"], "x", ["one"], ties="id", descending=down).collect()}
        for g in "ab":
            order = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1] if down else r[1], r[2]))
            assert [got[r[2]] for r in order] == list(range(1, len(order) + 1))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([0.0, 0.2, 0.5, 0.7, 1.0]), st.sampled_from([0, 1])), min_size=4, max_size=25))
def test_auroc_with_ties(spark, pairs):
    df = frame(spark, pairs)
    got = metrics.auroc(df, []).first().auroc
    if len({y for _, y in pairs}) < 2:
        assert got is None
    else:
        assert math.isclose(got, brute_auroc(pairs))
        assert math.isclose(metrics.auroc(df.withColumn("p", -F.col("p")), []).first().auroc, 1 - got, abs_tol=1e-12)


def test_point_metrics_and_cutoffs(spark):
    df = frame(spark, [(0.9, 1), (0.5, 0), (0.5, 1), (0.1, 0), (0.7, None)])
    c = metrics.confusion(df, [], 0.5).first()
    assert (c.tp, c.tn, c.fp, c.fn) == (2, 1, 1, 0)
    c = metrics.confusion(df, [], 0.5, inclusive=False).first()
    assert (c.tp, c.tn, c.fp, c.fn) == (1, 2, 0, 1)
    p = metrics.precision_at_k(df, [], "compound_id").first()
    assert p.precision_at_1 == 1.0 and p.precision_at_100 == 0.5
    one = metrics.point_metrics(frame(spark, [(0.9, 1), (0.8, 1)]), [], 0.5).first()
    assert one.mcc == 0.0 and one.recall == 1.0


def test_calibration_edges(spark):
    df = frame(spark, [(e, 1) for e in metrics.CALIBRATION_EDGES] + [(0.3, 0)])
    got = {r.bin: r.n for r in metrics.calibration(df, []).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 2}


def test_interpolation_holds_ends_and_equal_knots(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.25, 0.5, 2.0)], "x double")
    knots = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(e).alias("e")) for r, e in ((0.0, 1.0), (0.5, 2.0), (0.5, 4.0), (1.0, 8.0))))
    assert [r[0] for r in df.select(interpolate(F.col("x"), knots)).collect()] == [1.0, 1.0, 1.5, 4.0, 8.0]


SIGNALS = "descriptor string, oof_auc double, curve array<struct<r:double,e:double>>, ad_cutoff double"
SCORES = "compound_id string, descriptor string, p double, rank_q double, ad double"


def test_weights_sum_to_one_and_pool_stays_between(spark):
    model = pooling.fit_pool(spark.createDataFrame([("a", 0.8, [(0.0, 0.1), (1.0, 0.5)], -1.0), ("b", 0.6, [(0.0, 0.2), (1.0, 0.2)], -1.0), ("c", 0.4, [(0.5, 0.3)], None)], SIGNALS))
    rows = [("x", "a", 0.9, 0.5, 0.0), ("x", "b", 0.2, None, 0.0), ("x", "c", 0.5, 0.1, -9.0), ("y", "a", 0.0, 0.5, -2.0), ("y", "b", 1.0, 0.5, -2.0), ("z", "c", 0.3, 0.2, 0.0)]
    w = pooling.weights(spark.createDataFrame(rows, SCORES), model)
    totals = {r.compound_id: r.t for r in w.groupBy("compound_id").agg(F.sum("w").alias("t")).collect()}
    assert all(math.isclose(t, 1.0) for t in totals.values())
    got = {r.compound_id: r for r in pooling.pool(w).collect()}
    assert 0.2 <= got["x"].clf <= 0.9 and math.isclose(got["z"].clf, 0.3)
    assert got["y"].clf_ad == 0.0 and got["x"].clf_ad == 1.0 and got["z"].clf_ad is None
    vetoed = {(r.compound_id, r.descriptor): r.w for r in w.collect()}
    assert math.isclose(vetoed["y", "a"], 0.3 / 0.4)  # all vetoed: skill alone
    with pytest.raises(ValueError):
        pooling.apply_pool(spark.createDataFrame([("x", "q", 0.5, 0.5, 0.0)], SCORES), model)


def test_error_curve_and_rank_quantiles(spark):
    rows = [(f"{i:02d}", "a", i / 10, int(i > 4), i / 9) for i in range(10)]
    df = spark.createDataFrame(rows, "compound_id string, descriptor string, p double, y int, rank_q double")
    curve = estimate.rank_error_curve(df, ["descriptor"], knots=5).first().curve
    errors = [abs(p - y) for _, _, p, y, _ in rows]
    want = []
    for j in range(5):
        at = round(j * 9 / 4)
        want.append(sum(errors[max(0, at - 1) : at + 2]) / len(errors[max(0, at - 1) : at + 2]))
    assert all(math.isclose(k.e, e) for k, e in zip(curve, want, strict=True))
    assert estimate.rank_error_curve(df.limit(1), ["descriptor"]).first().curve is None
    query = spark.createDataFrame([(0.35,), (0.9,), (-1.0,)], "p double")
    got = {r.p: r.rank_q for r in estimate.rank_quantile(query, df.select("p")).collect()}
    assert got == {0.35: 0.4, 0.9: 1.0, -1.0: 0.0}


def test_overlap_of_equal_rankings_is_whole(spark):
    df = spark.createDataFrame([(i, d, float(i)) for i in range(50) for d in "ab"], "compound_id long, descriptor string, p double")
    assert all(math.isclose(r["mean"], 1.0) for r in ranking.topk_overlap(df, ["a", "b"]).collect())
    assert math.isclose(ranking.spearman_matrix(df, ["a", "b"]).first().rho, 1.0)
