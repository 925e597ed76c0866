import random

import pytest
from pyspark.sql import functions as F

from quillon.functions.hot import join_by_key
from quillon.functions.text import hashed_ngrams
from quillon.operators import features, scaling, screen, splits, telemetry
from quillon.plans import jobs


def test_batches_are_halved_until_the_bad_row(spark):
    def fn(values):
        if any(v == "bad" for v in values):
            raise ValueError
        return [[len(v), 1.0] for v in values]

    df = spark.createDataFrame([(v,) for v in ["a", "bb", "bad", "cccc", None]], "smiles string")
    got = {r.input: r.features for r in features.featurize(df, fn, width=2, descriptor="d", version="v1", batch=4).collect()}
    assert got == {"a": [1.0, 1.0], "bb": [2.0, 1.0], "bad": None, "cccc": [4.0, 1.0]}
    all_bad = features.featurize(df.filter("smiles = 'bad'"), fn, width=2, descriptor="d", version="v1")
    with pytest.raises(features.FeatureError):
        features.assert_any_ok(all_bad)
    rescued = features.featurize(df.filter("smiles = 'bad'"), fn, width=2, descriptor="d", version="v1", fallback=lambda v: [[0, 0]] * len(v))
    assert rescued.first().features == [0.0, 0.0]


def test_read_through_equals_computing_all(spark, tmp_path):
    def compute(df):
        return features.featurize(df, lambda v: [[len(x)] for x in v], width=1, descriptor="d", version="v1")

    df = spark.createDataFrame([("a",), ("bb",), ("ccc",), ("a",)], "smiles string")
    store = compute(df.limit(2)).select("key", "input", "features")
    got, new = features.read_through(df, store, compute)
    assert sorted((r.smiles, r.features[0]) for r in got.collect()) == [("a", 1.0), ("a", 1.0), ("bb", 2.0), ("ccc", 3.0)]
    assert features.contribute(new, str(tmp_path / "s")) == 1
    empty = store.limit(0)
    assert features.read_through(df, empty, compute)[0].filter("features is null").count() == 0


def test_versions(spark):
    tags = spark.createDataFrame([("a", "v1.0.0", "2020", "x"), ("a", "v2.1.0", "2021", "y"), ("a", "v3.0.0", "2022", "z"), ("a", "latest", "2021", "y")], "descriptor string, tag string, last_updated string, digest string")
    local = spark.createDataFrame([("a", "y"), ("b", "q")], "descriptor string, digest string")
    assert {r.descriptor: r.version for r in features.version_as_of(tags, local).collect()} == {"a": "v2", "b": "v1"}
    wanted = spark.createDataFrame([("a", "v9")], "descriptor string, version string")
    store = spark.createDataFrame([("a", "v1")], "descriptor string, version string")
    with pytest.raises(features.FeatureError):
        features.check_versions(wanted, store)


def test_scaling_fills_and_keeps_constants_at_zero(spark):
    ref = spark.createDataFrame([([float(i), 5.0],) for i in range(5)], "features array<double>")
    t = scaling.fit_transformer(ref)
    df = spark.createDataFrame([([4.0, 7.0],), ([float("nan"), None],)], "features array<double>")
    assert [r.features for r in scaling.apply_transformer(df, t).collect()] == [[1.0, 0.0], [0.0, 0.0]]
    with pytest.raises(ValueError):
        scaling.validate_transformer(t, ["f0"])


def entities(spark, n=200):
    return spark.createDataFrame([(f"c{i}", i, i % 3 == 0, f"g{i % 23}") for i in range(n)], "compound_id string, orig_idx long, b boolean, group string").select("compound_id", "orig_idx", F.col("b").cast("int").alias("bin"), "group")


def test_no_group_is_on_both_sides(spark):
    df = entities(spark)
    for sides in (splits.assign_groups(df, 3), splits.split_deterministic(df)):
        rows = df.join(sides, "group")
        assert rows.groupBy("group").agg(F.count_distinct("is_test").alias("k")).filter("k > 1").count() == 0
        assert 0 < rows.filter("is_test").count() < df.count()
    one = splits.split_random(df, 1)
    assert {r.bin: r.t for r in one.groupBy("bin").agg(F.count_if("is_test").alias("t")).collect()} == {0: 27, 1: 13}


def test_greedy_split_continues_after_overflow(spark):
    df = spark.createDataFrame([(i, g) for i, g in enumerate("aaaaabbbbcccd")], "orig_idx long, group string")
    got = {r.group: r.is_test for r in splits.split_deterministic(df, 0.4).collect()}
    assert got == {"a": False, "b": True, "c": True, "d": False} or got == {"a": False, "b": True, "c": True, "d": False}


def test_fold_choice(spark):
    member, meta = splits.select_folds(entities(spark), "random", 3, pool=8)
    assert [m["fold"] for m in meta] == ["random_00", "random_01", "random_02"]
    assert member.count() == 600 and splits.both_classes(member).filter("ok").count() == 3
    grouped, meta = splits.select_folds(entities(spark), "scaffold", 2, pool=5)
    assert len(meta) == 2 and grouped.count() == 400


def test_butina_equals_the_sequential_rule(spark):
    words = ["carbon ring", "carbon rings", "carbon ringed", "nitro group", "nitro groups", "alone", "", "carbon ring x"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "compound_id long, s string").select("compound_id", hashed_ngrams(F.col("s")).alias("bits"))
    sets = {r.compound_id: set(r.bits) for r in df.collect()}
    near = {i: [j for j in sets if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.4] for i in sets}
    want = {}
    for i in sorted(sets, key=lambda i: (-len(near[i]), -i)):
        if i not in want:
            want[i] = i
            for j in near[i]:
                want.setdefault(j, i)
    assert {r.id: r.group for r in splits.groups_butina(df).collect()} == want


def test_selection_never_is_empty(spark):
    rows = [("f", i, d, i % 2, (i % 2 if d == "good" else 0.5)) for i in range(20) for d in ("good", "flat")]
    preds = spark.createDataFrame([(f, str(i), d, y, float(p)) for f, i, d, y, p in rows], "fold string, compound_id string, descriptor string, y int, p double")
    assert screen.select_descriptors(preds, ["good", "flat", "missing"])[0] == ["good"]
    assert screen.select_descriptors(preds, ["flat", "missing"])[0][0] in ("flat", "missing")


def test_step_durations(spark):
    log = spark.createDataFrame([("r", "a", 1.0), ("r", "b", 4.0), ("r", "a", 2.0), ("r", "finish", 9.0)], "run string, name string, t double")
    assert {r.name: r.seconds for r in telemetry.step_durations(log).collect()} == {"a": 1.0, "b": 2.0}
    status = spark.createDataFrame([("done", 10.0), ("done", 20.0), ("queued", 0.0), ("running", 5.0)], "state string, elapsed double")
    assert telemetry.eta(status).first().seconds == 25.0


def test_candidates_are_the_single_splits(spark):
    """Bit s of a unit's sides is what split_random or assign_groups says for seed s."""
    df = entities(spark).withColumn("group", F.when(F.col("orig_idx") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("orig_idx") % 40).cast("string"))))
    rows = splits.candidates(df, "random", 4).collect()
    for s in range(4):
        wanted = {r["compound_id"]: r["is_test"] for r in splits.split_random(df, s).collect()}
        assert {r["compound_id"]: bool(r["sides"] >> s & 1) for r in rows} == wanted
    groups = splits.candidates(df, "scaffold", 4).collect()
    for s in range(4):
        wanted = {r["group"]: r["is_test"] for r in splits.assign_groups(df, s).collect()}
        assert {r["group"]: bool(r["sides"] >> s & 1) for r in groups} == wanted
    with pytest.raises(ValueError, match="candidates"):
        splits.candidates(df, "random", 63)


def test_the_menu_has_all_strategies_in_order(spark):
    df = entities(spark).withColumn("group", (F.col("orig_idx") % 11).cast("string"))
    clusters = df.select("compound_id", (F.col("orig_idx") % 17).cast("string").alias("group"))
    member, meta = splits.build_folds(df, 2, groups={"butina": clusters}, pool=6)
    assert [m["fold"] for m in meta] == ["random_00", "random_01", "scaffold_00", "scaffold_01", "deterministic_00", "butina_00", "butina_01"]
    n = df.count()
    assert {r["fold"]: r["count"] for r in member.groupBy("fold").count().collect()} == {m["fold"]: n for m in meta}
    one_side = member.join(clusters, "compound_id").filter("fold LIKE 'butina%'").groupBy("fold", "group").agg(F.count_distinct("is_test").alias("k"))
    assert {r["k"] for r in one_side.collect()} == {1}
    only, none = splits.build_folds(df.withColumn("bin", F.lit(1)), 2, ("random",), pool=3)
    assert only.count() == 0 and none == []


def test_join_by_key(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i // 2}", i) for i in range(40)] + [(None, 1), ("absent", 2)], "k string, v int")
    table = rows.filter("k <> 'absent'").groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    got = join_by_key(rows, table, "k", "n")
    assert got.count() == 540 and {r["m"] for r in got.filter("k = 'hot'").collect()} == {499} and got.columns == ["k", "v", "m"]


@pytest.mark.parametrize("cutoff", [0.6, 0.3, 0.0])
def test_similar_pairs_equal_all_pairs(spark, cutoff):
    """Random sets of many sizes; the pairs that are compared are far fewer than those that share a member."""
    rng = random.Random(3)
    sets = {}
    for i in range(150):
        sets[i] = set(rng.sample(range(60), rng.randint(1, 20)))
    for i in range(150, 220):
        near = set(sets[rng.randrange(150)])
        near.discard(next(iter(near)))
        sets[i] = near | {rng.randrange(60)}
    sets[220] = sets[3]
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()] + [(900, []), (901, None)], "compound_id long, bits array<long>")
    latest = {frozenset(s): max(i for i, z in sets.items() if z == s) for s in sets.values()}
    reps = sorted(latest.values())
    like = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    wanted = {(i, j) for i in reps for j in reps if i < j and like(i, j) >= 1 - cutoff - 1e-9}
    assert {(r["a"], r["b"]) for r in splits.similar_pairs(df, cutoff).collect()} == wanted
    classes = spark.createDataFrame([(i, sorted(sets[i])) for i in reps], "id long, set array<long>")
    sharing = sum(1 for i in reps for j in reps if i < j and sets[i] & sets[j])
    compared = splits.candidate_pairs(classes, 1 - cutoff).count()
    assert len(wanted) <= compared < {0.6: 0.6, 0.3: 0.15, 0.0: 0.02}[cutoff] * sharing


def test_predict_computes_a_descriptor_once_a_row(spark):
    """Score and domain come from one pass over the features: a descriptor function sees each new entity once."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def counted(text):
        calls.add(1)
        return [float(len(text)), float(text.count("b"))]

    texts = [("a" * (i % 7 + 1)) + "b" * (i % 5 + i % 2 * 3) + str(i) for i in range(60)]
    df = spark.createDataFrame([(i, t, float(i % 2)) for i, t in enumerate(texts)], "orig_idx long, s string, v double")
    s = jobs.Settings(is_valid=lambda c: F.length(c) > 0, min_class=None)
    d = [jobs.Descriptor("counts", counted)]
    run = jobs.fit(df, "s", "v", d, s)
    calls.value = 0
    out = jobs.predict(df.drop("v"), "s", None, d, run, s).tables["scores"]
    assert out.count() == 60 and out.filter("ad IS NULL OR p_raw IS NULL").count() == 0 and calls.value == 60
