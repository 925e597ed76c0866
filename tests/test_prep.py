import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillon.functions import text as tx
from quillon.operators import prep
from quillon.sources import tables


def values(spark, rows):
    return spark.createDataFrame(rows, "compound_id string, value double")


def test_ids_follow_first_appearance_whatever_the_row_order(spark):
    rows = [(k, s) for k, s in enumerate(["b", "a", "b", None, "c"] + [f"x{i}" for i in range(8)])]
    want = None
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "orig_idx long, s string").repartition(3)
        got = {r.s: r.compound_id for r in prep.assign_ids(df, "s").collect()}
        want = want or got
        assert got == want and got["b"] == "CID00" and got["a"] == "CID01" and got["c"] == "CID02" and None not in got


def test_mapping_keeps_every_row(spark):
    df = spark.createDataFrame([(0, "ok", 1.0), (1, "", 1.0), (2, "ok", 0.0), (3, None, None)], "orig_idx long, s string, v double")
    rows = prep.validate(prep.normalize(df, "s", "v"), lambda c: c != "")
    mapping, entities = prep.dedupe(rows)
    got = {r.orig_idx: r.uniq_idx for r in mapping.collect()}
    assert got == {0: 0, 1: None, 2: 0, 3: None} and entities.count() == 1


def test_ids_are_given_without_writing_texts(spark):
    texts = [random.Random(i).randbytes(20_000).hex() for i in range(40)]
    df = spark.createDataFrame([(i, t, "v") for i, t in enumerate(texts)], "orig_idx long, s string, v string")
    top = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(top.iterdir())
    mapping, entities = prep.dedupe(prep.normalize(prep.validate(df, lambda c: c != "", "s"), "s", "v", more=["valid"]), ("value",))
    assert mapping.count() == entities.count() == prep.assign_ids(df, "s").count() == 40
    assert sum(f.stat().st_size for d in set(top.iterdir()) - before for f in d.iterdir()) < 200_000


def test_entities_are_first_rows(spark):
    rows = [(5, "b", "x"), (2, "b", "y"), (2, "b", "y"), (7, "a", "z"), (None, "c", "w"), (9, None, "q"), (1, "", "u")]
    df = spark.createDataFrame(rows, "orig_idx long, s string, v string")
    mapping, entities = prep.dedupe(prep.normalize(prep.validate(df, lambda c: c != "", "s"), "s", "v", more=["valid"]), ("smiles", "value"))
    got = {r.smiles: (r.value, r.compound_id) for r in entities.collect()}
    assert {s: v for s, (v, _) in got.items()} == {"b": "y", "a": "z", "c": "w"} and len(mapping.collect()) == len(rows)
    assert {r.s: r.compound_id for r in prep.assign_ids(df, "s").collect() if r.s} == {s: i for s, (_, i) in got.items()}


def test_labels_reconcile_by_median(spark):
    df = values(spark, [("a", 0.0), ("a", 1.0), ("b", 0.0), ("b", 0.0), ("b", 1.0), ("c", None)])
    assert {r.compound_id: r.value for r in prep.reconcile_labels(df).collect()} == {"a": 1.0, "b": 0.0}
    assert {r.compound_id: r.value for r in prep.reconcile_labels(df, null_label="negative").collect()} == {"a": 1.0, "b": 0.0, "c": 0.0}
    assert {r.compound_id: r.value for r in prep.reconcile_labels(df, "regression").collect()} == {"a": 0.5, "b": 0.0}


def test_binarize_guards(spark):
    good = values(spark, [("a", 0.0), ("b", 0.5), ("c", 1.0)])
    assert {r.compound_id: r.bin for r in prep.binarize(good, min_class=1).collect()} == {"a": 0, "b": 1, "c": 1}
    with pytest.raises(prep.LabelError):
        prep.binarize(good)
    bad = values(spark, [("a", 7.2)])
    with pytest.raises(prep.LabelError):
        prep.binarize(bad, min_class=None)
    assert prep.binarize(bad, strict=False) is None


def test_lexical_structures(spark):
    good = ["C", "CC(=O)O", "c1ccccc1", "[Na+].[Cl-]", "C%12CC%12", " CC ", "C C"]
    bad = ["", None, "C(", "C)C(", "C1CC", "C()", "[[C]]", "C\tC", "C  C", "C!", "[C", "C12C1"]
    df = spark.createDataFrame([(s,) for s in good + bad], "s string")
    got = {r.s: r.ok for r in df.select("s", tx.is_lexical_structure(F.col("s")).alias("ok")).collect()}
    assert all(got[s] for s in good) and not any(got[s] for s in bad)


def test_transforms_invert(spark):
    df = spark.createDataFrame([(float(x),) for x in (-3, -1, 0, 0.5, 2, 9, 30)], "x double")
    power, knots = prep.fit_power(df, "x"), prep.fit_quantiles(df, "x", 7)
    out = df.select("x", prep.inverse_power(prep.apply_power(F.col("x"), power), power).alias("a"), prep.inverse_quantiles(prep.apply_quantiles(F.col("x"), knots), knots).alias("b")).collect()
    assert all(abs(r.x - r.a) < 1e-6 and abs(r.x - r.b) < 1e-6 for r in out)


def test_variants_search_the_knots_once(spark):
    df = spark.createDataFrame([(x,) for x in (None, float("nan"), -1.0, 0.0, 0.5, 3.0, 4.0, 9.0)], "x double")
    out = prep.label_variants(df, "x", {"lambda": 1.0, "mean": 0.0, "std": 1.0}, [0.0, 1.0, 4.0])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("filter([") == 1
    got = [r.uniform for r in out.collect()]
    assert got[0] is None and got[1:] == [1.0, 0.0, 0.0, 0.25, 0.5 + 1 / 3, 1.0, 1.0]


def test_power_counts_values_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(i):
        calls.add(1)
        return float(i % 5) / 2

    x = [(i % 5) / 2 for i in range(100)]
    got = prep.fit_power(spark.range(100).select(counted("id").alias("x")), "x", 41)
    assert calls.value <= 200  # the filter and the group may each call it

    def fit(lam):
        t = [math.log1p(v) if abs(lam) < 1e-9 else ((1 + v) ** lam - 1) / lam for v in x]
        m = sum(t) / len(t)
        return m, sum((u - m) ** 2 for u in t) / len(t)

    lams = [round(-4 + 8 * i / 40, 6) for i in range(41)]
    best = max(lams, key=lambda lam: -50 * math.log(fit(lam)[1]) + (lam - 1) * sum(map(math.log1p, x)))
    mean, var = fit(best)
    assert got["lambda"] == best and abs(got["mean"] - mean) < 1e-9 and abs(got["std"] - var**0.5) < 1e-9


def test_repeats_are_spread(spark):
    df = spark.createDataFrame([(str(i), 5.0 if i < 10 else float(i), float(i)) for i in range(20)], "id string, v double, rank double")
    out = {r.id: r.smoothed for r in prep.smooth_repeats(df, "v", "rank", "id").collect()}
    hot = [out[str(i)] for i in range(10)]
    assert hot == sorted(hot) and len(set(hot)) == 10 and all(out[str(i)] == i for i in range(10, 20))


def test_small_text_functions(spark):
    df = spark.createDataFrame([("A__b", 45.0, 2048.0, "mw_x", "Fitting head 2/5: rf")], "n string, s double, b double, a string, line string")
    r = df.select(tx.sanitize_name(F.col("n")), tx.fmt_duration(F.col("s") + 80), tx.fmt_size(F.col("b")), tx.axis_label(F.col("a")), tx.digest_log(F.col("line"))).first()
    assert tuple(r) == ("a-b", "2m 05s", "2 KB", "MW", "rf (head 2/5)")


def test_columns_are_sniffed(spark):
    df = spark.createDataFrame([("C", "1", None, "q"), ("CC", "0", None, "r")], "my_smiles string, act string, empty string, note string")
    assert tables.find_structure_column(df, tx.is_lexical_structure) == "my_smiles"
    assert tables.find_value_column(df, "my_smiles") == "act"
    with pytest.raises(tables.SchemaError):
        tables.find_structure_column(df.withColumn("smiles2", F.lit("C")), tx.is_lexical_structure)
    with pytest.raises(tables.SchemaError):
        tables.find_value_column(df.withColumn("other", F.lit("3")), "my_smiles")
    assert tables.resolve_columns(df, " ACT ") == "act" and tables.resolve_columns(df, "none") is None
    rec = spark.createDataFrame([('[{"a": 1, "b": null}]',)], "j string").select(tables.decode_records(F.col("j"), ["a", "b"])).first()[0]
    assert rec[0][0] == 1.0 and rec[0][1] != rec[0][1]


def test_components_and_tokens(spark):
    df = spark.createDataFrame([("CC.O.CC.Na",), ("O.Na",), ("BBBBBBBB",), ("CFe",)], "s string")
    r = df.select(prep.strip_components(F.col("s"), [F.array(F.lit("O")), F.array(F.lit("Na"))]).alias("kept"), prep.exclude_by_tokens(F.col("s")).alias("out")).collect()
    assert [x.kept for x in r] == ["CC", "Na", "BBBBBBBB", "CFe"] and [x.out for x in r] == [False, False, True, True]
