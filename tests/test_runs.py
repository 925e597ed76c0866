"""Projections, the switch of output modes, hooks and streams over several micro-batches."""

import glob
import os

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillon.catalog import QUERIES
from quillon.operators import features, outputs, projection
from quillon.plans import fixtures
from quillon.streaming import streams


def clouds(n=240):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(4, 10)) * 6
    return [(f"c{i}", [float(v) for v in centers[i % 4] + rng.normal(size=10)]) for i in range(n)]


def trustworthiness(x, at, k=8):
    """How few of a row's neighbours in the picture are none in the data (1: none)."""
    n = len(x)
    ranks = np.argsort(np.argsort(projection.distances(x, x), axis=1), axis=1)
    seen = np.argsort(projection.distances(at, at), axis=1)[:, 1 : k + 1]
    off = sum(max(0, ranks[i, j] - k) for i in range(n) for j in seen[i])
    return 1 - 2 * off / (n * k * (2 * n - 3 * k - 1))


def test_projections(spark, tmp_path):
    rows = clouds()
    df = spark.createDataFrame([*rows, ("none", None)], "compound_id string, features array<double>")
    x = np.array([v for _, v in rows])
    for kind in ("pca", "spectral"):
        model = projection.fit_projection(df, "features", kind, count=100)
        projection.save_projection(spark, model, f"{tmp_path}/{kind}")
        loaded = projection.load_projection(spark, f"{tmp_path}/{kind}")
        got = {r["compound_id"]: (r["x"], r["y"]) for r in projection.project(df, loaded, "features").collect()}
        assert set(got) == {i for i, _ in rows}
        at = np.array([got[i] for i, _ in rows])
        rng = np.random.default_rng(9)
        assert trustworthiness(x, at) > 0.85 > trustworthiness(x, rng.random((len(x), 2)))
        # the same row alone has the same place
        one = projection.project(df.filter("compound_id = 'c7'"), loaded, "features").first()
        assert np.allclose((one["x"], one["y"]), got["c7"], atol=1e-9)
        again = projection.fit_projection(df.repartition(5), "features", kind, count=100)
        assert np.allclose(again.axes, model.axes, atol=1e-9)
    centered = x - x.mean(axis=0)
    wanted = centered @ np.linalg.svd(centered, full_matrices=False)[2][:2].T
    pca = projection.fit_projection(df, "features").place(x)
    assert np.allclose(np.abs(pca), np.abs(wanted), atol=1e-8)


def test_projections_of_little(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0])], "compound_id string, features array<double>")
    for rows in (df, df.limit(0)):
        model = projection.fit_projection(rows, "features", "spectral")
        assert projection.project(rows, model, "features").count() == rows.count()


def test_one_bad_row_switches_the_table(spark):
    df = spark.createDataFrame([(f"s{i}",) for i in range(40)] + [(None,)], "smiles string").repartition(4)

    def first(values):
        if "s7" in values:
            raise ValueError
        return [[1.0]] * len(values)

    def second(values):
        if "s9" in values:
            raise ValueError
        return [[2.0]] * len(values)

    run = lambda a, b: {r["input"]: r["features"] for r in features.featurize_whole(df, a, b, width=1, descriptor="d", version="v1", batch=3).collect()}
    switched = run(first, second)
    assert len(switched) == 40 and switched["s9"] is None and {v[0] for i, v in switched.items() if i != "s9"} == {2.0}
    assert {tuple(v) for v in run(lambda v: [[1.0]] * len(v), second).values()} == {(1.0,)}


def test_properties(spark):
    df = spark.createDataFrame([("ab-",), ("",), (None,)], "smiles string")
    got = features.properties(df, {"n": F.length, "third": lambda c: F.length(c) / 7}).collect()
    assert [r["n"] for r in got[:2]] == [3.0, 0.0] and got[0]["third"] == 0.4286 and np.isnan(got[2]["n"]) and np.isnan(got[2]["third"])
    assert features.properties(df).columns == ["smiles", "length", "symbols"]


def test_seen_keys_outlive_a_restart(spark, tmp_path):
    """Three files, the second stream starts anew from the checkpoint; every key stays once, with its first row."""
    at, store = f"{tmp_path}/in", f"{tmp_path}/store"
    schema = "key string, ts int, v string"
    add = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(at)
    start = lambda: streams.dedupe_store(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(at), store, f"{tmp_path}/state").awaitTermination()
    add([("a", 2, "late"), ("a", 1, "first"), ("b", 5, "b")])
    start()
    add([("a", 0, "again"), ("c", 1, "c")])
    add([("c", 0, "c again"), ("d", 0, "d")])
    start()
    got = {r["key"]: (r["v"], r["batch"]) for r in spark.read.option("basePath", store).parquet(store).collect()}
    assert got["a"] == ("first", 0) and got["b"] == ("b", 0) and set(got) == {"a", "b", "c", "d"}


def test_halves_of_a_stream_are_many_files(spark, sf_dir, tmp_path):
    """No task holds half of a table: each of the two micro-batches has as many files as tasks wrote it."""
    for table in ("labels", "documents"):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        rows.repartition(4).write.parquet(f"{tmp_path}/{table}.parquet")
    top = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(glob.glob(f"{top}/stream-*")) | set(glob.glob(f"{top}/pooled-*"))
    assert QUERIES["pooled_stream"](spark, str(tmp_path)).count() == 200
    new = (set(glob.glob(f"{top}/stream-*")) | set(glob.glob(f"{top}/pooled-*"))) - before
    written = [p for p in new if "/stream-" in p and not p.endswith("-state")]
    assert len(written) == 1 and len(glob.glob(f"{written[0]}/*.parquet")) == 8
    assert sorted(os.listdir(next(p for p in new if "/pooled-" in p))) == ["batch=0", "batch=1"]


def test_summary_reads_weights_and_pooled_rows_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        calls.add(1)
        return v

    pooled = spark.range(20).select(F.col("id").alias("compound_id"), counted(F.col("id") / 20).alias("clf"), (F.col("id") > 9).cast("int").alias("clf_bin"))
    data = spark.range(20).select(F.col("id").alias("compound_id"), (F.col("id") % 2).cast("int").alias("bin"))
    weights = spark.range(30).select(F.lit("d").alias("descriptor"), counted(F.col("id") / 30).alias("w")).withColumn("vetoed", F.col("w") < 0.5)
    got = {(r.section, r.name): r.value for r in outputs.run_summary(data, pooled, weights, ["d"], ["d"], "skill").collect()}
    assert got[("outside", "d")] == "0.5000" and got[("pooling", "share_active")] == "0.5000" and got[("counts", "entities")] == "20"
    assert calls.value == 50


def test_shared_scores_count_each_text_once(spark, sf_dir):
    out = fixtures.scores(spark, sf_dir)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "regexp_replace" not in plan
    texts = {r.doc_id: (r.text or "", r.n_chars) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in out.filter("descriptor = 'digit'").collect():
        text, n = texts[r.compound_id]
        assert r.p == (min(1.0, sum("0" <= ch <= "9" for ch in text) / n) if n else 0.0)


def test_hooks(spark):
    from pyspark.sql.functions import udf, udtf

    class Letters:
        def eval(self, text: str):
            for c in text:
                yield (c,)

    names = streams.register_hooks(spark, {"shout": udf(lambda s: s.upper(), StringType())}, {"letters": udtf(Letters, returnType="letter string")})
    assert names == ["letters", "shout"]
    assert spark.sql("SELECT shout('ab') AS s").first()["s"] == "AB"
    assert [r["letter"] for r in spark.sql("SELECT * FROM letters('xyz')").collect()] == ["x", "y", "z"]
