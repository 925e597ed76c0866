"""Registered queries of whole runs: one output mode a table, streams over several micro-batches, label smoothing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quillon.functions.shared import kept, shared_path
from quillon.operators import estimate, features, metrics, pooling, prep, projection, scaling
from quillon.plans import fixtures as fx
from quillon.plans.fixtures import labelled, read
from quillon.queries import STATS, _vectors
from quillon.queries_models import HELD, _heldout
from quillon.registry import query
from quillon.sources import tables
from quillon.streaming import streams


@query("SELECT md5(p_name) AS key, length(p_name)::DOUBLE AS length, 2.0::DOUBLE AS mode FROM part")
def featurize_whole(spark, sf_dir):
    """One structure on which the first function fails switches all rows to the second."""
    part = read(spark, sf_dir, "part").select(F.col("p_name").alias("smiles"))
    bad = part.agg(F.min("smiles")).first()[0]

    def first(values: list[str]) -> list:
        if bad in values:
            raise ValueError("a structure that fails")
        return [[len(v), 1.0] for v in values]

    out = features.featurize_whole(part, first, lambda values: [[len(v), 2.0] for v in values], width=2, descriptor="length", version="v1", batch=50)
    return out.select("key", F.col("features")[0].cast("double").alias("length"), F.col("features")[1].cast("double").alias("mode"))


@query("SELECT doc_id, round(length(text), 4)::DOUBLE AS length, CASE WHEN length(text) > 0 THEN round(length(regexp_replace(text, '[A-Za-z0-9 ]', '', 'g')) / length(text), 4) END AS symbols FROM documents")
def properties(spark, sf_dir):
    got = features.properties(read(spark, sf_dir, "documents").select("doc_id", "text"), structure="text")
    return got.select("doc_id", *(F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("length", "symbols")))


def _in_halves(spark, rows, half, start) -> None:
    """Two micro-batches: a half is written as files of its own tasks and read by start(stream, checkpoint) to its end, then
    the other one by the same state. A run has one batch, however many files there are."""
    at = shared_path(spark, "stream")
    for k in (0, 1):
        rows.filter(half == k).write.mode("append").parquet(at)
        start(spark.readStream.schema(rows.schema).parquet(at), f"{at}-state").awaitTermination()


@query("""WITH e AS (SELECT md5(event_type || '-' || user_id) AS key, ts, event_id, event_id % 2 AS b FROM events), f AS (SELECT key, min(b) AS b FROM e GROUP BY 1)
SELECT key, arg_min(event_id, (ts, event_id)) AS event_id, CAST(b AS INTEGER) AS batch FROM e JOIN f USING (key, b) GROUP BY key, b""")
def dedupe_store(spark, sf_dir):
    """Two micro-batches; a key of the first is not seen as new in the second."""
    rows = read(spark, sf_dir, "events").select(F.md5(F.concat_ws("-", "event_type", "user_id")).alias("key"), "ts", "event_id")
    to = shared_path(spark, "seen")
    _in_halves(spark, rows, F.col("event_id") % 2, lambda stream, state: streams.dedupe_store(stream, to, state))
    return spark.read.option("basePath", to).parquet(to).select("key", "event_id", F.col("batch").cast("int").alias("batch"))


@query(" SELECT compound_id, round(1 / (1 + exp(-sum(skill * ln(q / (1 - q))) / sum(skill))), 6) AS clf FROM (SELECT compound_id, descriptor, least(1 - 1e-7, greatest(1e-7, p)) AS q FROM s0) JOIN sk USING (descriptor) GROUP BY 1", scores=True)
def pooled_stream(spark, sf_dir):
    """Documents in two micro-batches, pooled by a model that was fitted on labelled ones and saved."""
    saved, out = shared_path(spark, "pool-model"), shared_path(spark, "pooled")
    pooling.save_pool(pooling.fit_pool(fx.signals(spark, sf_dir)), saved)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")

    def scores(df):
        blank = F.lit(None).cast("double")
        return fx.scores(spark, sf_dir, df).select("compound_id", "descriptor", "p", blank.alias("rank_q"), blank.alias("ad"))

    pooled = lambda stream, state: streams.pooled_stream(stream, scores, saved, out, state, use_rank=False, use_ad=False)
    _in_halves(spark, docs, F.pmod(F.xxhash64("doc_id"), F.lit(2)), pooled)
    return spark.read.parquet(f"{out}/*").select("compound_id", "clf")


_U = "(CAST('0x' || substr(md5(id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0"


@query(f"""WITH r AS (SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_quantity AS DOUBLE) AS f, CASE WHEN l_linenumber = 1 THEN round(l_extendedprice / 10000) * 10000 ELSE CAST(l_extendedprice AS DOUBLE) END AS v FROM lineitem),
h AS (SELECT v AS r, count(*) AS n FROM r GROUP BY 1 HAVING count(*) > greatest(0.01 * (SELECT count(*) FROM r), 3)), o AS (SELECT v FROM r WHERE v NOT IN (SELECT r FROM h)),
t AS (SELECT quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi FROM o),
b AS (SELECT r, n, (SELECT quantile_cont(v, 0.01) FROM o WHERE v > r) AS over, (SELECT quantile_cont(v, 0.99) FROM o WHERE v < r) AS under, (SELECT quantile_cont(v, 0.01) FROM o WHERE v < r) AS first FROM h),
i AS (SELECT r, n, CASE WHEN r < lo THEN r - (coalesce(over, r) - r) WHEN r > hi THEN r ELSE coalesce(under, r) END AS a, CASE WHEN r < lo THEN r WHEN r > hi THEN r + (r - coalesce(first, r)) ELSE coalesce(over, r) END AS z FROM b, t),
s AS (SELECT id, v, CASE WHEN n IS NULL THEN v ELSE a + (z - a) * (row_number() OVER (PARTITION BY v ORDER BY f, id) - 1) / greatest(n - 1, 1) END AS s FROM r LEFT JOIN i ON v = r),
x AS (SELECT id, v, s, 2 * ({_U}) - 1 AS x, stddev_pop(s) OVER () AS d FROM s),
y AS (SELECT *, ln(greatest(1 - x * x, 1e-300)) AS l, 2 / (3.141592653589793 * 0.147) + ln(greatest(1 - x * x, 1e-300)) / 2 AS k FROM x)
SELECT id, round(s + 1e-6 * d * sign(x) * sqrt(sqrt(k * k - l / 0.147) - k) * sqrt(2), 4) AS smoothed FROM y""")
def smooth_by_model(spark, sf_dir):
    """Prices of first lines are rounded, so they repeat; a linear model of the quantity orders them."""
    price = F.col("l_extendedprice").cast("double")
    value = F.when(F.col("l_linenumber") == 1, F.round(price / 10000) * 10000).otherwise(price)
    rows = read(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.array(F.col("l_quantity").cast("double")).alias("features"), value.alias("value"))
    got = prep.smooth_by_model(kept(rows, "rows"), "value", "features", "id", kind="linear")
    return got.select("id", F.round("smoothed", 4).alias("smoothed"))


def _projected(spark, sf_dir, kind):
    """A projection that is fitted, saved, loaded and applied."""
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("compound_id"), F.col("embedding").alias("features"))
    at = shared_path(spark, "projection")
    projection.save_projection(spark, projection.fit_projection(rows, "features", kind), at)
    return projection.project(rows, projection.load_projection(spark, at), "features")


@query()
def project_2d(spark, sf_dir):
    return _projected(spark, sf_dir, "pca")


@query()
def project_spectral(spark, sf_dir):
    return _projected(spark, sf_dir, "spectral")


# What a run keeps


@query("""SELECT lang AS descriptor, doc_id, CASE WHEN lang = 'en' THEN 2.0 * n_chars ELSE n_chars END::DOUBLE AS value FROM documents WHERE lang IS NOT NULL""")
def effective_features(spark, sf_dir):
    """The English matrix was treated, the others are raw."""
    docs = read(spark, sf_dir, "documents").filter("lang IS NOT NULL").select(F.col("lang").alias("descriptor"), "doc_id", F.col("n_chars").cast("double").alias("value"))
    treated = docs.filter("descriptor = 'en'").withColumn("value", 2 * F.col("value"))
    return tables.effective_features(docs, treated)


@query(HELD + " SELECT strategy, fold, round(auroc, 6) AS auroc, round(ap, 6) AS ap, mcc, f1 FROM hm", scores=True)
def write_validation(spark, sf_dir):
    """Metrics, held-out rows and summary are written; the metrics read back."""
    at, found = shared_path(spark, "validation"), kept(_heldout(spark, sf_dir), "metrics")
    held = labelled(spark, sf_dir).select(F.col("descriptor").alias("strategy"), "p", "y")
    tables.write_validation(found, held, metrics.strategy_summary(found), at)
    return spark.read.schema(found.schema).csv(f"{at}/validation", header=True)


@query(" SELECT 'scores' AS dir, count(*) AS n FROM sl UNION ALL SELECT 'model', count(*) FROM sl", scores=True)
def retention(spark, sf_dir):
    """The intermediate table of a fit goes, its scores and model stay."""
    at = shared_path(spark, "run")
    for name in ("matrix", "scores", "model"):
        labelled(spark, sf_dir).write.parquet(f"{at}/{name}")
    tables.drop_tables(spark, at, prep.retained(["matrix", "scores", "model"], "fit", intermediate={"matrix"}, models={"model"}))
    left = spark.read.option("recursiveFileLookup", "true").parquet(at)
    return left.groupBy(F.regexp_extract(F.input_file_name(), "/([a-z]+)/[^/]+$", 1).alias("dir")).agg(F.count("*").alias("n"))


@query(f"WITH {STATS} SELECT vec_id AS compound_id, round(sum(abs(CAST((x - m) / s AS FLOAT)::DOUBLE)), 3) AS total FROM e JOIN f USING (pos) GROUP BY 1")
def saved_transformer(spark, sf_dir):
    """Fitted, saved, loaded, and applied to arrays in another order."""
    at, v = shared_path(spark, "transformers"), _vectors(spark, sf_dir)
    scaling.save_transformer(scaling.fit_transformer(v), at, "embedding", "v1")
    saved = scaling.load_transformer(spark, at, "embedding", "v1")
    names = [f"f{i}" for i in reversed(range(saved.count()))]
    back = scaling.reorder_features(v.withColumn("features", F.reverse("features")), saved, names)
    out = scaling.apply_transformer(back, saved)
    return out.select("compound_id", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 3).alias("total"))


@query("SELECT 'broken' AS descriptor, false AS fitted, count(*) AS n FROM embeddings UNION ALL SELECT 'first', true, count(*) FROM embeddings")
def fit_all(spark, sf_dir):
    """A descriptor whose features are missing fails alone."""
    v = _vectors(spark, sf_dir)
    matrices = {"first": v.withColumn("features", F.slice("features", 1, 4)), "broken": v.withColumn("features", F.lit(None).cast("array<float>"))}
    models, errors = estimate.fit_all(matrices)
    rows = [matrices[n].select(F.lit(n).alias("descriptor"), F.lit(n in models).alias("fitted")) for n in sorted({*models, *errors})]
    return rows[0].unionByName(rows[1]).groupBy("descriptor", "fitted").agg(F.count("*").alias("n"))


_EV = """, ev AS (SELECT 'all' AS part, p, y FROM sl WHERE descriptor = 'len' UNION ALL SELECT 'validation', p, y FROM sl WHERE descriptor = 'len' AND substr(md5(CAST(compound_id AS VARCHAR)), 1, 1) < '8'),
er AS (SELECT part, y, rank() OVER (PARTITION BY part ORDER BY p) + (count(*) OVER (PARTITION BY part, p) - 1) / 2 AS r FROM ev)"""


@query(_EV + " SELECT part, round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 6) AS auroc FROM er GROUP BY 1", scores=True)
def evaluate(spark, sf_dir):
    rows = labelled(spark, sf_dir).filter("descriptor = 'len'")  # one model's scores, as the operator takes them
    return estimate.evaluate(rows, validation=F.substring(F.md5(F.col("compound_id").cast("string")), 1, 1) < "8")


@query("SELECT descriptor AS strategy, 'roc' AS curve, round(p, 6) AS threshold, round((cn - cn1) / (t - t1), 6) AS x, round(cn1 / t1, 6) AS y FROM cum UNION ALL SELECT DISTINCT descriptor, 'roc', NULL, 0.0, 0.0 FROM cum UNION ALL SELECT descriptor, 'pr', round(p, 6), round(cn1 / t1, 6), round(cn1 / cn, 6) FROM cum UNION ALL SELECT DISTINCT descriptor, 'pr', NULL, 0.0, 1.0 FROM cum", scores=True)
def strategy_curves(spark, sf_dir):
    return metrics.strategy_curves(labelled(spark, sf_dir).select(F.col("descriptor").alias("strategy"), "p", "y"))


@query("SELECT p_partkey, upper(w) AS word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)")
def hooks(spark, sf_dir):
    """A user function and a user table function, called from SQL by name."""
    @F.pandas_udf("string")
    def shout(values: pd.Series) -> pd.Series:
        return values.str.upper()

    class Words:
        def eval(self, text: str):
            for word in (text or "").split(" "):
                yield (word,)

    streams.register_hooks(spark, {"hook_shout": shout}, {"hook_words": F.udtf(Words, returnType="word string")})
    return spark.sql("SELECT p_partkey, hook_shout(word) AS word FROM {part}, LATERAL hook_words(p_name)", part=read(spark, sf_dir, "part"))
