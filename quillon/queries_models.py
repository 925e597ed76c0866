"""Registered queries of folds, estimation reports, pooling, output tables, rankings and telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import text as tx
from quillon.functions.shared import kept
from quillon.operators import bagging, estimate, metrics, outputs, pooling, prep, ranking, splits, telemetry
from quillon.plans import fixtures as fx
from quillon.plans.fixtures import labelled, read
from quillon.queries import AP, FD, LG, PM, _avg_pool, _fold_data, _log, drawn_sql
from quillon.registry import query

# Folds and reports


@query("SELECT p_partkey AS compound_id, CASE WHEN p_size > 10 THEN left(p_name, 3) ELSE '__invalid__' || p_partkey END AS \"group\" FROM part")
def groups_by_key(spark, sf_dir):
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("compound_id"), F.col("p_name").alias("smiles"), "p_size")
    return splits.groups_by_key(part, lambda c: F.when(F.col("p_size") > 10, F.substring(c, 1, 3))).select("compound_id", "group")


@query(f"""WITH {FD}, o AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5(CAST(compound_id AS VARCHAR) || '-7'), compound_id) AS r, count(*) OVER (PARTITION BY bin) AS n FROM fd)
SELECT compound_id, bin, r <= round(0.2 * n) AS is_test FROM o""")
def one_split(spark, sf_dir):
    return splits.split(_fold_data(spark, sf_dir), "random", 7)


@query("SELECT p_brand AS strategy, round(avg(p_size / 50.0), 6) AS mean, round(stddev_pop(p_size / 50.0), 6) AS std, count(*) AS folds FROM part WHERE p_size <> 7 GROUP BY 1")
def fold_summary(spark, sf_dir):
    """NaN values (those of size 7) are left out."""
    part = read(spark, sf_dir, "part").select(F.col("p_brand").alias("strategy"), F.when(F.col("p_size") == 7, float("nan")).otherwise(F.col("p_size") / 50.0).alias("auroc"))
    return splits.fold_summary(part).select("strategy", "mean", "std", F.size("values").cast("long").alias("folds"))


@query(drawn_sql("sl") + """, c AS (SELECT descriptor, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos, round(avg(y), 6) AS prior FROM sl GROUP BY 1)
SELECT descriptor, n, n_pos, prior, round(auroc, 6) AS oof_auroc, round(1 - auroc, 6) AS train_auroc, round(1 - 2 * auroc, 6) AS gap, cutoff, 3.5::DOUBLE AS seconds FROM c JOIN auc USING (descriptor) JOIN cu USING (descriptor)""", scores=True)
def cv_report(spark, sf_dir):
    rows = kept(labelled(spark, sf_dir), "labelled")
    timings = rows.select("descriptor").distinct().select("descriptor", F.explode(F.array(F.lit(1.0), F.lit(2.5))).alias("seconds"))
    return estimate.cv_report(rows, rows.withColumn("p", 1 - F.col("p")), timings)


HELD = """, h AS (SELECT descriptor AS strategy, descriptor || '_' || (compound_id % 3) AS fold, p, y FROM sl),
ra AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY p) + (count(*) OVER (PARTITION BY fold, p) - 1) / 2 AS r FROM h),
ha AS (SELECT strategy, fold, sum(y) AS n1, count(*) - sum(y) AS n0, (sum(CASE WHEN y = 1 THEN r END) - n1 * (n1 + 1) / 2) / (n1 * n0) AS auroc FROM ra GROUP BY 1, 2),
hp AS (SELECT fold, p, count(*) AS n, sum(y) AS n1 FROM h GROUP BY 1, 2), hc AS (SELECT *, sum(n) OVER w AS cn, sum(n1) OVER w AS cn1, sum(n1) OVER (PARTITION BY fold) AS t1 FROM hp WINDOW w AS (PARTITION BY fold ORDER BY p DESC)),
hv AS (SELECT fold, sum(n1 / t1 * cn1 / cn) AS ap FROM hc GROUP BY 1),
hf AS (SELECT fold, count(CASE WHEN p >= 0.15 AND y = 1 THEN 1 END) AS tp, count(CASE WHEN p < 0.15 AND y = 0 THEN 1 END) AS tn, count(CASE WHEN p >= 0.15 AND y = 0 THEN 1 END) AS fp, count(CASE WHEN p < 0.15 AND y = 1 THEN 1 END) AS fn FROM h GROUP BY 1),
hm AS (SELECT strategy, fold, auroc, ap, mcc, f1 FROM ha JOIN hv USING (fold) JOIN (SELECT fold, """ + PM + " FROM hf) USING (fold))"


def _heldout(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    held = rows.select(F.col("descriptor").alias("strategy"), F.concat_ws("_", "descriptor", F.col("compound_id") % 3).alias("fold"), "p", "y")
    return metrics.heldout_metrics(held, cutoff=0.15)


@query(HELD + " SELECT strategy, fold, round(auroc, 6) AS auroc, round(ap, 6) AS ap, mcc, f1 FROM hm", scores=True)
def heldout_metrics(spark, sf_dir):
    return _heldout(spark, sf_dir)


@query(HELD + " SELECT strategy, count(*) AS folds, " + ", ".join(f"round(avg({m}), 5) AS {m}_mean, round(stddev_pop({m}), 5) AS {m}_std" for m in ("auroc", "ap", "mcc", "f1")) + " FROM hm GROUP BY 1", scores=True)
def strategy_summary(spark, sf_dir):
    out = metrics.strategy_summary(_heldout(spark, sf_dir))
    return out.select(*(F.round(c, 5).alias(c) if t == "double" else c for c, t in out.dtypes))


# Pooling


@query(" SELECT bool_and(r) AS rank_q, bool_and(a) AS ad, bool_and(w) AS p_raw FROM (SELECT count(p) > 0 AS r, count(CASE WHEN descriptor <> 'len' THEN p END) > 0 AS a, count(CASE WHEN p > 0.1 THEN p END) > 0 AS w FROM s0 GROUP BY descriptor)", scores=True)
def signals_present(spark, sf_dir):
    """The domain signal counts as absent, for one descriptor has none."""
    rows = fx.scores(spark, sf_dir).withColumns({"rank_q": F.col("p"), "ad": F.when(F.col("descriptor") != "len", F.col("p")), "p_raw": F.when(F.col("p") > 0.1, F.col("p"))})
    return spark.createDataFrame([pooling.signals_present(rows)], "rank_q boolean, ad boolean, p_raw boolean")


@query("SELECT source AS descriptor, CAST(count(*) AS DOUBLE) AS skill FROM documents GROUP BY 1 HAVING bool_or(lang = 'en')")
def reconcile(spark, sf_dir):
    """Trained descriptors (sources) that the present rows (English ones) still have."""
    docs = read(spark, sf_dir, "documents").withColumnRenamed("source", "descriptor")
    model = docs.groupBy("descriptor").agg(F.count("*").cast("double").alias("skill"))
    return pooling.reconcile(model, docs.filter("lang = 'en'"))


@query(" SELECT compound_id, round(median(p), 6) AS clf, CAST(median(p) > 0.5 AS INTEGER) AS clf_bin FROM s0 GROUP BY 1", scores=True)
def pool_classifier(spark, sf_dir):
    return bagging.pool_scores(fx.scores(spark, sf_dir), bagging.Bag("median"))


@query(AP + " SELECT doc_id * 2 AS orig_idx, CASE WHEN doc_id % 5 > 0 THEN doc_id END::VARCHAR AS compound_id, CASE WHEN doc_id % 5 > 0 THEN CAST(round(clf * 1e6) AS BIGINT) END::VARCHAR AS clf_millionths FROM documents LEFT JOIN ap ON compound_id = doc_id", scores=True)
def assemble(spark, sf_dir):
    """Every fifth input row has no entity."""
    docs = read(spark, sf_dir, "documents")
    mapping = docs.select((F.col("doc_id") * 2).alias("orig_idx"), F.when(F.col("doc_id") % 5 > 0, F.col("doc_id")).alias("compound_id"))
    out = pooling.assemble(docs.select(F.col("doc_id").alias("compound_id")), _avg_pool(spark, sf_dir).select("compound_id", "clf"), mapping)
    return out.select("orig_idx", F.col("compound_id").cast("string"), F.round(F.col("clf") * 1e6).cast("long").cast("string").alias("clf_millionths"))


# Output tables and rankings


POOLED = fx.SQL.replace("sl AS (SELECT ps.*, y FROM ps JOIN lab USING (compound_id))", AP.removeprefix(", ") + ", s1 AS (SELECT compound_id, descriptor, p FROM ps UNION ALL SELECT compound_id, 'pooled', clf FROM ap), sl AS (SELECT s1.*, y FROM s1 JOIN lab USING (compound_id))")


@query(f"""WITH {POOLED}, cf AS (SELECT descriptor, count(CASE WHEN p >= 0.15 AND y = 1 THEN 1 END) AS tp, count(CASE WHEN p < 0.15 AND y = 0 THEN 1 END) AS tn, count(CASE WHEN p >= 0.15 AND y = 0 THEN 1 END) AS fp, count(CASE WHEN p < 0.15 AND y = 1 THEN 1 END) AS fn FROM sl GROUP BY 1)
SELECT descriptor AS model, round(auroc, 6) AS auroc, tp, tn, fp, fn, {PM} FROM cf JOIN auc USING (descriptor)""")
def performance_table(spark, sf_dir):
    out = outputs.performance_table(_avg_pool(spark, sf_dir), fx.scores(spark, sf_dir), fx.labels(spark, sf_dir).withColumnRenamed("y", "bin"), 0.15)
    return out.select("model", "auroc", "tp", "tn", "fp", "fn", "accuracy", "balanced_accuracy", "precision", "recall", "f1", "mcc")


@query(AP + """, w AS (SELECT descriptor, avg(p) AS w, avg(CASE WHEN p < 0.1 THEN 1.0 ELSE 0.0 END) AS o FROM s0 GROUP BY 1),
ql AS (SELECT clf, y FROM ap JOIN lab USING (compound_id)), qr AS (SELECT y, rank() OVER (ORDER BY clf) + (count(*) OVER (PARTITION BY clf) - 1) / 2 AS r FROM ql),
qa AS (SELECT (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) AS a FROM qr),
qc AS (SELECT count(CASE WHEN clf > 0.5 AND y = 1 THEN 1 END) AS tp, count(CASE WHEN clf <= 0.5 AND y = 0 THEN 1 END) AS tn, count(CASE WHEN clf > 0.5 AND y = 0 THEN 1 END) AS fp, count(CASE WHEN clf <= 0.5 AND y = 1 THEN 1 END) AS fn FROM ql), qm AS (SELECT """ + PM + """ FROM qc)
SELECT 'counts' AS section, 'entities' AS name, CAST(count(*) AS VARCHAR) AS value FROM lab UNION ALL SELECT 'counts', 'active', CAST(sum(y) AS BIGINT)::VARCHAR FROM lab UNION ALL SELECT 'counts', 'inactive', CAST(sum(1 - y) AS BIGINT)::VARCHAR FROM lab
UNION ALL SELECT 'descriptors', d, CASE WHEN d = 'digit' THEN 'dropped' ELSE 'used' END FROM unnest(['digit', 'len', 'space']) t(d) UNION ALL SELECT 'pooling', 'tier', 'skill'
UNION ALL SELECT 'pooling', 'share_active', CAST(CAST(round(avg(CASE WHEN clf > 0.5 THEN 1.0 ELSE 0.0 END), 4) AS DECIMAL(18, 4)) AS VARCHAR) FROM ap UNION ALL SELECT 'quality', 'auroc', CAST(CAST(round(a, 4) AS DECIMAL(18, 4)) AS VARCHAR) FROM qa UNION ALL SELECT 'quality', 'accuracy', CAST(CAST(round(accuracy, 4) AS DECIMAL(18, 4)) AS VARCHAR) FROM qm UNION ALL SELECT 'quality', 'mcc', CAST(CAST(round(mcc, 4) AS DECIMAL(18, 4)) AS VARCHAR) FROM qm
UNION ALL SELECT 'weights', descriptor, CAST(CAST(round(w, 4) AS DECIMAL(18, 4)) AS VARCHAR) FROM w UNION ALL SELECT 'outside', descriptor, CAST(CAST(round(o, 4) AS DECIMAL(18, 4)) AS VARCHAR) FROM w""", scores=True)
def run_summary(spark, sf_dir):
    weights = fx.scores(spark, sf_dir).select("descriptor", F.col("p").alias("w"), (F.col("p") < 0.1).alias("vetoed"))
    data = fx.labels(spark, sf_dir).withColumnRenamed("y", "bin")
    return outputs.run_summary(data, _avg_pool(spark, sf_dir), weights, fx.DESCRIPTORS, ["len", "space"], pooling.tier(False, False))


def _hist(column: str, more: str = "") -> str:
    return AP + f""", hb AS (SELECT CAST(least(floor({column} * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM ap WHERE {column} BETWEEN 0 AND 1 GROUP BY 1)
SELECT bin, n, round(n / (SELECT sum(n) FROM hb) * 20, 6) AS density{more} FROM hb"""


@query(_hist("clf_ad", ", (SELECT count(*) FROM ap WHERE clf_ad <= 0) AS outside"), scores=True)
def domain_coverage(spark, sf_dir):
    return ranking.domain_coverage(_avg_pool(spark, sf_dir))


@query(_hist("clf_rank"), scores=True)
def rank_distribution(spark, sf_dir):
    return ranking.rank_distribution(_avg_pool(spark, sf_dir))


@query("""WITH e AS (SELECT vec_id AS compound_id, 'first' AS name, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label % 2 AS bin FROM embeddings)
SELECT name, compound_id, round(x, 6) AS x, round(y, 6) AS y, bin FROM e QUALIFY row_number() OVER (PARTITION BY name, bin ORDER BY md5(CAST(compound_id AS VARCHAR)), compound_id) <= 100""")
def projection_points(spark, sf_dir):
    """A figure's points: at most 100 a class."""
    v = read(spark, sf_dir, "embeddings")
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    points = v.select(F.col("vec_id").alias("compound_id"), F.lit("first").alias("name"), at(0).alias("x"), at(1).alias("y"))
    return ranking.projection_points(points, v.select(F.col("vec_id").alias("compound_id"), (F.col("label") % 2).alias("bin")), cap=100).select("name", "compound_id", "x", "y", "bin")


@query(AP + " SELECT compound_id, round(clf, 6) AS clf, y AS bin FROM ap JOIN lab USING (compound_id)", scores=True)
def training_reference(spark, sf_dir):
    return ranking.training_reference(_avg_pool(spark, sf_dir), fx.labels(spark, sf_dir).withColumnRenamed("y", "bin"))


# Telemetry and text


@query(f"WITH {LG} SELECT lg.run, lg.name, round(lg.t, 6) AS t, round(lg.t - min(lg.t) OVER (PARTITION BY lg.run), 6) AS elapsed, cpu, round(s, 3) AS seconds, place FROM lg LEFT JOIN (SELECT *, CAST(row_number() OVER (PARTITION BY run ORDER BY round(s, 3) DESC, name) AS INTEGER) AS place FROM sd) x ON x.run = lg.run AND x.name = lg.name")
def usage_timeline(spark, sf_dir):
    return telemetry.usage_timeline(_log(spark, sf_dir)).drop("ram_used_gb").withColumn("seconds", F.round("seconds", 3))


@query("""WITH m AS (SELECT avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS m, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS q FROM orders)
SELECT round(any_value(m) * any_value(q) + sum(CASE WHEN o_orderstatus = 'P' THEN greatest(0, m - o_totalprice) ELSE 0 END), 2) AS seconds FROM orders, m""")
def eta(spark, sf_dir):
    state = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "queued").otherwise("running")
    return telemetry.eta(read(spark, sf_dir, "orders").select(state.alias("state"), F.col("o_totalprice").alias("elapsed"))).select(F.round("seconds", 2).alias("seconds"))


@query("SELECT p_partkey, CASE WHEN p_size * 7 < 60 THEN (p_size * 7) || 's' ELSE (p_size * 7 // 60) || 'm ' || lpad(CAST(p_size * 7 % 60 AS VARCHAR), 2, '0') || 's' END AS took FROM part")
def fmt_duration(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", tx.fmt_duration(F.col("p_size") * 7).alias("took"))


@query("SELECT p_partkey, p_brand || ' ' || p_type AS label FROM part")
def axis_label(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", tx.axis_label(F.concat_ws("_", "p_brand", "p_type", F.lit("x"))).alias("label"))


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN p_type || ' (head ' || p_size || '/50)' WHEN 1 THEN 'batch ' || p_size || '/50' WHEN 2 THEN 'selected ' || p_type WHEN 3 THEN 'calibrating' END AS status FROM part")
def digest_log(spark, sf_dir):
    k = F.col("p_size") % 5
    line = (
        F.when(k == 0, F.format_string("Fitting head %d/50: %s", "p_size", "p_type")).when(k == 1, F.format_string("batch %d/50 is done", "p_size"))
        .when(k == 2, F.concat(F.lit("Portfolio winner: "), "p_type")).when(k == 3, F.lit("Calibrating scores")).otherwise(F.col("p_name"))
    )
    return read(spark, sf_dir, "part").select("p_partkey", tx.digest_log(line).alias("status"))


@query("""WITH v AS (SELECT p_partkey, CAST(p_retailprice AS DOUBLE) / 1000 AS x FROM part), y AS (SELECT p_partkey, l, CASE WHEN abs(l) < 1e-9 THEN ln(1 + x) ELSE (pow(1 + x, l) - 1) / l END AS y FROM v, (SELECT round(-4 + 8 * i / 80.0::DOUBLE, 6) AS l FROM range(81) t(i))),
g AS (SELECT l, var_pop(y) AS s, avg(y) AS m, count(*) AS n FROM y GROUP BY l), b AS (SELECT l, m, sqrt(s) AS s FROM g ORDER BY -0.5 * n * ln(greatest(s, 1e-300)) + (l - 1) * (SELECT sum(ln(1 + x)) FROM v) DESC LIMIT 1), z AS (SELECT p_partkey, (y - m) / s AS power FROM y JOIN b USING (l)),
k AS (SELECT quantile_cont(CAST(x AS DOUBLE), [i / 100 FOR i IN range(0, 101)]) AS k FROM v), a AS (SELECT p_partkey, CAST(x AS DOUBLE) AS x, k, len(list_filter(k, lambda q: q <= CAST(x AS DOUBLE))) AS b FROM v, k),
u AS (SELECT p_partkey, x, CASE WHEN b = 0 THEN 0 WHEN b > 100 THEN 1 ELSE (b - 1 + (x - k[b]) / (k[b + 1] - k[b])) / 100 END AS u FROM a), n AS (SELECT *, 2 * least(1 - 1e-7, greatest(1e-7, u)) - 1 AS e FROM u),
w AS (SELECT *, ln(greatest(1 - e * e, 1e-300)) AS l, 2 / (3.141592653589793 * 0.147) + ln(greatest(1 - e * e, 1e-300)) / 2 AS f FROM n)
SELECT p_partkey, round(x, 6) AS raw, round(power, 4) AS power, round(u, 6) AS uniform, round(sign(e) * sqrt(sqrt(f * f - l / 0.147) - f) * sqrt(2), 4) AS normal FROM w JOIN z USING (p_partkey)""")
def label_variants(spark, sf_dir):
    """Prices in thousands: negative powers of large numbers differ by less than a double can tell."""
    part = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice").cast("double") / 1000).alias("v"))
    out = prep.label_variants(part, "v", prep.fit_power(part, "v"), prep.fit_quantiles(part, "v"))
    return out.select("p_partkey", "raw", F.round("power", 4).alias("power"), "uniform", F.round("normal", 4).alias("normal"))


@query("SELECT p_partkey, round(CAST(p_retailprice AS DOUBLE), 3) AS raw, round(CAST(p_retailprice AS DOUBLE), 3) AS power_label, round(CAST(p_retailprice AS DOUBLE), 3) AS uniform_label FROM part")
def inverse_labels(spark, sf_dir):
    """Variants put back on the label's scale are the labels."""
    part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("double").alias("v"))
    power, knots = prep.fit_power(part, "v"), prep.fit_quantiles(part, "v")
    out = prep.inverse_variants(prep.label_variants(part, "v", power, knots), {"power": prep.inverse_power(F.col("power"), power), "uniform": prep.inverse_quantiles(F.col("uniform"), knots)})
    return out.select("p_partkey", *(F.round(c, 3).alias(c) for c in ("raw", "power_label", "uniform_label")))
