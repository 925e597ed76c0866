"""Per-descriptor estimation with pyspark.ml: out-of-fold scores, rank quantiles, applicability domain, reports."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.ordered import running
from quillon.functions.selection import quantile
from quillon.functions.shared import kept
from quillon.operators.calibrate import calibrated, cross_calibrated, fit_isotonic, knots_of
from quillon.operators.metrics import auroc, cutoffs, regression_metrics

SEED = 42


def _vectors(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("_v", array_to_vector(features))


def estimator(kind: str = "logistic"):
    common = {"featuresCol": "_v", "labelCol": "y"}
    if kind == "forest":
        return RandomForestClassifier(numTrees=100, maxDepth=5, seed=SEED, **common)
    if kind == "proxy":
        return RandomForestClassifier(numTrees=100, maxDepth=3, seed=SEED, **common)
    if kind == "boosted":
        return GBTClassifier(maxIter=30, maxDepth=3, seed=SEED, **common)
    return LogisticRegression(regParam=0.01, maxIter=20, **common)


def fit_estimator(df: DataFrame, features: str = "features", kind: str = "logistic") -> Model:
    """A probabilistic classifier on (features array, y)."""
    return estimator(kind).fit(_vectors(df.filter(F.col("y").isNotNull() & F.col(features).isNotNull()).withColumn("y", F.col("y").cast("double")), features))


def predict(model: Model, df: DataFrame, features: str = "features") -> DataFrame:
    """df with p and p_raw (the score without calibration: the squashed margin, or for forests the share of votes); rows
    without features have null."""
    usable = _vectors(df.filter(F.col(features).isNotNull()), features)
    out = model.transform(usable)
    raw = vector_to_array(F.col("rawPrediction"))
    p_raw = raw[1] / (raw[0] + raw[1]) if isinstance(model, RandomForestClassificationModel) else 1 / (1 + F.exp(-raw[1]))
    return out.withColumns({"p": vector_to_array(F.col("probability"))[1], "p_raw": p_raw}).drop("_v", "rawPrediction", "probability", "prediction")


def oof_scores(df: DataFrame, features: str = "features", k: int = 5, kind: str = "logistic", id_col: str = "compound_id") -> DataFrame:
    """id, y, p, p_raw: p_raw is the score of the model that has not seen the row, p that score calibrated on the raw scores
    of the other folds; folds by hashed id. Falls back to one model of all rows, calibrated on them, where a fold's training
    side lacks a class."""
    folds = df.withColumn("_fold", (F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long") % k).cast("int"))
    sides = {r["_fold"]: (r.n, r.n1) for r in folds.groupBy("_fold").agg(F.count("*").alias("n"), F.sum("y").alias("n1")).collect()}
    n, n1 = sum(s[0] for s in sides.values()), sum(s[1] or 0 for s in sides.values())
    parts = []
    for fold, (m, m1) in sorted(sides.items()):
        if not 0 < n1 - (m1 or 0) < n - m:
            whole = kept(predict(fit_estimator(df, features, kind), df, features).select(id_col, "y", "p_raw"), "raw")
            return calibrated(whole, knots_of(fit_isotonic(whole, []), []), []).select(id_col, "y", "p", "p_raw")
        model = fit_estimator(folds.filter(F.col("_fold") != fold), features, kind)
        parts.append(predict(model, folds.filter(F.col("_fold") == fold), features).select(id_col, "y", "p_raw", "_fold"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cross_calibrated(kept(out, "raw"), "_fold").select(id_col, "y", "p", "p_raw")


def rank_quantile(query: DataFrame, reference: DataFrame, by: list[str] | None = None) -> DataFrame:
    """query with rank_q: the share of reference scores at or below its own, exactly and without collecting either side."""
    by = by or []
    counts = reference.groupBy(*by, "p").agg(F.count("*").alias("_n")).unionByName(query.select(*by, "p").distinct().withColumn("_n", F.lit(0).cast("long")))
    merged = counts.groupBy(*by, "p").agg(F.sum("_n").alias("_n"))
    cum = running(merged, by, "p", ["_n"])
    total = reference.groupBy(*by).agg(F.count("*").alias("_t"))
    shares = (cum.join(F.broadcast(total), by) if by else cum.join(F.broadcast(total))).select(*by, "p", (F.col("cum__n") / F.col("_t")).alias("rank_q"))
    return query.join(shares, [*by, "p"], "left")


def fit_domain(df: DataFrame, features: str = "features", k: int = 8, share: float = 0.05) -> dict:
    """Principal components, their means and deviations on training rows, and the cutoff: the 5th percentile of scores."""
    rows = _vectors(df.filter(F.col(features).isNotNull()), features)
    width = len(rows.select(features).first()[0])
    k = min(k, width)
    pca = PCA(k=k, inputCol="_v", outputCol="_c").fit(rows)
    c = vector_to_array(F.col("_c"))
    got = pca.transform(rows).agg(*(F.avg(c[i]).alias(f"m{i}") for i in range(k)), *(F.stddev_pop(c[i]).alias(f"s{i}") for i in range(k))).first()
    model = {"pca": pca, "mean": [got[f"m{i}"] for i in range(k)], "std": [got[f"s{i}"] or 1.0 for i in range(k)]}
    model["cutoff"] = quantile(score_domain(model, df, features), "ad", share)
    return model


def score_domain(model: dict, df: DataFrame, features: str = "features") -> DataFrame:
    """df with ad: minus the sum of squared standardized components (Mahalanobis distance in the components' space)."""
    out = model["pca"].transform(_vectors(df.filter(F.col(features).isNotNull()), features))
    c = vector_to_array(F.col("_c"))
    terms = [((c[i] - m) / s) ** 2 for i, (m, s) in enumerate(zip(model["mean"], model["std"]))]
    return out.withColumn("ad", -sum(terms[1:], terms[0])).drop("_v", "_c")


def rank_error_curve(df: DataFrame, by: list[str], id_col: str = "compound_id", knots: int = 20) -> DataFrame:
    """by, curve (array of r, e): the mean error |p - y| around up to 20 places, evenly spaced by rank; null below 2 rows.

    The mean over a window of rows is a difference of two running totals, so no task needs a whole descriptor.
    """
    rows = df.filter(F.col("rank_q").isNotNull() & ~F.isnan("rank_q") & F.col("y").isNotNull() & ~F.isnan("p")).select(*by, id_col, "rank_q", F.abs(F.col("p") - F.col("y")).alias("_e"), F.lit(1).alias("_one"))
    cum = running(rows, by, "rank_q", ["_one", "_e"], ties=id_col)
    n = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    nk = F.least(F.lit(knots), F.col("_n")).cast("int")
    places = n.select(*by, "_n", nk.alias("_k"), F.explode(F.sequence(F.lit(0), nk - 1)).alias("_i"))
    at = F.when(F.col("_k") > 1, F.rint(F.col("_i") * (F.col("_n") - 1) / F.when(F.col("_k") > 1, F.col("_k") - 1))).otherwise(0).cast("long")
    hw = F.greatest(F.lit(1), F.floor(F.col("_n") / (2 * F.col("_k"))).cast("long"))
    knot = places.withColumns({"_at": at, "_hw": hw}).withColumns({"_lo": F.greatest(F.col("_at") - F.col("_hw"), F.lit(0)), "_hi": F.least(F.col("_at") + F.col("_hw"), F.col("_n") - 1)})
    # at most 20 knots for each group; the running totals are joined at the three places of each
    need = knot.select(*by, "_i", F.inline(F.array(F.struct(F.lit("lo").alias("_w"), F.col("_lo").alias("_p")), F.struct(F.lit("at").alias("_w"), (F.col("_at") + 1).alias("_p")), F.struct(F.lit("hi").alias("_w"), (F.col("_hi") + 1).alias("_p")))))
    got = need.join(cum.withColumnRenamed("cum__one", "_p"), [*by, "_p"], "left").groupBy(*by, "_i").agg(
        F.max(F.when(F.col("_w") == "lo", F.col("cum__e"))).alias("_el"), F.max(F.when(F.col("_w") == "hi", F.col("cum__e"))).alias("_eh"), F.max(F.when(F.col("_w") == "at", F.col("rank_q"))).alias("r"),
        F.max(F.when(F.col("_w") == "lo", F.col("_p"))).alias("_pl"), F.max(F.when(F.col("_w") == "hi", F.col("_p"))).alias("_ph"),
    )
    e = (F.col("_eh") - F.coalesce("_el", F.lit(0.0))) / (F.col("_ph") - F.col("_pl"))
    curve = got.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_i", "r", e.alias("e")))).alias("c"))
    joined = n.join(curve, by, "left") if by else n.join(F.broadcast(curve))
    return joined.select(*by, F.when(F.col("_n") >= 2, F.transform("c", lambda k: F.struct(k["r"].alias("r"), k["e"].alias("e")))).alias("curve"))


def pool_signals(oof: DataFrame, ad_cutoffs: DataFrame | None = None) -> DataFrame:
    """descriptor, oof_auc, curve, ad_cutoff, n, n_pos from (compound_id, descriptor, y, p, rank_q)."""
    by = ["descriptor"]
    out = oof.groupBy(*by).agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("n_pos"))
    out = out.join(auroc(oof, by).withColumnRenamed("auroc", "oof_auc"), by, "left").join(rank_error_curve(oof, by), by, "left")
    if ad_cutoffs is None:
        return out.withColumn("ad_cutoff", F.lit(None).cast("double"))
    return out.join(ad_cutoffs, by, "left")


def cv_report(oof: DataFrame, train: DataFrame, timings: DataFrame | None = None, id_col: str = "compound_id") -> DataFrame:
    """descriptor, oof_auroc, train_auroc, gap, n, n_pos, prior and the cutoff searched on the out-of-fold scores; with
    timings (descriptor, phase, seconds) the summed seconds of all phases."""
    by = ["descriptor"]
    out = oof.groupBy(*by).agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("n_pos"), F.avg("y").alias("prior"))
    a, b = auroc(oof, by).withColumnRenamed("auroc", "oof_auroc"), auroc(train, by).withColumnRenamed("auroc", "train_auroc")
    out = out.join(a, by, "left").join(b, by, "left").join(cutoffs(oof, by, id_col), by, "left").withColumn("gap", F.col("train_auroc") - F.col("oof_auroc"))
    return out if timings is None else out.join(timings.groupBy(*by).agg(F.sum("seconds").alias("seconds")), by, "left")


def fit_all(tables: dict[str, DataFrame], features: str = "features", kind: str = "logistic") -> tuple[dict[str, Model], dict[str, str]]:
    """Models by descriptor, and the errors of those that failed; an error only when none succeeds."""
    models, errors = {}, {}
    for name, df in tables.items():
        try:
            models[name] = fit_estimator(df, features, kind)
        except Exception as e:
            errors[name] = str(e).splitlines()[0] if str(e) else type(e).__name__
    if tables and not models:
        raise RuntimeError(f"no descriptor could be fitted: {errors}")
    return models, errors


def evaluate(df: DataFrame, task: str = "classification", validation: Column | None = None) -> DataFrame:
    """part, and auroc (0 for a single class) or r2 over rows with truth: of all rows and, where given, of the validation
    rows among them."""
    parts = F.array(F.lit("all")) if validation is None else F.when(validation, F.array(F.lit("all"), F.lit("validation"))).otherwise(F.array(F.lit("all")))
    rows = df.withColumn("part", F.explode(parts))
    if task == "regression":
        return regression_metrics(rows, ["part"]).select("part", "r2")
    return auroc(rows, ["part"]).select("part", F.coalesce("auroc", F.lit(0.0)).alias("auroc"))


def importance_weights(wide: DataFrame, descriptors: list[str]) -> dict[str, float]:
    """Forest importances of stacked scores, by descriptor."""
    rows = wide.select(F.array(*(F.col(f"`{d}`").cast("double") for d in descriptors)).alias("features"), "y")
    model = RandomForestClassifier(numTrees=100, maxDepth=5, seed=SEED, featuresCol="_v", labelCol="y").fit(_vectors(rows.withColumn("y", F.col("y").cast("double")), "features"))
    return dict(zip(descriptors, model.featureImportances.toArray().tolist()))
