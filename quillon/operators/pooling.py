"""Pooling of per-descriptor scores, kept long: (compound_id, descriptor, p, rank_q, ad, p_raw).

A descriptor's weight for an entity joins its skill (out-of-fold AUROC above one half) with its reliability at the entity's
rank; a descriptor for which the entity is outside the applicability domain is vetoed. Weighted logits are summed by one
groupBy on the entity. The signals table has a row a descriptor and is broadcast: its size is that of the model.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.functions.curves import EPS, clip, interpolate, logit, sigmoid
from quillon.functions.selection import quantiles
from quillon.functions.shared import kept

AUXILIARY = ("umap-", "pca-", "tsne-", "_bin", "_rank", "_ad", "_raw")


def stack(scores: DataFrame, family: str = "model") -> DataFrame:
    """Wide form: compound_id and <family>-<descriptor>-clf as float."""
    names = F.concat(F.lit(f"{family}-"), F.col("descriptor"), F.lit("-clf"))
    return scores.withColumn("_n", names).groupBy("compound_id").pivot("_n").agg(F.first("p").cast("float"))


def pred_columns(columns: list[str]) -> list[str]:
    """Prediction columns: those that end in -clf or -reg and are no projection, call, rank, domain or raw column."""
    return [c for c in columns if c.endswith(("-clf", "-reg")) and not any(a in c for a in AUXILIARY)]


def fit_pool(signals: DataFrame) -> DataFrame:
    """The pool model, a row a descriptor: skill, curve, ad_cutoff, and which signals all descriptors have.

    Skill is max(0, oof_auc - 0.5); all 1 if none has any. A signal that any descriptor lacks counts as absent."""
    everyone = Window.partitionBy()  # a row a descriptor, at most ten
    raw = F.greatest(F.coalesce(F.col("oof_auc"), F.lit(0.5)) - 0.5, F.lit(0.0))
    model = signals.withColumn("_raw", raw).withColumn("skill", F.when(F.max("_raw").over(everyone) > 0, F.col("_raw")).otherwise(F.lit(1.0)))
    return model.withColumn("has_curve", F.min(F.col("curve").isNotNull().cast("int")).over(everyone) == 1).drop("_raw")


def save_pool(model: DataFrame, path: str) -> None:
    """The pool model as Parquet, a row a descriptor."""
    model.write.mode("overwrite").parquet(path)


def load_pool(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def signals_present(scores: DataFrame) -> dict[str, bool]:
    """Whether rank, ad and raw scores are there: every descriptor has the column and not all its values are unusable."""
    ok = lambda c: F.max(F.when(F.col(c).isNotNull() & ~F.isnan(c), 1).otherwise(0))
    per = scores.groupBy("descriptor").agg(*(ok(c).alias(c) for c in ("rank_q", "ad", "p_raw")))
    got = per.agg(*(F.min(c).alias(c) for c in ("rank_q", "ad", "p_raw"))).first()
    return {c: bool(got[c]) for c in ("rank_q", "ad", "p_raw")}


def reliability(rank: Column, curve: Column, has_curve: Column) -> Column:
    """1 - the expected error at this rank; 0.5 for no rank; distance from the middle where some descriptor has no curve."""
    by_curve = clip(1 - interpolate(rank, curve), 0.0, 1.0)
    return F.when(rank.isNull() | F.isnan(rank), F.lit(0.5)).when(has_curve, by_curve).otherwise(2 * F.abs(rank - 0.5))


def weights(scores: DataFrame, model: DataFrame, *, use_rank: bool = True, use_ad: bool = True) -> DataFrame:
    """scores with vetoed and w (normalised by entity). Rank counts only together with the domain signal.

    Where every descriptor of an entity is vetoed, skill alone weighs."""
    rows = scores.join(F.broadcast(model.select("descriptor", "skill", "curve", "ad_cutoff", "has_curve")), "descriptor")
    base = F.col("skill")
    if use_ad and use_rank:
        base = 0.5 * F.col("skill") + 0.5 * reliability(F.col("rank_q"), F.col("curve"), F.col("has_curve"))
    out = F.coalesce((F.col("ad") < F.col("ad_cutoff")) & ~F.isnan("ad") & ~F.isnan("ad_cutoff"), F.lit(False)) if use_ad else F.lit(False)
    own = Window.partitionBy("compound_id")
    rows = rows.withColumns({"vetoed": out, "_w": F.when(out, 0.0).otherwise(base)})
    rows = rows.withColumn("_t", F.sum("_w").over(own))
    rows = rows.withColumn("_w", F.when(F.col("_t") > 0, F.col("_w")).otherwise(F.col("skill")))
    rows = rows.withColumn("_t", F.sum("_w").over(own))
    rows = rows.withColumn("_w", F.when(F.col("_t") > 0, F.col("_w")).otherwise(F.lit(1.0)))
    return rows.withColumn("w", F.col("_w") / F.sum("_w").over(own)).drop("_w", "_t", "skill", "curve", "has_curve")


def pool(weighted: DataFrame, *, raw: bool = False, eps: float = EPS, cutoff: float = 0.5) -> DataFrame:
    """compound_id, clf, clf_bin (clf > cutoff), clf_rank, clf_ad and, with raw, clf_raw: one aggregation."""
    has_cut = F.col("ad_cutoff").isNotNull()
    aggs = [sigmoid(F.sum(F.col("w") * logit(F.col("p"), eps))).alias("clf"), F.sum(F.col("w") * F.col("rank_q")).alias("clf_rank"), (1 - F.avg(F.when(has_cut, F.col("vetoed").cast("double")))).alias("clf_ad")]
    if raw:
        aggs.append(F.when(F.count("*") == F.count("p_raw"), sigmoid(F.sum(F.col("w") * logit(F.col("p_raw"), eps)))).alias("clf_raw"))
    out = weighted.groupBy("compound_id").agg(*aggs)
    return out.withColumn("clf_bin", (F.col("clf") > cutoff).cast("int"))


def reconcile(model: DataFrame, scores: DataFrame) -> DataFrame:
    """The model's descriptors that are present now; an error if none is."""
    present = scores.select("descriptor").distinct()
    kept = model.join(present, "descriptor", "left_semi")
    if kept.isEmpty():
        raise ValueError("no trained descriptor is present")
    return kept


def apply_pool(scores: DataFrame, model: DataFrame, **signals: bool) -> DataFrame:
    """Pooled scores by a saved model; descriptors the model lacks are ignored."""
    kept = reconcile(model, scores)
    usable = scores.join(F.broadcast(kept.select("descriptor")), "descriptor", "left_semi")
    return pool(weights(usable, kept, **signals), raw="p_raw" in scores.columns)


def domain_fraction(weighted: DataFrame) -> DataFrame:
    """compound_id, domain: 1 - the share of descriptors with a cutoff that are vetoed; null without any."""
    return weighted.groupBy("compound_id").agg((1 - F.avg(F.when(F.col("ad_cutoff").isNotNull(), F.col("vetoed").cast("double")))).alias("domain"))


def pool_summary(weighted: DataFrame) -> DataFrame:
    """descriptor, vetoes, mean_weight, entities; the row with null descriptor counts entities that all descriptors veto."""
    per = weighted.groupBy("descriptor").agg(F.count_if("vetoed").alias("vetoes"), F.avg("w").alias("mean_weight"), F.count("*").alias("entities"))
    entity = weighted.groupBy("compound_id").agg(F.min(F.col("vetoed").cast("int")).alias("out"))
    whole = entity.agg(F.lit(None).cast("string").alias("descriptor"), F.sum("out").alias("vetoes"), F.lit(None).cast("double").alias("mean_weight"), F.count("*").alias("entities"))
    return per.unionByName(whole)


def tier(use_rank: bool, use_ad: bool) -> str:
    return "skill, reliability and domain" if use_rank and use_ad else "skill and domain" if use_ad else "skill"


def bag_median(scores: DataFrame) -> DataFrame:
    """compound_id, clf: the median over descriptors."""
    return scores.groupBy("compound_id").agg(F.median("p").alias("clf"))


def w_leads(performance: DataFrame, column: str = "perf") -> DataFrame:
    """descriptor, w: 1 - the distance of the performance to its 66th percentile."""
    lead = performance.agg(F.percentile(column, 0.66).alias("_lead"))
    return performance.join(F.broadcast(lead)).select("descriptor", (1 - F.abs(F.col("_lead") - F.col(column))).alias("w"))


def bag_scaling(scores: DataFrame, schemes: list[DataFrame], *, plain: bool = False) -> DataFrame:
    """compound_id, reg: columns scaled by median and IQR, averaged by each scheme (descriptor, w), put back on the pooled
    median and IQR, and averaged over schemes; a scheme whose weights sum to 0 counts all equal. plain: the unweighted mean
    is one scheme more."""
    rows = kept(scores.select("compound_id", "descriptor", "p"), "scores")
    per = quantiles(rows, ["descriptor"], "p", [0.25, 0.5, 0.75], keep=False, name="_q")
    whole = quantiles(rows, [], "p", [0.25, 0.5, 0.75], keep=False, name="_a")
    spread = lambda c: F.when(c[2] - c[0] == 0, 1.0).otherwise(c[2] - c[0])
    scaled = rows.join(F.broadcast(per), "descriptor").join(F.broadcast(whole))
    z = (F.col("p") - F.col("_q")[1]) / spread(F.col("_q")) * (F.col("_a")[2] - F.col("_a")[0]) + F.col("_a")[1]
    rows = scaled.select("compound_id", "descriptor", z.alias("z"))
    parts = [F.avg("z")] if plain else []
    for i, s in enumerate(schemes):
        total = s.agg(F.sum("w").alias("_t"))
        s = s.join(F.broadcast(total)).select("descriptor", F.when(F.col("_t") == 0, F.col("w") + 1).otherwise(F.col("w")).alias(f"w{i}"))
        rows = rows.join(F.broadcast(s), "descriptor", "left")
        parts.append(F.sum(F.col(f"w{i}") * F.col("z")) / F.sum(F.when(F.col("z").isNotNull(), F.col(f"w{i}"))))
    return rows.groupBy("compound_id").agg((reduce(lambda a, b: a + b, parts) / len(parts)).alias("reg"))


def assemble(entities: DataFrame, pooled: DataFrame, mapping: DataFrame) -> DataFrame:
    """Pooled values of every entity, copied to all its input rows."""
    per_entity = entities.select("compound_id").join(pooled, "compound_id", "left")
    return mapping.select("orig_idx", "compound_id").join(per_entity, "compound_id", "left")
