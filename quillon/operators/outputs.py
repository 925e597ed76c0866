"""Output tables: values mapped back to input rows, output, performance, validation and summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.shared import kept
from quillon.operators.metrics import auroc, confusion, performance, with_point_metrics


def map_to_original(values: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each entity's values copied to all its input rows; rows without an entity have nulls."""
    return mapping.select("orig_idx", "compound_id").join(values, "compound_id", "left")


def output_table(inputs: DataFrame, mapping: DataFrame, standard: DataFrame, pooled: DataFrame, scores: DataFrame, descriptors: list[str], *, truth: DataFrame | None = None, projections: DataFrame | None = None, names: list[str] | None = None) -> DataFrame:
    """One row for each input row: input, key, structure, truth, pooled columns, a column a descriptor, x and y a projection.

    Entities are put together once, keyed by compound_id, and mapped to the input rows by one join.
    """
    wide = scores.groupBy("compound_id").pivot("descriptor", descriptors).agg(F.first("p"))
    per = standard.select("compound_id", F.sha2("standard_smiles", 256).alias("key"), F.col("standard_smiles").alias("smiles"))
    if truth is not None:
        per = per.join(truth.select("compound_id", F.col("bin").alias("true_value")), "compound_id", "left")
    per = per.join(pooled, "compound_id", "left").join(wide, "compound_id", "left")
    if projections is not None:
        xy = projections.groupBy("compound_id").pivot("name", names).agg(F.first("x").alias("x"), F.first("y").alias("y"))
        per = per.join(xy, "compound_id", "left")
    rows = inputs.select("orig_idx", F.col("smiles").alias("input_smiles"))
    return rows.join(map_to_original(per, mapping), "orig_idx", "left")


def performance_table(pooled: DataFrame, scores: DataFrame, truth: DataFrame, cutoff: float = 0.5, *, train: DataFrame | None = None) -> DataFrame:
    """A performance row for the pooled score and for each descriptor; none where truth has a single class.

    train: model, compound_id, y, p of the training rows, out of fold; the cutoff of each model is then searched on it."""
    y = truth.select("compound_id", F.col("bin").alias("y"))
    return performance(by_model(pooled, scores).join(y, "compound_id"), ["model"], "compound_id", cutoff, train=train)


def by_model(pooled: DataFrame, scores: DataFrame) -> DataFrame:
    """model, compound_id, p of the pooled score and of each descriptor."""
    return pooled.select("compound_id", F.lit("pooled").alias("model"), F.col("clf").alias("p")).unionByName(scores.select("compound_id", F.col("descriptor").alias("model"), "p"))


def validation_table(metrics: DataFrame, meta: DataFrame, balance: DataFrame) -> DataFrame:
    """strategy, fold, seed, auroc, aupr, num_train, num_test, num_test_1 and test_ratio (the share of positives)."""
    counts = balance.select("fold", F.col("n_train").alias("num_train"), F.col("n_test").alias("num_test"), F.round(F.col("test_rate") * F.col("n_test")).cast("long").alias("num_test_1"), F.col("test_rate").alias("test_ratio"))
    return meta.select("strategy", "fold", "seed").join(metrics.select("fold", "auroc", "aupr"), "fold").join(counts, "fold").select("strategy", "fold", "seed", "auroc", "aupr", "num_train", "num_test", "num_test_1", "test_ratio")


def role_columns(columns: list[str]) -> dict[str, str | None]:
    """Column by role, by exact name."""
    return {r: (r if r in columns else None) for r in ("bin", "clf", "clf_bin", "clf_ad", "clf_rank", "clf_raw")}


def run_summary(data: DataFrame, pooled: DataFrame, weights: DataFrame, descriptors: list[str], used: list[str], tier: str) -> DataFrame:
    """section, name, value (text) of a run: entities and classes, descriptors, weighting tier, the pooled score's AUROC,
    accuracy and MCC over entities with truth, the 4 heaviest descriptors and the 4 most often outside their domain (both
    limits are the feature)."""
    spark = data.sparkSession
    counts = data.agg(F.count("*").alias("entities"), F.count_if(F.col("bin") == 1).alias("active"), F.count_if(F.col("bin") == 0).alias("inactive"))
    a = counts.select(F.inline(F.array(*(F.struct(F.lit("counts").alias("section"), F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in ("entities", "active", "inactive")))))
    b = spark.createDataFrame([("descriptors", d, "used" if d in used else "dropped") for d in descriptors] + [("pooling", "tier", tier)], "section string, name string, value string")
    # a row a descriptor, and a narrow row an entity: what they are made from is read once
    w = kept(weights.groupBy("descriptor").agg(F.avg("w").alias("w"), F.avg(F.col("vetoed").cast("double")).alias("out")), "weights")
    pooled = kept(pooled.select("compound_id", "clf", "clf_bin"), "pooled")
    top = lambda c, s: w.orderBy(F.desc(c), "descriptor").limit(4).select(F.lit(s).alias("section"), F.col("descriptor").alias("name"), F.round(c, 4).cast("decimal(18,4)").cast("string").alias("value"))
    share = pooled.agg(F.avg("clf_bin").alias("x")).select(F.lit("pooling").alias("section"), F.lit("share_active").alias("name"), F.round("x", 4).cast("decimal(18,4)").cast("string").alias("value"))
    known = pooled.select("compound_id", F.col("clf").alias("p"), "clf_bin").join(data.select("compound_id", F.col("bin").alias("y")), "compound_id")
    called = with_point_metrics(confusion(known.drop("p").withColumnRenamed("clf_bin", "p"), [], 1.0))
    quality = auroc(known, []).join(F.broadcast(called.select("accuracy", "mcc")))
    figures = quality.select(F.inline(F.array(*(F.struct(F.lit("quality").alias("section"), F.lit(c).alias("name"), F.round(c, 4).cast("decimal(18,4)").cast("string").alias("value")) for c in ("auroc", "accuracy", "mcc")))))
    return a.unionByName(b).unionByName(share).unionByName(figures).unionByName(top("w", "weights")).unionByName(top("out", "outside"))
