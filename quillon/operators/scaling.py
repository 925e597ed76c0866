"""Scaling of feature arrays by a transformer fitted on a reference table.

A transformer is a small table (feature, pos, center, scale, fill, is_constant), one row a feature; it is carried to the
rows as one array, so applying it is a single projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.selection import quantiles
from quillon.functions.shared import kept


def fit_transformer(ref: DataFrame, features: str = "features") -> DataFrame:
    """pos, center (median), scale (interquartile range), fill (median) and is_constant; NaN and null are left out.

    The arrays are written once; each pass of the exact quantiles reads them and counts all features together.
    """
    arrays = kept(ref.select(F.col(features).alias("x")), "arrays")
    out = quantiles(arrays.select(F.posexplode("x").alias("pos", "x")), ["pos"], "x", [0.25, 0.5, 0.75], keep=False, ends=True)
    out = out.withColumn("same", F.col("least") == F.col("greatest"))
    return out.select("pos", F.concat(F.lit("f"), F.col("pos").cast("string")).alias("feature"), F.col("q")[1].alias("center"), (F.col("q")[2] - F.col("q")[0]).alias("scale"), F.col("q")[1].alias("fill"), (F.col("same") | (F.col("q")[2] == F.col("q")[0])).alias("is_constant"))


def feature_differences(transformer: DataFrame, names: list[str]) -> dict[str, list[str]]:
    """Features the matrix lacks, and features the transformer lacks; at most 10 each."""
    known = {r.feature for r in transformer.select("feature").collect()}
    return {"missing": sorted(known - set(names))[:10], "extra": sorted(set(names) - known)[:10]}


def validate_transformer(transformer: DataFrame, names: list[str]) -> None:
    found = feature_differences(transformer, names)
    if found["missing"] or found["extra"]:
        raise ValueError(f"features differ: {found}")


def reorder_features(df: DataFrame, transformer: DataFrame, names: list[str], features: str = "features") -> DataFrame:
    """df with its array in the transformer's order, from arrays in the order of names; an error if the sets differ."""
    validate_transformer(transformer, names)
    order = [r.feature for r in transformer.orderBy("pos").select("feature").collect()]  # a row a feature
    at = F.array(*(F.lit(names.index(n)) for n in order))
    return df.withColumn(features, F.transform(at, lambda i: F.get(F.col(features), i)))


def apply_transformer(df: DataFrame, transformer: DataFrame, features: str = "features") -> DataFrame:
    """df with its feature array scaled: NaN and null filled first, constant features 0, values as float."""
    params = transformer.agg(F.array_sort(F.collect_list(F.struct("pos", "center", "scale", "fill", "is_constant"))).alias("_t"))

    def one(x, t):
        value = F.coalesce(F.when(~F.isnan(x.cast("double")), x.cast("double")), t["fill"])
        return F.when(t["is_constant"], F.lit(0.0)).otherwise((value - t["center"]) / t["scale"]).cast("float")

    return df.join(F.broadcast(params)).withColumn(features, F.zip_with(F.col(features), F.col("_t"), one)).drop("_t")


def save_transformer(transformer: DataFrame, path: str, descriptor: str, version: str) -> None:
    transformer.withColumns({"descriptor": F.lit(descriptor), "version": F.lit(version)}).write.mode("append").partitionBy("descriptor", "version").parquet(path)


def load_transformer(spark, path: str, descriptor: str, version: str) -> DataFrame:
    return spark.read.parquet(path).filter((F.col("descriptor") == descriptor) & (F.col("version") == version)).drop("descriptor", "version")
