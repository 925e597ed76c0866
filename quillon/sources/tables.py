"""Sources and sinks: CSV inputs with sniffed columns, the feature store's Parquet layout, result files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions.ordered import numbered

SNIFF_ROWS, STRUCTURE_ROWS, STRUCTURE_SHARE = 1_000, 10, 0.8
SPARSE_SHARE, SPARSE_ROWS = 0.8, 100_000


class SchemaError(ValueError):
    """An input whose structure or value column cannot be told."""


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header; columns stay strings until their roles are known (no second pass to infer types)."""
    return spark.read.csv(path, header=True)


def sniff(df: DataFrame, n: int = SNIFF_ROWS) -> DataFrame:
    """The first rows, from which roles are told (the limit is the feature)."""
    return df.limit(n)


def _filled(df: DataFrame) -> list[str]:
    got = df.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in df.columns)).first()
    return [c for c in df.columns if got[c]]


def find_structure_column(sample: DataFrame, is_valid: Callable[[Column], Column]) -> str:
    """The column named like `smiles`, else the one whose first 10 values are mostly valid; an error for none or several."""
    columns = _filled(sample)
    named = [c for c in columns if "smiles" in c.lower()]
    if not named:
        head = sample.limit(STRUCTURE_ROWS)
        got = head.agg(*(F.avg(F.coalesce(is_valid(F.col(f"`{c}`").cast("string")), F.lit(False)).cast("double")).alias(c) for c in columns)).first()
        named = [c for c in columns if (got[c] or 0) > STRUCTURE_SHARE]
    if len(named) != 1:
        raise SchemaError(f"structure columns found: {named}")
    return named[0]


def find_value_column(sample: DataFrame, structure: str) -> str | None:
    """`bin`, else `exp`, else the only column (not an id) whose values are all numbers; an error for several."""
    columns = [c for c in _filled(sample) if c != structure]
    for exact in ("bin", "exp"):
        if exact in columns:
            return exact
    candidates = [c for c in columns if c.lower() != "id" and c != "Unnamed: 0"]
    if not candidates:
        return None
    number = lambda c: F.bool_and(F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`").cast("string").try_cast("double").isNotNull())).alias(c)
    got = sample.agg(*map(number, candidates)).first()
    found = [c for c in candidates if got[c]]
    if len(found) > 1:
        raise SchemaError(f"value columns found: {found}")
    return found[0] if found else None


def resolve_columns(df: DataFrame, value_name: str | None) -> str | None:
    """The column that matches a trained name, trimmed and in any case; None without a match."""
    if value_name is None:
        return None
    found = [c for c in df.columns if c.strip().lower() == value_name.strip().lower()]
    if len(found) > 1:
        raise SchemaError(f"columns that match {value_name}: {found}")
    return found[0] if found else None


def snapshot_input(df: DataFrame, path: str, order: str | None = None) -> DataFrame:
    """The typed input with orig_idx, written once and read by later stages.

    orig_idx is the row's place (from 0) by the numeric column `order`, which must tell rows apart. Without one it is
    distinct, but follows how files are split: only the written copy tells which row has which.
    """
    if order is None:
        rows = df.withColumn("orig_idx", F.monotonically_increasing_id())
    else:
        rows = numbered(df, [], order, order, name="orig_idx").withColumn("orig_idx", F.col("orig_idx") - 1)
    rows.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_features(df: DataFrame, path: str, mode: str = "append") -> None:
    """key, input, features by descriptor and version."""
    df.select("key", "input", "features", "descriptor", "version").write.mode(mode).partitionBy("descriptor", "version").parquet(path)


def read_features(spark: SparkSession, path: str, descriptor: str | None = None, version: str | None = None, *, keys_only: bool = False) -> DataFrame:
    """Partitions are pruned by descriptor and version; keys_only reads no feature column."""
    df = spark.read.parquet(path)
    if descriptor is not None:
        df = df.filter(F.col("descriptor") == descriptor)
    if version is not None:
        df = df.filter(F.col("version") == version)
    return df.select("descriptor", "version", "key", "input") if keys_only else df


def sparsity(df: DataFrame, column: str = "features", rows: int | None = SPARSE_ROWS) -> DataFrame:
    """zeros, values and is_sparse (more than 0.8 zeros) over the first rows (None: all)."""
    part = df.limit(rows) if rows else df
    zeros = F.size(F.filter(column, lambda x: x == 0))
    out = part.agg(F.sum(zeros).alias("zeros"), F.sum(F.size(column)).alias("values"))
    return out.withColumn("is_sparse", F.coalesce(F.col("zeros") > SPARSE_SHARE * F.col("values"), F.lit(False)))


def effective_features(raw: DataFrame | None, treated: DataFrame | None) -> DataFrame | None:
    """Of each descriptor the treated matrix where there is one, else the raw one; a store that is absent has none."""
    if raw is None or treated is None:
        return treated if treated is not None else raw
    return treated.unionByName(raw.join(F.broadcast(treated.select("descriptor").distinct()), "descriptor", "left_anti"))


def feature_info(df: DataFrame, columns: DataFrame) -> DataFrame:
    """descriptor, inputs, features and is_sparse."""
    rows = df.groupBy("descriptor").agg(F.count("*").alias("inputs"), (F.sum(F.size(F.filter("features", lambda x: x == 0))) > SPARSE_SHARE * F.sum(F.size("features"))).alias("is_sparse"))
    return rows.join(columns.groupBy("descriptor").agg(F.count("*").alias("features")), "descriptor", "left")


def write_results(tables: dict[str, DataFrame], path: str) -> None:
    """Result tables as CSV with a header, a folder each; large ones stay in parts."""
    for name, df in tables.items():
        df.write.mode("overwrite").csv(f"{path}/{name}", header=True)


def write_validation(metrics: DataFrame, heldout: DataFrame, summary: DataFrame, path: str) -> None:
    """Per-fold metrics and held-out predictions as CSV, the summary as JSON."""
    write_results({"validation": metrics, "heldout": heldout}, path)
    summary.write.mode("overwrite").json(f"{path}/summary")


def drop_tables(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    """Delete tables below a folder of any file system; the names of those that were there."""
    jvm, gone = spark._jvm, []
    for name in names:
        at = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True):
            gone.append(name)
    return gone


def write_projections(points: DataFrame, manifest: DataFrame, path: str) -> None:
    points.write.mode("overwrite").parquet(f"{path}/projections")
    manifest.write.mode("overwrite").json(f"{path}/projections_manifest")


def write_keys(df: DataFrame, path: str, column: str = "smiles") -> None:
    """The bare list of structures."""
    df.select(column).write.mode("overwrite").csv(path, header=True)


def decode_records(records: Column, names: list[str]) -> Column:
    """An array with an array of doubles for each record of a JSON list, in declared column order; JSON null is NaN."""
    kind = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in names]))
    return F.transform(F.from_json(records, kind), lambda r: F.array(*(F.coalesce(r[n], F.lit(float("nan"))) for n in names)))


def effective_descriptors(done: DataFrame, selected: DataFrame | None) -> DataFrame:
    """The finished descriptors, or of these the selected ones where a selection exists."""
    if selected is None or selected.isEmpty():
        return done
    return done.join(selected.select("descriptor").distinct(), "descriptor", "left_semi")


def store_size(spark: SparkSession, path: str) -> DataFrame:
    """dir, bytes for each sub-folder of a store, and the total (dir null); file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    root = path.split("://")[-1].rstrip("/")
    inside = F.substring_index(F.regexp_replace(F.col("path"), f"^.*{root}/", ""), "/", 1)
    return files.select(inside.alias("dir"), "length").rollup("dir").agg(F.sum("length").alias("bytes"))
