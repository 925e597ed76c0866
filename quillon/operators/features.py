"""Feature computation and the feature store: keyed tables (descriptor, version, key, input, features)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.shared import kept
from quillon.functions.text import store_key, symbol_ratio

MAX_DESCRIPTORS, MAX_PROJECTIONS = 10, 3
#: Type names that count as numeric.
NUMERIC = ("int", "integer", "float", "float32", "float64", "numeric", "double")


class FeatureError(RuntimeError):
    """A feature table that does not fit what was asked for."""


def featurize(df: DataFrame, fn: Callable[[list[str]], list], *, width: int, descriptor: str, version: str, batch: int = 1_000, fallback: Callable[[list[str]], list] | None = None) -> DataFrame:
    """key, input, features, ok for each smiles of df, by fn (a batch of structures -> a list of equally long vectors).

    A batch that fails is halved until single rows; a row that fails alone gets null features. The first failure in a
    partition switches it to `fallback`, where one is given. Batches are the only Python in the plan (Arrow).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = {"fn": fn}

        def attempt(values: list[str]) -> list:
            try:
                out = state["fn"](values)
                if len(out) != len(values) or any(x is None or len(x) != width for x in out):
                    raise ValueError("wrong shape")
                return [list(map(float, x)) for x in out]
            except Exception:
                if fallback is not None and state["fn"] is fn:
                    state["fn"] = fallback
                    return attempt(values)
                if len(values) == 1:
                    return [None]
                half = len(values) // 2
                return attempt(values[:half]) + attempt(values[half:])

        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                got = attempt(part["input"].tolist())
                yield pd.DataFrame({"key": part["key"].values, "input": part["input"].values, "features": got, "ok": [g is not None for g in got]})

    rows = df.select(store_key(F.col("smiles")).alias("key"), F.col("smiles").alias("input")).filter(F.col("input").isNotNull())
    out = rows.mapInPandas(run, "key string, input string, features array<float>, ok boolean")
    return out.withColumns({"descriptor": F.lit(descriptor), "version": F.lit(version)})


def featurize_whole(df: DataFrame, fn: Callable[[list[str]], list], fallback: Callable[[list[str]], list], *, width: int, descriptor: str, version: str, batch: int = 1_000) -> DataFrame:
    """As featurize, but one function makes all rows: a batch that fails in any partition switches the whole table to
    `fallback`, computed anew from the stored structures; batches that fail there are halved down to the failing rows.

    Two jobs at most: the first stores what `fn` makes, and a partition stops at its first failure with a mark."""
    inputs = kept(df.select("smiles").filter(F.col("smiles").isNotNull()), "structures")

    def strict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                try:
                    got = [list(map(float, x)) for x in fn(part["input"].tolist())]
                    whole = len(got) == len(part) and all(len(x) == width for x in got)
                except Exception:
                    whole = False
                if not whole:
                    yield pd.DataFrame({"key": [None], "input": [None], "features": [None], "ok": [False]})
                    return
                yield pd.DataFrame({"key": part["key"].values, "input": part["input"].values, "features": got, "ok": True})

    keyed = inputs.select(store_key(F.col("smiles")).alias("key"), F.col("smiles").alias("input"))
    first = kept(keyed.mapInPandas(strict, "key string, input string, features array<float>, ok boolean"), "features")
    if first.filter(~F.col("ok")).isEmpty():
        return first.withColumns({"descriptor": F.lit(descriptor), "version": F.lit(version)})
    return featurize(inputs, fallback, width=width, descriptor=descriptor, version=version, batch=batch)


def properties(df: DataFrame, fns: dict[str, Callable[[Column], Column]] | None = None, *, structure: str = "smiles", digits: int = 4) -> DataFrame:
    """df with a column for each named property of its structure, rounded; NaN where the structure is null or has none.

    By default the text's length and its share of symbols."""
    fns = fns or {"length": F.length, "symbols": symbol_ratio}
    value = lambda fn: F.coalesce(F.round(fn(F.col(structure)).cast("double"), digits), F.lit(float("nan")))
    return df.withColumns({name: value(fn) for name, fn in fns.items()})


def assert_any_ok(features: DataFrame) -> None:
    """An error if rows were computed and none succeeded."""
    got = features.agg(F.count("*").alias("n"), F.count_if("ok").alias("ok")).first()
    if got.n and not got.ok:
        raise FeatureError("no row could be featurized")


def stored(df: DataFrame, store: DataFrame) -> DataFrame:
    """Rows of df (key) that the store has."""
    return df.join(store.select("key").distinct(), "key", "left_semi")


def absent(df: DataFrame, store: DataFrame) -> DataFrame:
    return df.join(store.select("key").distinct(), "key", "left_anti")


def read_through(df: DataFrame, store: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(all, new): features of every row of df (key, smiles), read where stored and computed elsewhere; rows that neither
    gives have null features. `new` is what contribute() appends; it is computed once, into the shared folder."""
    wanted = df.withColumn("key", store_key(F.col("smiles")))
    new = kept(compute(absent(wanted, store)), "computed")
    have = store.select("key", "features").dropDuplicates(["key"]).unionByName(new.select("key", "features").dropDuplicates(["key"]))
    return wanted.join(have, "key", "left"), new


def read_subset(store: DataFrame, inputs: DataFrame) -> DataFrame:
    """Stored features for the requested inputs (one row for each request), repeated inputs in the store read once."""
    return inputs.join(store.dropDuplicates(["input"]).select("input", "features"), "input", "left")


def contribute(new: DataFrame, path: str) -> int:
    """Append newly computed rows to the store; returns how many (0 writes nothing)."""
    usable = new.filter("ok") if "ok" in new.columns else new
    n = usable.count()
    if n:
        usable.select("key", "input", "features", "descriptor", "version").write.mode("append").partitionBy("descriptor", "version").parquet(path)
    return n


def coverage(wanted: DataFrame, project: DataFrame, lake: DataFrame) -> DataFrame:
    """descriptor, n, in_project, in_lake (not in the project), to_compute and pct_stored; inputs are (descriptor, key)."""
    p = project.select("descriptor", "key").distinct().withColumn("_p", F.lit(1))
    k = lake.select("descriptor", "key").distinct().withColumn("_l", F.lit(1))
    rows = wanted.select("descriptor", "key").distinct().join(p, ["descriptor", "key"], "left").join(k, ["descriptor", "key"], "left")
    out = rows.groupBy("descriptor").agg(F.count("*").alias("n"), F.count("_p").alias("in_project"), F.count_if(F.col("_p").isNull() & F.col("_l").isNotNull()).alias("in_lake"))
    return out.withColumns({"to_compute": F.col("n") - F.col("in_project") - F.col("in_lake"), "pct_stored": 100.0 * (F.col("in_project") + F.col("in_lake")) / F.col("n")})


def migrate(wanted: DataFrame, lake: DataFrame, project: DataFrame) -> DataFrame:
    """Lake rows (descriptor, key, ...) that are wanted and not yet in the project; empty when run again."""
    keys = ["descriptor", "key"]
    return lake.join(wanted.select(*keys).distinct(), keys, "left_semi").join(project.select(*keys).distinct(), keys, "left_anti").dropDuplicates(keys)


def version_mismatch(wanted: DataFrame, store: DataFrame) -> DataFrame:
    """descriptor, version, others: wanted descriptors that the store holds only under other versions."""
    held = store.groupBy("descriptor").agg(F.array_sort(F.collect_set("version")).alias("others"))
    return wanted.join(held, "descriptor").filter(~F.array_contains("others", F.col("version"))).select("descriptor", "version", "others")


def check_versions(wanted: DataFrame, store: DataFrame) -> None:
    bad = version_mismatch(wanted, store).limit(10).collect()
    if bad:
        raise FeatureError(f"held only under other versions: {[(r.descriptor, r.version, r.others) for r in bad]}")


def version_as_of(tags: DataFrame, local: DataFrame) -> DataFrame:
    """descriptor, version: v<major> of the latest semantic tag updated by the local time; v1 if there is none.

    tags: descriptor, tag, last_updated (ISO text), digest; local: descriptor, digest. The local time is the latest update
    among tags with the local digest. Everything is grouped by descriptor: no range join.
    """
    major = F.regexp_extract("tag", r"^v?(\d+)\.\d+\.\d+$", 1)
    mine = local.select("descriptor", F.col("digest").alias("_mine"))
    rows = tags.join(mine, "descriptor", "right")
    local_time = rows.filter(F.col("digest") == F.col("_mine")).groupBy("descriptor").agg(F.max("last_updated").alias("_t"))
    timed = rows.join(local_time, "descriptor", "left")
    usable = F.when((major != "") & (F.col("last_updated") <= F.col("_t")), F.struct("last_updated", major.cast("int").alias("major")))
    return timed.groupBy("descriptor").agg(F.max(usable).alias("_m")).select("descriptor", F.concat(F.lit("v"), F.coalesce(F.col("_m.major"), F.lit(1)).cast("string")).alias("version"))


def pin_versions(wanted: DataFrame, pins: DataFrame, resolved: DataFrame) -> DataFrame:
    """descriptor, version: the pin of an earlier stage, else the resolved version, else v1."""
    a, b = pins.select("descriptor", F.col("version").alias("_p")), resolved.select("descriptor", F.col("version").alias("_r"))
    return wanted.select("descriptor").distinct().join(a, "descriptor", "left").join(b, "descriptor", "left").select("descriptor", F.coalesce("_p", "_r", F.lit("v1")).alias("version"))


def matrix_dtype(columns: DataFrame) -> DataFrame:
    """descriptor, dtype: float if any declared column is, else int; and the declared width."""
    return columns.groupBy("descriptor").agg(F.when(F.max(F.lower("type").rlike("float|double|numeric").cast("int")) == 1, "float").otherwise("int").alias("dtype"), F.count("*").alias("width"))


def check_roles(columns: DataFrame, role: str = "features") -> DataFrame:
    """descriptor, ok: all types numeric; projections also need an even number of columns, at least 2."""
    out = columns.groupBy("descriptor").agg((F.min(F.lower("type").isin(*NUMERIC).cast("int")) == 1).alias("ok"), F.count("*").alias("n"))
    if role == "projections":
        out = out.withColumn("ok", F.col("ok") & (F.col("n") >= 2) & (F.col("n") % 2 == 0))
    return out.select("descriptor", "ok")


def check_counts(descriptors: list[str], projections: list[str]) -> None:
    if len(descriptors) > MAX_DESCRIPTORS or len(projections) > MAX_PROJECTIONS:
        raise FeatureError(f"at most {MAX_DESCRIPTORS} descriptors and {MAX_PROJECTIONS} projections")


def pair_projections(df: DataFrame, id_col: str = "compound_id") -> DataFrame:
    """compound_id, name, x, y: columns grouped by the text before the first _; groups of fewer than two are skipped."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        if c != id_col:
            groups.setdefault(c.split("_", 1)[0], []).append(c)
    pairs = [(g, c[0], c[1]) for g, c in groups.items() if len(c) >= 2]
    rows = F.array(*(F.struct(F.lit(g).alias("name"), F.col(f"`{x}`").cast("double").alias("x"), F.col(f"`{y}`").cast("double").alias("y")) for g, x, y in pairs))
    return df.select(F.col(id_col).alias("compound_id"), F.inline(rows))


def provenance(counts: DataFrame) -> DataFrame:
    """descriptor, n_total, n_from_store, n_computed, pct_reused; the row with null descriptor is the total."""
    out = counts.rollup("descriptor").agg(*(F.sum(c).alias(c) for c in ("n_total", "n_from_store", "n_computed")))
    return out.withColumn("pct_reused", F.when(F.col("n_total") > 0, 100.0 * F.col("n_from_store") / F.col("n_total")).otherwise(0.0))


def missing_transformers(wanted: DataFrame, library: DataFrame) -> DataFrame:
    return wanted.join(library.select("descriptor", "version").distinct(), ["descriptor", "version"], "left_anti").select("descriptor", "version")


def matrix_extent(entities: DataFrame, features: DataFrame, columns: DataFrame) -> DataFrame:
    """n, width: entities and feature columns over all declared descriptors; width is null if one has no matrix."""
    have = features.select("descriptor").distinct().withColumn("_h", F.lit(1))
    per = columns.groupBy("descriptor").agg(F.count("*").alias("w")).join(have, "descriptor", "left")
    width = per.agg(F.when(F.count("*") == F.count("_h"), F.sum("w")).alias("width"))
    return entities.agg(F.count("*").alias("n")).join(F.broadcast(width))
