"""Preparation: ids, validity, deduplication, label reconciliation, merges and checks.

Tables are keyed; no operator depends on the order of rows. Every place that orders rows takes an id as the last key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.curves import clip
from quillon.functions.ordered import numbered
from quillon.functions.selection import quantiles
from quillon.functions.shared import kept
from quillon.functions.text import tanimoto

# Symbols that exclude a structure.
METALS = (
    "Sc", "Ti", "V", "Cr", "Mn", "Fe", "Co", "Ni", "Cu", "Ga", "Y", "Zr", "Nb", "Mo", "Tc", "Ru", "Rh", "Pd",
    "Cd", "In", "Sn", "La", "Hf", "Ta", "W", "Re", "Os", "Ir", "Pt", "Au", "Hg", "Tl", "Pb", "Bi", "Po", "Ac",
    "Ce", "Pr", "Nd", "Pm", "Sm", "Eu", "Gd", "Tb", "Dy", "Ho", "Er", "Tm", "Yb", "Lu", "Th", "Pa", "U", "Np",
    "Pu", "Am", "Cm", "Bk", "Cf", "Es", "Fm", "Md", "No", "Lr", "Ge", "Sb",
)
MAX_BORON = 7

# What anonymizing overwrites and drops.
SENSITIVE = ["input-smiles", "smiles", "inchikey"]
PROPERTIES = ["nHBD", "nHBA", "cLogP", "nHeteroAtoms", "RingCount", "nRotatableBonds", "nAromaticBonds", "nAcidicGroup", "nBasicGroup", "AtomicPolarizability", "MolWt", "TPSA"]
PREFIXES = ["umap-", "pca-", "lolp-", "exact_", "sim_", "train_smiles_"]


class LabelError(ValueError):
    """Labels outside the domain, or a class with too few rows."""


def text_key(text: Column) -> Column:
    """What tells texts apart in joins and groups, so that the texts themselves stay where they are: the SHA-256, 32 bytes."""
    return F.unhex(F.sha2(text.cast("string"), 256))


def _first_ids(keyed: DataFrame, key: str, order: str, prefix: str) -> DataFrame:
    """(key, first_idx, compound_id) of rows (key, order): the place by first appearance, zero-padded to the count's width."""
    first = kept(keyed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("first_idx")), "first")
    placed = numbered(first, [], "first_idx", key, name="place", keep=False)
    width = first.agg(F.length(F.count("*").cast("string")).alias("width"))
    number = F.lpad((F.col("place") - 1).cast("string"), 20, "0").substr(F.lit(21) - F.col("width"), F.col("width"))
    return placed.join(F.broadcast(width)).select(key, "first_idx", F.concat(F.lit(prefix), number).alias("compound_id"))


def assign_ids(df: DataFrame, column: str, *, order: str = "orig_idx", prefix: str = "CID") -> DataFrame:
    """(column, first_idx, compound_id) for each distinct value: its place by first appearance, zero-padded to the count's
    width. Where the column is not asked for, it is read once and never shuffled."""
    ids = kept(_first_ids(df.select(text_key(F.col(column)).alias("_key"), order), "_key", order, prefix), "ids")
    held = df.filter(F.col(column).isNotNull()).select(F.col(column), F.col(order).alias("_at"), text_key(F.col(column)).alias("_own"))
    # rows of one value and one place are one; the group keeps the join's partitions
    met = ids.join(held, (F.col("_key") == F.col("_own")) & F.col("first_idx").eqNullSafe(F.col("_at")))
    return met.groupBy("_key", "first_idx", "compound_id").agg(F.min(column).alias(column)).select(column, "first_idx", "compound_id")


def normalize(df: DataFrame, structure: str, value: str | None = None, *, order: str = "orig_idx", more: list[str] | None = None) -> DataFrame:
    """compound_id, smiles and, where there is one, value; as many rows as before. more: further columns that stay.

    Only digests are grouped and joined; the texts are shuffled where smiles is asked for, and not else."""
    key = text_key(F.col(structure))
    ids = kept(_first_ids(df.select(key.alias("_key"), order), "_key", order, "CID").select("_key", "compound_id"), "ids")
    out = df.withColumn("_own", key).join(ids, F.col("_own") == F.col("_key"), "left")
    named = [F.col(value).alias("value")] if value else []
    return out.select(F.col(order).alias("orig_idx"), "compound_id", F.col(structure).alias("smiles"), *named, *(more or []))


def validate(df: DataFrame, is_valid: Callable[[Column], Column], column: str = "smiles") -> DataFrame:
    """df with a column `valid`; no row is lost."""
    return df.withColumn("valid", F.coalesce(is_valid(F.col(column)), F.lit(False)))


def dedupe(df: DataFrame, columns: tuple[str, ...] = ("smiles",)) -> tuple[DataFrame, DataFrame]:
    """From (orig_idx, compound_id, smiles, valid): mapping (every row; nulls if invalid) and unique entities with uniq_idx
    and the columns of their first row.

    Ids are written once, grouped and numbered without the texts; the columns are joined last, to entities alone."""
    rows = kept(df.select("orig_idx", F.when(F.col("valid"), F.col("compound_id")).alias("compound_id")), "rows")
    unique = rows.filter(F.col("compound_id").isNotNull()).groupBy("compound_id").agg(F.min("orig_idx").alias("first_idx"))
    places = numbered(unique, [], "first_idx", "compound_id", name="place").select("compound_id", "first_idx", (F.col("place") - 1).alias("uniq_idx"))
    places = kept(places, "places")
    mapping = rows.join(places.select("compound_id", "uniq_idx"), "compound_id", "left").select("orig_idx", "uniq_idx", "compound_id")
    held = df.filter(F.col("valid")).select(F.col("compound_id").alias("_id"), F.col("orig_idx").alias("_at"), F.struct(*columns).alias("_row"))
    met = places.join(held, (F.col("compound_id") == F.col("_id")) & F.col("first_idx").eqNullSafe(F.col("_at")))
    # rows of one entity and one place are one; the group keeps the join's partitions
    one = met.groupBy("compound_id", "first_idx", "uniq_idx").agg(F.min("_row").alias("_row"))
    return mapping, one.select("compound_id", *(F.col("_row")[c].alias(c) for c in columns), "uniq_idx")


def reconcile_labels(df: DataFrame, task: str = "classification", *, null_label: str = "drop") -> DataFrame:
    """One value for each compound_id: the median; for classification 1 if it is at least 0.5, else 0.

    Null labels are dropped; null_label='negative' counts an entity with any null as class 0.
    """
    medians = df.groupBy("compound_id").agg(F.median("value").alias("value"), F.count_if(F.col("value").isNull()).alias("_nulls"))
    if null_label == "negative":
        medians = medians.withColumn("value", F.when(F.col("_nulls") > 0, None).otherwise(F.col("value")))
    else:
        medians = medians.filter(F.col("value").isNotNull())
    if task == "classification":
        medians = medians.withColumn("value", F.when(F.col("value") >= 0.5, 1.0).otherwise(0.0))
    return medians.select("compound_id", "value")


def labelled_only(df: DataFrame, column: str = "value") -> DataFrame | None:
    """The labelled rows; None if there are none."""
    rows = df.filter(F.col(column).isNotNull())
    return None if rows.isEmpty() else rows


def standardize(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """df with standard_smiles: fn of the structure, or the structure where fn gives null."""
    return df.withColumn("standard_smiles", F.coalesce(fn(F.col("smiles")), F.col("smiles")))


def element_symbols(text: Column) -> Column:
    """Capitalised symbols of a structure string, in order."""
    return F.regexp_extract_all(text, F.lit("([A-Z][a-z]?)"), F.lit(1))


def exclude_by_tokens(text: Column, tokens: list[str] = METALS, max_counts: dict[str, int] | None = None) -> Column:
    """Whether a structure has a listed symbol, or more of a symbol than allowed (7 boron by default)."""
    symbols = element_symbols(text)
    out = F.arrays_overlap(symbols, F.array(*map(F.lit, tokens)))
    for symbol, most in ({"B": MAX_BORON} if max_counts is None else max_counts).items():
        out = out | (F.size(F.filter(symbols, lambda s: s == symbol)) > most)
    return F.coalesce(out, F.lit(False))


def strip_components(text: Column, lists: list[Column], separator: str = r"\.") -> Column:
    """Drop components on each list in turn (all are kept if none would be left), then repeated ones."""
    parts = F.split(text, separator)
    for banned in lists:
        rest = F.filter(parts, lambda p: ~F.array_contains(banned, p))
        parts = F.when(F.size(rest) == 0, parts).otherwise(rest)
    return F.array_join(F.array_distinct(parts), separator.replace("\\", ""))


def class_counts(df: DataFrame, column: str = "bin") -> DataFrame:
    return df.agg(F.count(column).alias("n"), F.count_if(F.col(column) == 1).alias("n_pos"), F.count_if(F.col(column) == 0).alias("n_neg"))


def binarize(df: DataFrame, *, min_class: int | None = 30, strict: bool = True) -> DataFrame | None:
    """df (column value in {0, 0.5, 1}) with bin: above 0 is 1. One pass checks the domain and the class sizes.

    strict=False (predict) skips the class minimum and returns None where the domain check fails.
    """
    got = df.agg(F.count_if(~F.col("value").isin(0.0, 0.5, 1.0)).alias("bad"), F.count_if(F.col("value") > 0).alias("pos"), F.count_if(F.col("value") <= 0).alias("neg")).first()
    if got.bad:
        if not strict:
            return None
        raise LabelError(f"{got.bad} values outside 0, 0.5 and 1")
    if strict and min_class and min(got.pos, got.neg) < min_class:
        raise LabelError(f"{got.pos} positive and {got.neg} negative rows; at least {min_class} of each are needed")
    return df.withColumn("bin", F.when(F.col("value") > 0, 1).when(F.col("value").isNotNull(), 0))


def merge_fit(standard: DataFrame, labels: DataFrame) -> DataFrame:
    """compound_id, smiles (standardized), bin; only labelled entities."""
    return standard.select("compound_id", F.col("standard_smiles").alias("smiles")).join(labels.select("compound_id", "bin"), "compound_id")


def merge_predict(standard: DataFrame, labels: DataFrame | None) -> DataFrame:
    """compound_id, smiles and bin of all entities; no bin column without labels."""
    out = standard.select("compound_id", F.col("standard_smiles").alias("smiles"))
    return out if labels is None else out.join(labels.select("compound_id", "bin"), "compound_id", "left")


def remap(mapping: DataFrame, data: DataFrame) -> DataFrame:
    """mapping with uniq_idx replaced by the entity's place in data (by compound_id); null if it is absent."""
    placed = numbered(data.select("compound_id", F.conv(F.substring(F.md5("compound_id"), 1, 8), 16, 10).cast("double").alias("_h")), [], "_h", "compound_id", name="place")
    return mapping.drop("uniq_idx").join(placed.select("compound_id", (F.col("place") - 1).alias("uniq_idx")), "compound_id", "left").select("orig_idx", "uniq_idx", "compound_id")


def check_structures(df: DataFrame, features: Callable[[Column], Column], *, least: float = 0.6, cap: int = 10_000, share: float = 0.25) -> DataFrame:
    """n, discrepancies and ok from (id, smiles, standard_smiles): rows whose two forms are less similar than `least`.

    A random sample of at most cap rows (by hash) is the reference's rule for this check; no rows pass as ok.
    """
    sample = df.filter(F.col("standard_smiles").isNotNull()).orderBy(F.md5(F.col("id").cast("string"))).limit(cap)
    seen = sample.agg(F.count("*").alias("n"), F.count_if(tanimoto(features(F.col("smiles")), features(F.col("standard_smiles"))) < least).alias("discrepancies"))
    return seen.withColumn("ok", (F.col("n") == 0) | (F.col("discrepancies") < share * F.col("n")))


def label_conflicts(original: DataFrame, reconciled: DataFrame, *, tolerance: float = 0.01) -> DataFrame:
    """Rows of original (compound_id, value) that differ from the reconciled value."""
    joined = original.join(reconciled.select("compound_id", F.col("value").alias("reconciled")), "compound_id")
    return joined.filter(F.abs(F.col("value") - F.col("reconciled")) > tolerance)


def drop_matching(df: DataFrame, keywords: tuple[str, ...] = ("clf", "reg", "value")) -> DataFrame:
    return df.drop(*[c for c in df.columns if any(k in c for k in keywords)])


def repeated_values(df: DataFrame, value: str, *, share: float = 0.01, least: int = 3) -> DataFrame:
    """(value, n) of values that occur more than max(share of all, least) times."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).filter(F.col("n") > F.greatest(share * F.col("total"), F.lit(least))).select(value, "n")


def smooth_repeats(df: DataFrame, value: str, rank_by: str, id_col: str) -> DataFrame:
    """df with `smoothed`: equal values that occur too often are spread halfway to their neighbours, by rank_by.

    Neighbours come from the distinct values; the ends stay within the 1st and 99th percentile.
    """
    hot = repeated_values(df, value).select(F.col(value).alias("_v"), F.col("n").alias("_n"))
    distinct = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("_v")).distinct()
    edges = quantiles(df, [], value, [0.01, 0.99]).select(F.col("q")[0].alias("_p1"), F.col("q")[1].alias("_p99"))
    placed = numbered(distinct, [], "_v", "_v", name="_i")
    mine = placed.join(F.broadcast(hot), "_v")  # at most 100 values, for each holds a hundredth of the rows
    beside = lambda step, name: placed.select((F.col("_i") + step).alias("_i"), F.col("_v").alias(name))
    near = mine.join(beside(1, "_lo"), "_i", "left").join(beside(-1, "_hi"), "_i", "left").drop("_i")
    # rows of hot values alone are ranked, dealt to buckets by rank_by; the others pass by
    of_hot = df.join(F.broadcast(near), F.col(value) == F.col("_v")).join(F.broadcast(edges))
    spread = numbered(of_hot, ["_v"], rank_by, id_col, name="_place")
    lo = F.greatest((F.coalesce("_lo", F.col(value)) + F.col(value)) / 2, F.least(F.col("_p1"), F.col(value)))
    hi = F.least((F.coalesce("_hi", F.col(value)) + F.col(value)) / 2, F.greatest(F.col("_p99"), F.col(value)))
    moved = spread.withColumn("smoothed", lo + (hi - lo) * (F.col("_place") - 0.5) / F.col("_n")).select(*df.columns, "smoothed")
    return moved.unionByName(df.join(F.broadcast(hot), F.col(value) == F.col("_v"), "left_anti").withColumn("smoothed", F.col(value)))


def spread_bounds(rest: DataFrame, value: str, repeats: list[float], *, tail: float = 0.05, edge: float = 0.01) -> dict[float, tuple[float, float]]:
    """The interval that each repeated value is spread over, by the values that are not repeated.

    Within the middle (1 - 2 * tail) of them: from the (1 - edge) quantile of those below to the edge quantile of those
    above. In the lower tail: as far below the value as the edge quantile of those above is above it, to the value; in the
    upper tail from the value to as far above it as the edge quantile of those below is below. A side without values ends
    at the value. All quantiles are found together, as places in the order of the whole."""
    below = rest.agg(F.count("*").alias("n"), *(F.count_if(F.col(value) < r).alias(f"b{i}") for i, r in enumerate(repeats))).first()
    n = below["n"]
    places = {"low": tail * (n - 1), "high": (1 - tail) * (n - 1)}
    for i in range(len(repeats)):
        b = below[f"b{i}"]
        places |= {("over", i): b + edge * (n - b - 1), ("under", i): (1 - edge) * (b - 1), ("first", i): edge * (b - 1)}
    if n == 0:
        return {r: (r, r) for r in repeats}
    shares = [min(max(p / (n - 1), 0.0), 1.0) if n > 1 else 0.0 for p in places.values()]
    at = dict(zip(places, quantiles(rest, [], value, shares).first()["q"], strict=True))
    out = {}
    for i, r in enumerate(repeats):
        b = below[f"b{i}"]
        over, under, first = at["over", i] if b < n else r, at["under", i] if b else r, at["first", i] if b else r
        out[r] = (r - (over - r), r) if r < at["low"] else (r, r + (r - first)) if r > at["high"] else (under, over)
    return out


def hash_normal(key: Column) -> Column:
    """A number that is drawn from the normal distribution by the key's hash."""
    u = (F.conv(F.substring(F.md5(key.cast("string")), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)
    return normal_quantile(u)


def smooth_by_model(df: DataFrame, value: str, features: str, id_col: str, *, kind: str = "forest", noise: float = 1e-6) -> DataFrame:
    """df with `smoothed`: rows of a value that occurs too often are spread evenly over its interval (see spread_bounds), in
    the order that a model predicts from their features (ties by id); then every value has a little noise.

    The model learns the uniform quantile of the values that are not repeated. noise: its deviation, as a share of that of
    the smoothed values; drawn by hash, so it is the same on any cluster. kind: forest or linear. Repeated values are at most
    100, for each holds a hundredth of the rows."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor

    rows = kept(df, "rows")
    hot = [r[0] for r in repeated_values(rows, value).select(F.col(value).cast("double")).orderBy(value).collect()]
    often = F.coalesce(F.col(value).cast("double").isin(hot), F.lit(False))
    smoothed = rows.withColumn("smoothed", F.col(value).cast("double"))
    rest = rows.filter(~often & F.col(value).isNotNull() & F.col(features).isNotNull())
    knots = fit_quantiles(rest, value) if hot else []
    if knots:
        common = {"featuresCol": "_v", "labelCol": "_u"}
        learner = RandomForestRegressor(numTrees=100, maxDepth=5, seed=42, **common) if kind == "forest" else LinearRegression(regParam=0.0, solver="normal", **common)
        vectors = lambda t: t.withColumn("_v", array_to_vector(features))
        model = learner.fit(vectors(rest.withColumn("_u", apply_quantiles(F.col(value).cast("double"), knots))))
        bounds = spread_bounds(rows.filter(~often & F.col(value).isNotNull()), value, hot)
        table = rows.sparkSession.createDataFrame([(r, *b) for r, b in bounds.items()], "_r double, _lo double, _hi double")
        guess = model.transform(vectors(rows.filter(often & F.col(features).isNotNull()))).drop("_v").withColumnRenamed("prediction", "_guess")
        none = rows.filter(often & F.col(features).isNull()).withColumn("_guess", F.lit(float("-inf")))
        placed = numbered(guess.unionByName(none), [value], "_guess", id_col, name="_place")
        counts = placed.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
        spread = placed.join(F.broadcast(counts), F.col(value) == F.col("_value")).join(F.broadcast(table), F.col(value).cast("double") == F.col("_r"))
        even = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_place") - 1) / F.greatest(F.col("_n") - 1, F.lit(1))
        smoothed = smoothed.filter(~often).unionByName(spread.select(*rows.columns, even.alias("smoothed")))
    smoothed = kept(smoothed, "smoothed")
    spread_of = smoothed.agg(F.coalesce(F.stddev_pop("smoothed"), F.lit(0.0)).alias("_std"))
    return smoothed.join(F.broadcast(spread_of)).withColumn("smoothed", F.col("smoothed") + noise * F.col("_std") * hash_normal(F.col(id_col))).drop("_std")


def yeo_johnson(x: Column, lam: float) -> Column:
    """The power transform of one value."""
    up = F.ln(1 + x) if abs(lam) < 1e-9 else (F.power(1 + x, F.lit(lam)) - 1) / lam
    down = -F.ln(1 - x) if abs(lam - 2) < 1e-9 else -(F.power(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(x >= 0, up).otherwise(down)


def fit_power(df: DataFrame, column: str, grid: int = 81) -> dict[str, float]:
    """The exponent (from a grid on [-4, 4]) of greatest likelihood, and mean and deviation after it: one pass over df."""
    x = F.col(column)
    lams = [round(-4 + 8 * i / (grid - 1), 6) for i in range(grid)]
    aggs = [F.var_pop(yeo_johnson(x, lam)).alias(f"v{i}") for i, lam in enumerate(lams)] + [F.avg(yeo_johnson(x, lam)).alias(f"m{i}") for i, lam in enumerate(lams)]
    got = df.filter(x.isNotNull() & ~F.isnan(x)).agg(*aggs, F.sum(F.signum(x) * F.ln(1 + F.abs(x))).alias("logs"), F.count("*").alias("n")).first()
    import math

    if not got.n:
        return {"lambda": 1.0, "mean": 0.0, "std": 1.0}
    best = max(range(grid), key=lambda i: -0.5 * got.n * math.log(max(got[f"v{i}"] or 0, 1e-300)) + (lams[i] - 1) * got.logs if math.isfinite(got[f"v{i}"] or 0) else -math.inf)
    return {"lambda": lams[best], "mean": got[f"m{best}"], "std": math.sqrt(got[f"v{best}"]) or 1.0}


def apply_power(x: Column, model: dict[str, float]) -> Column:
    return (yeo_johnson(x, model["lambda"]) - model["mean"]) / model["std"]


def inverse_power(y: Column, model: dict[str, float]) -> Column:
    """What apply_power was given."""
    lam, z = model["lambda"], y * model["std"] + model["mean"]
    up = F.exp(z) - 1 if abs(lam) < 1e-9 else F.power(z * lam + 1, F.lit(1 / lam)) - 1
    down = 1 - F.exp(-z) if abs(lam - 2) < 1e-9 else 1 - F.power(1 - z * (2 - lam), F.lit(1 / (2 - lam)))
    return F.when(z >= 0, up).otherwise(down)


def fit_quantiles(df: DataFrame, column: str, knots: int = 101) -> list[float]:
    """Exact quantiles at evenly spaced shares."""
    got = quantiles(df, [], column, [i / (knots - 1) for i in range(knots)]).first()
    return list(got["q"]) if got else []


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _share_below(x: Column, knots: list[float]) -> Column:
    n = len(knots) - 1
    at = F.array(*map(F.lit, knots))

    def linear(below: Column) -> Column:
        lo, hi = F.get(at, below - 1), F.get(at, below)
        return F.when(below == 0, 0.0).when(below > n, 1.0).otherwise((below - 1 + (x - lo) / (hi - lo)) / n)

    return F.when(x.isNotNull(), _bound(F.size(F.filter(at, lambda k: k <= x)), linear))


def _as_normal(u: Column) -> Column:
    return _bound(u, lambda v: normal_quantile(clip(v, 1e-7, 1 - 1e-7)))


def apply_quantiles(x: Column, knots: list[float], dist: str = "uniform") -> Column:
    """Share of the fitted distribution below x (linear between knots); for 'normal' its normal quantile."""
    u = _share_below(x, knots)
    return u if dist == "uniform" else _as_normal(u)


def inverse_quantiles(u: Column, knots: list[float]) -> Column:
    n = len(knots) - 1
    at = F.array(*map(F.lit, knots))
    i = F.least(F.floor(u * n).cast("int"), F.lit(n - 1))
    lo, hi = F.get(at, i), F.get(at, i + 1)
    return lo + (hi - lo) * (u * n - i)


def normal_quantile(u: Column) -> Column:
    """Inverse of the normal distribution function (Winitzki's inverse error function; within 0.01)."""
    x = 2 * u - 1
    a = 0.147
    log = F.ln(F.greatest(1 - x * x, F.lit(1e-300)))
    first = 2 / (3.141592653589793 * a) + log / 2
    return F.signum(x) * F.sqrt(F.sqrt(first * first - log / a) - first) * (2**0.5)


def label_variants(df: DataFrame, value: str, power: dict[str, float], knots: list[float]) -> DataFrame:
    """df with power, uniform and normal variants of the value side by side, by saved fits."""
    x = F.col(value)
    out = df.withColumns({"raw": x, "power": apply_power(x, power), "uniform": apply_quantiles(x, knots)})
    return out.withColumn("normal", _as_normal(F.col("uniform")))


def inverse_variants(df: DataFrame, variants: dict[str, Column]) -> DataFrame:
    """df with each named variant back on the label's scale: columns made by inverse_power or inverse_quantiles."""
    return df.withColumns({f"{name}_label": back for name, back in variants.items()})


def label_column(task: str, columns: list[str]) -> str | None:
    """`bin` for classification, `val` for regression; None if absent."""
    name = {"classification": "bin", "regression": "val"}[task]
    return name if name in columns else None


def anonymize(df: DataFrame) -> DataFrame:
    """Structures and keys overwritten with NA; property and similarity columns dropped."""
    dropped = [c for c in df.columns if c in PROPERTIES or any(c.startswith(p) for p in PREFIXES)]
    return df.drop(*dropped).withColumns({c: F.lit("NA") for c in SENSITIVE if c in df.columns})


def blank_summary(df: DataFrame, order: str) -> DataFrame:
    """A summary whose first two rows (by order) show NA in all but the first column."""
    first = df.orderBy(order).limit(2).select(F.col(order).alias("_o"))
    marked = df.join(F.broadcast(first.withColumn("_hit", F.lit(True))), F.col(order) == F.col("_o"), "left")
    hide = [c for c in df.columns[1:]]
    return marked.withColumns({c: F.when(F.col("_hit"), "NA").otherwise(F.col(c).cast("string")) for c in hide}).drop("_o", "_hit")


def retained(outputs: list[str], mode: str, *, intermediate: set[str], models: set[str]) -> list[str]:
    """The tables to drop at the end: intermediate ones, and at predict the run's own feature and model copies."""
    gone = set(intermediate) | ({o for o in outputs if o in models} if mode == "predict" else set())
    return [o for o in outputs if o in gone]
