"""The bagger: an ensemble of per-descriptor scores (compound_id, descriptor, p), fitted once and applied to new rows.

Modes for classes: `median` (nothing is fitted), `model` (a logistic fit of each descriptor, then the median) and
`weighting` (power transform and logistic fit of each descriptor, then the mean of weighted means, one for each scheme of
weights and a plain one). For numbers: `scaling`, `median` and `model` (a line of each descriptor, then the mean).
What a fit keeps has a row a descriptor; rows are never collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.curves import sigmoid
from quillon.functions.shared import kept
from quillon.operators.estimate import importance_weights
from quillon.operators.logistic import fit_lines
from quillon.operators.metrics import auroc, regression_metrics
from quillon.operators.pooling import apply_pool, bag_median, bag_scaling, w_leads

BY = ["descriptor"]
#: The exponents that are tried.
LAMBDAS = [round(-4 + 0.1 * i, 1) for i in range(81)]
#: Rows of a partition in a forest's fit.
FOREST_ROWS = 10_000


def power_of(x: Column, lam: Column) -> Column:
    """The Yeo-Johnson transform by an exponent that is a column."""
    up = F.when(F.abs(lam) < 1e-9, F.log1p(x)).otherwise((F.power(1 + x, lam) - 1) / F.when(F.abs(lam) < 1e-9, 1.0).otherwise(lam))
    other = 2 - lam
    down = F.when(F.abs(other) < 1e-9, -F.log1p(-x)).otherwise(-(F.power(1 - x, other) - 1) / F.when(F.abs(other) < 1e-9, 1.0).otherwise(other))
    return F.when(x >= 0, up).otherwise(down)


def fit_powers(df: DataFrame, by: list[str], x: str) -> DataFrame:
    """by, lambda, mean, std: the exponent of greatest likelihood for each group, mean and deviation after it; one pass."""
    v = F.col(x).cast("double")
    usable = df.filter(v.isNotNull() & ~F.isnan(v)).select(*by, v.alias("_v"), (F.signum(v) * F.log1p(F.abs(v))).alias("_log"))
    each = F.explode(F.array(*map(F.lit, LAMBDAS))).alias("lambda")
    # every row meets every exponent where it is read; one row a group and exponent is shuffled by a task
    met = usable.select(*by, "_v", "_log", each).withColumn("_t", power_of(F.col("_v"), F.col("lambda")))
    fits = met.groupBy(*by, "lambda").agg(F.var_pop("_t").alias("var"), F.avg("_t").alias("mean"), F.sum("_log").alias("logs"), F.count("*").alias("n"))
    likelihood = F.round(-0.5 * F.col("n") * F.ln(F.greatest("var", F.lit(1e-300))) + (F.col("lambda") - 1) * F.col("logs"), 6)
    best = fits.groupBy(*by).agg(F.max_by(F.struct("lambda", "mean", "var"), F.struct(likelihood, "lambda")).alias("b"))
    return best.select(*by, F.col("b.lambda").alias("lambda"), F.col("b.mean").alias("mean"), F.when(F.col("b.var") > 0, F.sqrt("b.var")).otherwise(1.0).alias("std"))


def powered(df: DataFrame, powers: DataFrame, by: list[str], x: str) -> DataFrame:
    """df with x transformed and standardized by its group's fit; groups without one are left out."""
    z = (power_of(F.col(x).cast("double"), F.col("lambda")) - F.col("mean")) / F.col("std")
    return df.join(F.broadcast(powers), by).withColumn(x, z).drop("lambda", "mean", "std")


@dataclass
class Bag:
    """A fitted bagger: tables with a row a descriptor and weights by scheme."""

    mode: str
    task: str = "classification"
    powers: DataFrame | None = None
    lines: DataFrame | None = None
    schemes: list[dict[str, float]] = field(default_factory=list)


def lead_weights(train: DataFrame, task: str = "classification") -> dict[str, float]:
    """Each descriptor's weight by the distance of its AUROC (or R2) to the 66th percentile."""
    skill = auroc(train, BY).withColumnRenamed("auroc", "perf") if task == "classification" else regression_metrics(train, BY).withColumnRenamed("r2", "perf")
    return {r["descriptor"]: float(r["w"]) for r in w_leads(skill, "perf").collect() if r["w"] is not None}


def forest_weights(train: DataFrame) -> dict[str, float]:
    """Each descriptor's share of a forest's importance, over entities that have all scores.

    A forest draws by partition and place: rows are dealt and ordered by id, into as many partitions as their number asks
    for, so that it repeats on any cluster."""
    names = sorted(r["descriptor"] for r in train.select("descriptor").distinct().collect())
    own = [F.first(F.when(F.col("descriptor") == n, F.col("p")), ignorenulls=True).alias(n) for n in names]
    wide = kept(train.groupBy("compound_id").agg(*own, F.max("y").alias("y")).dropna(), "wide")
    dealt = wide.repartition(max(1, -(-wide.count() // FOREST_ROWS)), "compound_id").sortWithinPartitions("compound_id")
    return importance_weights(dealt, names)


def fit_bag(train: DataFrame, mode: str = "weighting", task: str = "classification", *, penalty: float = 1.0, schemes: list[dict[str, float]] | None = None) -> Bag:
    """Learn from (compound_id, descriptor, p, y). schemes: weights given instead of those by lead distance and forest."""
    allowed = {"classification": ("weighting", "median", "model"), "regression": ("scaling", "median", "model")}[task]
    if mode not in allowed:
        raise ValueError(f"{task} has the modes {allowed}, not {mode!r}")
    bag = Bag(mode, task)
    if mode in ("weighting", "scaling"):
        bag.schemes = [lead_weights(train, task), *([forest_weights(train)] if task == "classification" else [])] if schemes is None else schemes
    if mode == "weighting":
        bag.powers = kept(fit_powers(train, BY, "p"), "powers")
        bag.lines = fit_lines(powered(train, bag.powers, BY, "p"), BY, "p", "y", penalty=penalty)
    elif mode == "model" and task == "classification":
        bag.lines = fit_lines(train, BY, "p", "y", penalty=penalty)
    elif mode == "model":
        bag.lines = train.groupBy("descriptor").agg(F.regr_slope("y", "p").alias("slope"), F.regr_intercept("y", "p").alias("intercept"))
    return bag


def weighted_mean(rows: DataFrame, schemes: list[dict[str, float]], value: str, name: str) -> DataFrame:
    """compound_id and the mean over schemes, and the plain one, of each entity's weighted mean; weights that sum to 0 count
    all equal; a descriptor that a scheme does not name weighs nothing in it."""
    means = [F.avg(value)]
    for s in schemes:
        level = 1.0 if sum(s.values()) == 0 else 0.0
        w = F.coalesce(F.create_map(*[F.lit(x) for k, v in s.items() for x in (k, float(v) + level)])[F.col("descriptor")], F.lit(0.0)) if s else F.lit(1.0)
        total = F.sum(F.when(F.col(value).isNotNull(), w))
        means.append(F.when(total != 0, F.sum(w * F.col(value)) / F.when(total != 0, total)).otherwise(F.avg(value)))
    return rows.groupBy("compound_id").agg((sum(means[1:], means[0]) / len(means)).alias(name))


def apply_bag(scores: DataFrame, bag: Bag) -> DataFrame:
    """compound_id and clf with clf_bin (above 0.5), or reg. Descriptors without a fit are ignored."""
    name = "clf" if bag.task == "classification" else "reg"
    if bag.mode == "median":
        out = bag_median(scores).withColumnRenamed("clf", name)
    elif bag.mode == "scaling":
        out = bag_scaling(scores, [scores.sparkSession.createDataFrame(sorted(s.items()), "descriptor string, w double") for s in bag.schemes], plain=True)
    else:
        rows = scores if bag.powers is None else powered(scores, bag.powers, BY, "p")
        line = F.col("slope") * F.col("p") + F.col("intercept")
        fitted = rows.join(F.broadcast(bag.lines), BY).withColumn("q", sigmoid(line) if bag.task == "classification" else line)
        if bag.mode == "weighting":
            out = weighted_mean(fitted, bag.schemes, "q", name)
        else:
            middle = F.median("q") if bag.task == "classification" else F.avg("q")
            out = fitted.groupBy("compound_id").agg(middle.alias(name))
    return out.withColumn("clf_bin", (F.col("clf") > 0.5).cast("int")) if bag.task == "classification" else out


def pool_scores(scores: DataFrame, fitted: Bag | DataFrame, **signals: bool) -> DataFrame:
    """Pool by what was fitted: a Bag, or a pool model (a table) of the reliability pooler with the signals to use."""
    return apply_bag(scores, fitted) if isinstance(fitted, Bag) else apply_pool(scores, fitted, **signals)
