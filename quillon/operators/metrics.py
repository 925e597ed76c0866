"""Model quality. Inputs have group columns `by`, a 0/1 label y (rows without one are left out) and a score p.

Ranked metrics first count rows by score, so ties collapse and a score shared by a third of all rows is one row; running
totals over scores come from quillon.functions.ordered, with no task that holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.curves import clip
from quillon.functions.ordered import numbered, running
from quillon.functions.selection import quantiles
from quillon.functions.shared import kept
from quillon.operators.subsets import binned, cells, subset_counts

CALIBRATION_EDGES = [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]
TOP = (1, 5, 10, 50, 100)


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("y").isNotNull() & F.col("p").isNotNull() & ~F.isnan(F.col("p").cast("double")))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / F.when(b == 0, F.lit(1)).otherwise(b))


def class_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """n, positives, negatives and their percentages."""
    out = labelled(df).groupBy(*by).agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("n1"))
    return out.withColumns({"n0": F.col("n") - F.col("n1"), "pct1": 100 * F.col("n1") / F.col("n"), "pct0": 100 * (F.col("n") - F.col("n1")) / F.col("n")})


def score_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """by, p, n (rows) and n1 (positives) of each distinct score."""
    return labelled(df).groupBy(*by, "p").agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("n1"))


def _cumulated(df: DataFrame, by: list[str]) -> DataFrame:
    """score_counts with cum_n and cum_n1 from the highest score down, and the group's totals t and t1."""
    out = kept(running(score_counts(df, by), by, "p", ["n", "n1"], descending=True), "cumulated")
    totals = out.groupBy(*by).agg(F.sum("n").alias("t"), F.sum("n1").alias("t1"))
    return out.join(F.broadcast(totals), by) if by else out.join(F.broadcast(totals))


def roc_curve(df: DataFrame, by: list[str]) -> DataFrame:
    """by, threshold, fpr, tpr at each distinct score, from a first point (0, 0) with a null threshold."""
    c = _cumulated(df, by).filter((F.col("t1") > 0) & (F.col("t1") < F.col("t")))
    points = c.select(*by, F.col("p").alias("threshold"), ((F.col("cum_n") - F.col("cum_n1")) / (F.col("t") - F.col("t1"))).alias("fpr"), (F.col("cum_n1") / F.col("t1")).alias("tpr"))
    zero = c.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return zero.unionByName(points)


def auroc(df: DataFrame, by: list[str], *, cumulated: DataFrame | None = None) -> DataFrame:
    """by, auroc: the share of positive-negative pairs in order, ties half; null for a single class."""
    c = cumulated or _cumulated(df, by)
    n0, above0 = F.col("n") - F.col("n1"), (F.col("cum_n") - F.col("cum_n1")) - (F.col("n") - F.col("n1"))
    below0 = (F.col("t") - F.col("t1")) - above0 - n0
    got = c.groupBy(*by).agg(F.sum(F.col("n1") * (below0 + n0 / 2)).alias("s"), F.first("t").alias("t"), F.first("t1").alias("t1"))
    pairs = F.col("t1").cast("double") * (F.col("t") - F.col("t1"))
    return got.select(*by, F.when(pairs > 0, F.col("s") / F.when(pairs > 0, pairs)).alias("auroc"))


def pr_curve(df: DataFrame, by: list[str]) -> DataFrame:
    """by, threshold, precision, recall at each distinct score, with a last point (recall 0, precision 1)."""
    c = _cumulated(df, by).filter("t1 > 0")
    points = c.select(*by, F.col("p").alias("threshold"), (F.col("cum_n1") / F.col("cum_n")).alias("precision"), (F.col("cum_n1") / F.col("t1")).alias("recall"))
    end = c.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return end.unionByName(points)


def aupr_trapezoid(df: DataFrame, by: list[str], *, cumulated: DataFrame | None = None) -> DataFrame:
    """by, aupr: area under precision over recall by trapezoids, from (0, 1)."""
    c = (cumulated or _cumulated(df, by)).filter("t1 > 0")
    prior_n, prior_n1 = F.col("cum_n") - F.col("n"), F.col("cum_n1") - F.col("n1")
    before = F.when(prior_n > 0, prior_n1 / F.when(prior_n > 0, prior_n)).otherwise(F.lit(1.0))
    area = (F.col("n1") / F.col("t1")) * (before + F.col("cum_n1") / F.col("cum_n")) / 2
    return c.groupBy(*by).agg(F.sum(area).alias("aupr"))


def average_precision(df: DataFrame, by: list[str], *, cumulated: DataFrame | None = None) -> DataFrame:
    """by, ap: sum of recall steps times precision over distinct scores."""
    c = (cumulated or _cumulated(df, by)).filter("t1 > 0")
    return c.groupBy(*by).agg(F.sum((F.col("n1") / F.col("t1")) * (F.col("cum_n1") / F.col("cum_n"))).alias("ap"))


def call(p: Column, cutoff: Column | float, *, inclusive: bool = True) -> Column:
    return p >= cutoff if inclusive else p > cutoff


def confusion(df: DataFrame, by: list[str], cutoff: Column | float = 0.5, *, inclusive: bool = True) -> DataFrame:
    """by, tp, tn, fp, fn."""
    hit = call(F.col("p"), cutoff, inclusive=inclusive)
    y = F.col("y") == 1
    return labelled(df).groupBy(*by).agg(F.count_if(hit & y).alias("tp"), F.count_if(~hit & ~y).alias("tn"), F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"))


def normalized_confusion(df: DataFrame, by: list[str], cutoff: float = 0.5) -> DataFrame:
    """Each cell as a share of its true class (row_*) and of its call (col_*); 0 where that is empty."""
    c = confusion(df, by, cutoff)
    tp, tn, fp, fn = (F.col(x) for x in ("tp", "tn", "fp", "fn"))
    return c.select(*by, ratio(tp, tp + fn).alias("row_tp"), ratio(fn, tp + fn).alias("row_fn"), ratio(tn, tn + fp).alias("row_tn"), ratio(fp, tn + fp).alias("row_fp"), ratio(tp, tp + fp).alias("col_tp"), ratio(fp, tp + fp).alias("col_fp"), ratio(tn, tn + fn).alias("col_tn"), ratio(fn, tn + fn).alias("col_fn"))


def with_point_metrics(c: DataFrame) -> DataFrame:
    """A confusion table with accuracy, balanced accuracy, precision, recall, F1 and MCC; zero denominators give 0."""
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn"))
    recall, spec, precision = ratio(tp, tp + fn), ratio(tn, tn + fp), ratio(tp, tp + fp)
    root = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return c.withColumns({
        "accuracy": ratio(tp + tn, tp + tn + fp + fn), "balanced_accuracy": (recall + spec) / 2, "precision": precision, "recall": recall,
        "f1": ratio(2 * tp, 2 * tp + fp + fn), "mcc": ratio(tp * tn - fp * fn, root),
    })


def point_metrics(df: DataFrame, by: list[str], cutoff: float = 0.5, *, inclusive: bool = True) -> DataFrame:
    return with_point_metrics(confusion(df, by, cutoff, inclusive=inclusive))


def precision_at_k(df: DataFrame, by: list[str], id_col: str, ks: tuple[int, ...] = TOP) -> DataFrame:
    """by, precision_at_<k>: positives among the k highest scores (ties by id); k beyond n uses n."""
    rank = Window.partitionBy(*by).orderBy(F.desc("p"), F.col(id_col))
    rows = labelled(df) if by else labelled(df).orderBy(F.desc("p"), id_col).limit(max(ks))
    top = rows.withColumn("_r", F.row_number().over(rank)).filter(F.col("_r") <= max(ks))
    return top.groupBy(*by).agg(*(F.avg(F.when(F.col("_r") <= k, F.col("y"))).alias(f"precision_at_{k}") for k in ks))


def _kappa(tp: Column, tn: Column, fp: Column, fn: Column) -> Column:
    n = tp + tn + fp + fn
    agree = (tp + tn) / n
    chance = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    return F.when(chance >= 1, 0.0).otherwise((agree - chance) / F.when(chance < 1, 1 - chance))


def threshold_grid(prevalence: float) -> list[float]:
    """0.05 to the larger of the prevalence and 0.6, by 0.05, without the end."""
    return [t for t in GRID if t < max(prevalence, 0.6) - 1e-9]


#: Every threshold that some prevalence allows.
GRID = [round(0.05 * i, 2) for i in range(1, 20)]


def subset_rates(df: DataFrame, by: list[str], id_col: str, thresholds: list[float] | None = None, **how) -> DataFrame:
    """by, subset, threshold, tp, tn, fp, fn over stratified subsets of fixed size (how: see subsets.subset_counts).

    Without thresholds each group has its own, by its prevalence. Rows are reduced to bins between thresholds first."""
    rows = labelled(df).withColumn("y", F.col("y").cast("int"))
    grid = thresholds or GRID
    rows = rows.select(*by, id_col, "y", binned(rows, grid).alias("bin"))
    out = cells(subset_counts(rows, by, id_col, **how), [*by, "subset"], grid)
    if thresholds:
        return out
    top = rows.groupBy(*(F.col(b).alias(f"_{b}") for b in by)).agg(F.greatest(F.avg("y"), F.lit(0.6)).alias("_top"))
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_{b}"))
    return out.join(F.broadcast(top), same).filter(F.col("threshold") < F.col("_top") - 1e-9).select(*out.columns)


def threshold_kappa(df: DataFrame, by: list[str], id_col: str, thresholds: list[float] | None = None, **how) -> DataFrame:
    """by, threshold, kappa (median over subsets, rounded to 6); the chosen cutoff is the first of the greatest."""
    r = subset_rates(df, by, id_col, thresholds, **how)
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn"))
    return r.groupBy(*by, "threshold").agg(F.round(F.median(_kappa(tp, tn, fp, fn)), 6).alias("kappa"))


def threshold_roc(df: DataFrame, by: list[str], id_col: str, thresholds: list[float] | None = None, **how) -> DataFrame:
    """by, threshold, sensitivity and specificity (medians over subsets) and their harmonic mean."""
    r = subset_rates(df, by, id_col, thresholds, **how)
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn"))
    m = r.groupBy(*by, "threshold").agg(F.median(ratio(tp, tp + fn)).alias("sensitivity"), F.median(ratio(tn, tn + fp)).alias("specificity"))
    return m.withColumn("harmonic", F.round(ratio(2 * F.col("sensitivity") * F.col("specificity"), F.col("sensitivity") + F.col("specificity")), 6))


def cutoffs(df: DataFrame, by: list[str], id_col: str, criterion: str = "kappa", **how) -> DataFrame:
    """by, cutoff: the first threshold of the greatest median kappa, or of the greatest harmonic mean ('roc')."""
    table = threshold_kappa(df, by, id_col, **how) if criterion == "kappa" else threshold_roc(df, by, id_col, **how)
    value = "kappa" if criterion == "kappa" else "harmonic"
    return table.groupBy(*by).agg(F.max_by("threshold", F.struct(F.col(value), -F.col("threshold"))).alias("cutoff"))


def best_threshold(table: DataFrame, column: str, *, last: bool = False) -> DataFrame:
    """One row: the threshold of the greatest value; of equals the first, or the last."""
    key = F.col("threshold") if last else -F.col("threshold")
    return table.agg(F.max_by("threshold", F.struct(F.col(column), key)).alias("threshold"), F.max(column).alias(column))


def threshold_oob(df: DataFrame, by: list[str], thresholds: list[float], metric: str = "kappa") -> DataFrame:
    """by, threshold and value by all rows' scores: kappa rounded to 3 (of equals the larger threshold), or the ROC
    criterion, for which every distinct score is a threshold (of equals the larger)."""
    if metric == "kappa":
        s = sweep_counts(df, by, thresholds)
        tp, tn, fp, fn = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn"))
        valued = s.withColumn("value", F.round(_kappa(tp, tn, fp, fn), 3))
    else:
        spec = 1 - F.col("fpr")
        valued = roc_curve(df, by).filter(F.col("threshold").isNotNull()).withColumn("value", F.round(ratio(2 * F.col("tpr") * spec, F.col("tpr") + spec), 6))
    return valued.groupBy(*by).agg(F.max_by("threshold", F.struct("value", "threshold")).alias("threshold"), F.max("value").alias("value"))


def sweep_counts(df: DataFrame, by: list[str], thresholds: list[float]) -> DataFrame:
    """by, threshold, tp, tn, fp, fn: one count by (class, bin), then cumulated."""
    rows = labelled(df)
    counts = rows.groupBy(*by, F.col("y").cast("int").alias("y"), binned(rows, thresholds).alias("bin")).agg(F.count("*").alias("w"))
    return cells(counts, by, thresholds)


SWEEP = [round(0.02 + 0.02 * i, 2) for i in range(49)]


def threshold_sweep(df: DataFrame, by: list[str], thresholds: list[float] = SWEEP) -> DataFrame:
    """by, threshold, precision, recall, f1, mcc."""
    return with_point_metrics(sweep_counts(df, by, thresholds)).select(*by, "threshold", "precision", "recall", "f1", "mcc")


def operating_point(df: DataFrame, by: list[str], called: Column) -> DataFrame:
    """by, threshold: midway between the least score called positive and the greatest called negative."""
    return labelled(df).groupBy(*by).agg(((F.min(F.when(called, F.col("p"))) + F.max(F.when(~called, F.col("p")))) / 2).alias("threshold"))


def calibration(df: DataFrame, by: list[str]) -> DataFrame:
    """by, bin (0 to 9), n, mean_p, rate; empty bins are left out."""
    bins = F.size(F.filter(F.array(*map(F.lit, CALIBRATION_EDGES)), lambda e: F.col("p") >= e)) - 1
    return labelled(df).groupBy(*by, clip(bins, 0, 9).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.avg("y").alias("rate"))


def brier(df: DataFrame, by: list[str]) -> DataFrame:
    return labelled(df).groupBy(*by).agg(F.avg(F.power(F.col("p") - F.col("y"), 2)).alias("brier"))


def ranked(df: DataFrame, by: list[str], id_col: str) -> DataFrame:
    """Labelled rows with k (place by score from the highest, ties by id), found (positives so far), n and n1."""
    rows = labelled(df).select(*by, id_col, "p", "y").withColumn("_one", F.lit(1))
    rows = kept(rows, "ranked")
    out = running(rows, by, "p", ["_one", "y"], ties=id_col, descending=True, keep=False)
    totals = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum("y").alias("n1"))
    joined = out.join(F.broadcast(totals), by) if by else out.join(F.broadcast(totals))
    return joined.withColumnRenamed("cum__one", "k").withColumnRenamed("cum_y", "found").drop("_one")


def cumulative_gain(df: DataFrame, by: list[str], id_col: str) -> DataFrame:
    """by, k, screened (k / n), gain (share of positives found), ideal and random."""
    r = ranked(df, by, id_col)
    f = F.col("k") / F.col("n")
    return r.select(*by, "k", f.alias("screened"), ratio(F.col("found"), F.col("n1")).alias("gain"), F.least(ratio(f * F.col("n"), F.col("n1")), F.lit(1.0)).alias("ideal"), f.alias("random"))


def enrichment(df: DataFrame, by: list[str], id_col: str, floor: float = 0.005) -> DataFrame:
    """by, k, ef: hit rate among the k best over the prevalence, from depth max(1, round(floor * n)) on."""
    r = ranked(df, by, id_col).filter(F.col("k") >= F.greatest(F.lit(1), F.rint(floor * F.col("n")))).filter("n1 > 0")
    return r.select(*by, "k", ((F.col("found") / F.col("k")) / (F.col("n1") / F.col("n"))).alias("ef"))


def percentile_rank(df: DataFrame, by: list[str], column: str, id_col: str) -> DataFrame:
    """df with pct: place in stable order over max(1, n - 1)."""
    df = kept(df, "placed")
    placed = numbered(df, by, column, id_col, name="_place", keep=False)
    n = df.groupBy(*by).agg(F.count("*").alias("_n"))
    joined = placed.join(F.broadcast(n), by) if by else placed.join(F.broadcast(n))
    return joined.withColumn("pct", (F.col("_place") - 1) / F.greatest(F.lit(1), F.col("_n") - 1)).drop("_place", "_n")


def score_lens(df: DataFrame, by: list[str], id_col: str) -> DataFrame:
    """by, id, probability, log_odds, rank, lift and raw views of the score p; lift needs labels for the prevalence."""
    prevalence = labelled(df).groupBy(*by).agg(F.avg("y").alias("_prev"))
    r = percentile_rank(df, by, "p", id_col)
    r = r.join(F.broadcast(prevalence), by, "left") if by else r.join(F.broadcast(prevalence))
    q = clip(F.col("p"), 1e-6, 1 - 1e-6)
    return r.select(*by, id_col, clip(F.col("p"), 0.0, 1.0).alias("probability"), F.ln(q / (1 - q)).alias("log_odds"), F.col("pct").alias("rank"), ratio(F.col("p"), F.col("_prev")).alias("lift"), F.col("p").alias("raw"))


def five_number(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """by, p5, p25, p50, p75, p95 of finite values (exact, linear)."""
    v = F.col(column).cast("double")
    finite = df.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return quantiles(finite, by, column, [0.05, 0.25, 0.5, 0.75, 0.95]).select(*by, *(F.col("q")[i].alias(f"p{x}") for i, x in enumerate((5, 25, 50, 75, 95))))


def regression_metrics(df: DataFrame, by: list[str]) -> DataFrame:
    """by, r2, mae of truth y and prediction p: one pass for the moments."""
    y, p = F.col("y").cast("double"), F.col("p").cast("double")
    got = labelled(df).groupBy(*by).agg(F.sum(F.power(y - p, 2)).alias("ss"), (F.var_pop(y) * F.count("*")).alias("tt"), F.avg(F.abs(y - p)).alias("mae"))
    return got.select(*by, F.when(F.col("tt") > 0, 1 - F.col("ss") / F.when(F.col("tt") > 0, F.col("tt"))).alias("r2"), "mae")


def heldout_metrics(heldout: DataFrame, *, cutoff: float = 0.5) -> DataFrame:
    """strategy, fold, auroc, ap, mcc, f1 of (strategy, fold, y, p); single-class folds are left out."""
    by = ["strategy", "fold"]
    cumulated = _cumulated(heldout, by)
    a, b, c = auroc(heldout, by, cumulated=cumulated), average_precision(heldout, by, cumulated=cumulated), point_metrics(heldout, by, cutoff)
    return a.filter(F.col("auroc").isNotNull()).join(b, by).join(c.select(*by, "mcc", "f1"), by)


def strategy_curves(heldout: DataFrame) -> DataFrame:
    """strategy, curve (roc or pr), threshold, x, y: held-out rows of all folds of a strategy pooled, a point a score."""
    by = ["strategy"]
    roc = roc_curve(heldout, by).select(*by, F.lit("roc").alias("curve"), "threshold", F.col("fpr").alias("x"), F.col("tpr").alias("y"))
    return roc.unionByName(pr_curve(heldout, by).select(*by, F.lit("pr").alias("curve"), "threshold", F.col("recall").alias("x"), F.col("precision").alias("y")))


def strategy_summary(metrics: DataFrame) -> DataFrame:
    """strategy, mean and population deviation of each metric over folds; NaN and null are left out."""
    out = []
    for m in ("auroc", "ap", "mcc", "f1"):
        v = F.when(~F.isnan(m), F.col(m))
        out += [F.avg(v).alias(f"{m}_mean"), F.stddev_pop(v).alias(f"{m}_std")]
    return metrics.groupBy("strategy").agg(F.count("*").alias("folds"), *out)


def performance(df: DataFrame, by: list[str], id_col: str, cutoff: DataFrame | float = 0.5, *, train: DataFrame | None = None, **how) -> DataFrame:
    """The performance row of each group of labelled test scores.

    With train (the same columns) the cutoff is searched on its subsets (how: see subsets.subset_counts) and its counts come
    along; else cutoff is a number, or a table (by, cutoff)."""
    found = cutoffs(train, by, id_col, **how) if train is not None else cutoff
    rows = df.withColumn("cutoff", F.lit(found)) if isinstance(found, float) else df.join(F.broadcast(found), by) if by else df.join(F.broadcast(found))
    rows = kept(rows.select(*by, id_col, "y", "p", "cutoff"), "scored")
    cumulated = _cumulated(rows, by)
    counted = lambda side, name: class_counts(side, by).select(*by, *(F.col(c).alias(f"num_{name}{s}") for c, s in (("n", ""), ("n0", "_0"), ("n1", "_1"))))
    out = counted(rows, "test")
    points = with_point_metrics(confusion(rows, [*by, "cutoff"], F.col("cutoff")))
    parts = [auroc(rows, by, cumulated=cumulated), aupr_trapezoid(rows, by, cumulated=cumulated), points, precision_at_k(rows, by, id_col)]
    for part in parts if train is None else [counted(train, "train"), *parts]:
        out = out.join(part, by) if by else out.join(F.broadcast(part))
    return out.filter((F.col("num_test_0") > 0) & (F.col("num_test_1") > 0))


def cv_table(df: DataFrame, train_auroc: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """descriptor, auroc (out of fold), ap, train_auroc, gap, gap_level and cutoff, best first and unknown last."""
    by = ["descriptor"]
    cumulated = _cumulated(df, by)
    out = auroc(df, by, cumulated=cumulated).join(average_precision(df, by, cumulated=cumulated), by, "left").join(train_auroc, by, "left").join(cutoffs, by, "left")
    gap = F.col("train_auroc") - F.col("auroc")
    level = F.when(gap < 0.05, "low").when(gap < 0.12, "medium").when(gap.isNotNull(), "high")
    return out.withColumns({"gap": gap, "gap_level": level}).orderBy(F.coalesce("auroc", F.lit(-1.0)).desc(), "descriptor")
