"""Screening of descriptors: proxy models per fold, ensemble AUROC, greedy forward selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.shared import kept
from quillon.operators.estimate import estimator, predict, _vectors
from quillon.operators.metrics import auroc

LEAST_SOLO, LEAST_GAIN = 0.55, 0.001


def proxy_scores(features: dict[str, DataFrame], folds: DataFrame, array: str = "features") -> DataFrame:
    """fold, compound_id, descriptor, y, p of test rows by a small forest per fold; a fold whose side lacks a class is
    skipped. features: descriptor -> (compound_id, features); folds: fold, compound_id, bin, is_test."""
    sides = folds.groupBy("fold", "is_test").agg(F.count_distinct("bin").alias("k")).collect()
    usable = sorted({r.fold for r in sides if all(x.k == 2 for x in sides if x.fold == r.fold)})
    out = None
    for name, table in features.items():
        for fold in usable:
            rows = folds.filter(F.col("fold") == fold).join(table, "compound_id").withColumn("y", F.col("bin").cast("double"))
            model = estimator("proxy").fit(_vectors(rows.filter(~F.col("is_test")), array))
            got = predict(model, rows.filter("is_test"), array).select("fold", "compound_id", F.lit(name).alias("descriptor"), "y", "p")
            out = got if out is None else out.unionByName(got)
    return out


def ensemble_auc(preds: DataFrame, members: list[str]) -> float:
    """Mean over folds of the AUROC of the members' mean probability; 0.5 if there is none."""
    mean = preds.filter(F.col("descriptor").isin(members)).groupBy("fold", "compound_id").agg(F.avg("p").alias("p"), F.first("y").alias("y"))
    got = auroc(mean, ["fold"]).agg(F.avg("auroc")).first()[0]
    return 0.5 if got is None else float(got)


def select_descriptors(preds: DataFrame, candidates: list[str], k: int = 3) -> tuple[list[str], dict[str, float]]:
    """Greedy forward selection and the solo scores: candidates of at least 0.55 (else all), best first; one is added if the
    ensemble gains at least 0.001; never empty; a candidate without scores has 0.5."""
    solo_table = auroc(preds, ["descriptor", "fold"]).groupBy("descriptor").agg(F.avg("auroc").alias("a"))
    solo = {c: 0.5 for c in candidates} | {r.descriptor: float(r.a) for r in solo_table.collect() if r.a is not None}
    ranked = sorted(candidates, key=lambda c: (-solo[c], c))
    pool = [c for c in ranked if solo[c] >= LEAST_SOLO] or ranked
    chosen, best = [pool[0]], solo[pool[0]]
    for c in pool[1:]:
        if len(chosen) >= k:
            break
        got = ensemble_auc(preds, [*chosen, c])
        if got >= best + LEAST_GAIN:
            chosen.append(c)
            best = got
    return chosen, solo


def screen_table(spark, solo: dict[str, float], chosen: list[str]) -> DataFrame:
    """descriptor, auroc, kept; best first."""
    rows = [(c, a, c in chosen) for c, a in sorted(solo.items(), key=lambda x: (-x[1], x[0]))]
    return spark.createDataFrame(rows, "descriptor string, auroc double, kept boolean")


def screen(features: dict[str, DataFrame], folds: DataFrame, k: int = 3, *, mode: str = "fit", task: str = "classification") -> list[str]:
    """The descriptors to train: all, unless this is a classification fit with more candidates than k."""
    names = sorted(features)
    if mode != "fit" or task != "classification" or len(names) <= k:
        return names
    preds = proxy_scores(features, folds)
    return names if preds is None else select_descriptors(kept(preds, "proxies"), names, k)[0]
