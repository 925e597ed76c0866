"""The three jobs: fit (table -> model and tables), predict (table and model -> tables), report (tables of a run)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.shared import kept
from quillon.functions.text import hashed_ngrams, is_lexical_structure
from quillon.operators import bagging, calibrate, estimate, metrics, outputs, pooling, prep, scaling, screen, splits


@dataclass
class Descriptor:
    """A named feature function: a structure column to an array of doubles."""

    name: str
    fn: Callable[[Column], Column]
    version: str = "v1"


@dataclass
class Settings:
    top_k: int = 3
    repeats: int = 3
    folds: int = 5
    min_class: int | None = 30
    kind: str = "logistic"
    pooler: str = "reliability"
    bag_mode: str = "weighting"
    is_valid: Callable[[Column], Column] = is_lexical_structure
    standard: Callable[[Column], Column] = field(default=lambda c: c)
    schemas: tuple[str, ...] = splits.MENU
    scaffold: Callable[[Column], Column] = field(default=lambda c: F.regexp_replace(c, "[^A-Za-z]", ""))  # the letters alone
    sets: Callable[[Column], Column] = hashed_ngrams


@dataclass
class Run:
    """What a fit leaves: tables, fitted models by descriptor, transformers, domains and the pool model."""

    tables: dict[str, DataFrame]
    models: dict = field(default_factory=dict)
    transformers: dict[str, DataFrame] = field(default_factory=dict)
    domains: dict = field(default_factory=dict)
    pool_model: DataFrame | None = None
    knots: dict = field(default_factory=dict)  # calibration by descriptor, learned from its out-of-fold scores
    bag: bagging.Bag | None = None
    signals: dict[str, bool] = field(default_factory=dict)


def prepare(df: DataFrame, structure: str, value: str | None, s: Settings, *, fit: bool) -> dict[str, DataFrame]:
    """mapping, entities (with standard_smiles) and data (compound_id, smiles, bin) from rows with orig_idx."""
    rows = prep.normalize(prep.validate(df, s.is_valid, structure), structure, value, more=["valid"])
    mapping, entities = prep.dedupe(rows)
    standard = prep.standardize(entities, s.standard)
    labels = None
    if value is not None:
        given = rows.filter("valid").withColumn("value", F.col("value").cast("double"))
        usable = given if fit else prep.labelled_only(given)
        if usable is not None:
            labels = prep.binarize(prep.reconcile_labels(usable), min_class=s.min_class, strict=fit)
    data = prep.merge_fit(standard, labels) if fit else prep.merge_predict(standard, labels)
    return {"inputs": rows, "mapping": mapping, "standard": standard, "data": data}


def fold_groups(data: DataFrame, s: Settings) -> dict[str, DataFrame]:
    """(compound_id, group) of the fold menu's grouped strategies, from data (compound_id, smiles)."""
    out = {}
    if {"scaffold", "deterministic"} & set(s.schemas):
        out["scaffold"] = kept(splits.groups_by_key(data, s.scaffold).select("compound_id", "group"), "scaffolds")
    if "butina" in s.schemas:
        sets = kept(data.select("compound_id", s.sets(F.col("smiles")).alias("bits")), "sets")
        out["butina"] = kept(splits.groups_butina(sets).withColumnRenamed("id", "compound_id"), "clusters")
    return out


def features_of(data: DataFrame, d: Descriptor) -> DataFrame:
    return data.select("compound_id", d.fn(F.col("smiles")).cast("array<double>").alias("features"))


def fit(df: DataFrame, structure: str, value: str, descriptors: list[Descriptor], settings: Settings | None = None) -> Run:
    s = settings or Settings()
    run = Run(prepare(df, structure, value, s, fit=True))
    data = kept(run.tables["data"], "data")
    run.tables["data"] = data
    matrices = {}
    for d in descriptors:
        raw = kept(features_of(data, d), "features")
        fitted = scaling.fit_transformer(raw)
        run.transformers[d.name] = df.sparkSession.createDataFrame(fitted.collect(), fitted.schema)  # a row a feature
        matrices[d.name] = kept(scaling.apply_transformer(raw, run.transformers[d.name]), "matrix")
    chosen = sorted(matrices)
    if len(chosen) > s.top_k:
        folds, _ = splits.build_folds(data, s.repeats, s.schemas, fold_groups(data, s))
        chosen = screen.screen(matrices, folds, s.top_k)
    labelled = {n: kept(matrices[n].join(data.select("compound_id", F.col("bin").alias("y")), "compound_id"), "labelled") for n in chosen}
    learn(run, labelled, s)
    run.tables["pooled"] = bagging.pool_scores(run.tables["scores"], run.bag or run.pool_model, **run.signals)
    run.tables["train"] = kept(outputs.by_model(run.tables["pooled"], run.tables["scores"]).join(data.select("compound_id", F.col("bin").alias("y")), "compound_id"), "train")
    return run


def learn(run: Run, labelled: dict[str, DataFrame], s: Settings) -> None:
    """Models, domains, out-of-fold scores and the pool model of labelled matrices (compound_id, features, y), into run."""
    run.models, run.tables["errors"] = estimate.fit_all(labelled, kind=s.kind)[0], None
    parts, cutoffs = None, []
    for n in run.models:
        oof = estimate.oof_scores(labelled[n], k=s.folds, kind=s.kind).withColumn("descriptor", F.lit(n))
        run.domains[n] = estimate.fit_domain(labelled[n])
        ad = estimate.score_domain(run.domains[n], labelled[n]).select("compound_id", "ad")
        cutoffs.append((n, float(run.domains[n]["cutoff"])))
        one = oof.join(ad, "compound_id", "left")
        parts = one if parts is None else parts.unionByName(one)
    parts = kept(parts, "oof")
    spark = parts.sparkSession
    scores = kept(estimate.rank_quantile(parts, parts, ["descriptor"]), "scores")
    present = pooling.signals_present(scores)
    run.signals = {"use_rank": present["rank_q"], "use_ad": present["ad"]}
    model = pooling.fit_pool(estimate.pool_signals(scores, spark.createDataFrame(cutoffs, "descriptor string, ad_cutoff double")))
    # a row a descriptor, with at most 20 knots each: kept as rows, so later plans don't carry the fit's lineage
    run.pool_model = spark.createDataFrame(model.collect(), model.schema)
    run.tables["scores"], run.tables["oof"] = scores, parts
    run.knots = calibrate.knots_of(calibrate.fit_isotonic(parts, ["descriptor"]), ["descriptor"])
    if s.pooler == "bagger":
        run.bag = bagging.fit_bag(scores, s.bag_mode)


def apply(run: Run, matrices: dict[str, DataFrame]) -> DataFrame:
    """Scores with ranks and domain of new matrices (compound_id, features), by a run's models and its out-of-fold scores."""
    parts = None
    for name, x in matrices.items():
        # score and domain in one pass over the features
        both = estimate.score_domain(run.domains[name], estimate.predict(run.models[name], x))
        got = both.select("compound_id", "p_raw", "ad", F.lit(name).alias("descriptor"))
        one = calibrate.calibrated(got, run.knots, ["descriptor"]).select("compound_id", "p_raw", "p", "ad", "descriptor")
        parts = one if parts is None else parts.unionByName(one)
    if parts is None:
        raise ValueError("no trained descriptor is present")
    return kept(estimate.rank_quantile(kept(parts, "parts"), run.tables["oof"], ["descriptor"]), "scores")


def predict(df: DataFrame, structure: str, value: str | None, descriptors: list[Descriptor], run: Run, settings: Settings | None = None) -> Run:
    """Score a new table with a fit's models: only selected descriptors are computed, saved transformers and domains used."""
    s = settings or Settings()
    out = replace(run, tables=prepare(df, structure, value, s, fit=False))
    data = out.tables["data"] = kept(out.tables["data"], "data")
    scores = apply(run, {d.name: scaling.apply_transformer(features_of(data, d), run.transformers[d.name]) for d in descriptors if d.name in run.models})
    out.tables["oof"], out.tables["train"] = run.tables["oof"], run.tables["train"]
    out.tables["scores"] = scores
    out.tables["pooled"] = bagging.pool_scores(scores, run.bag or run.pool_model, **run.signals)
    return out


def report(run: Run) -> dict[str, DataFrame]:
    """Output and, where there is truth of both classes, performance tables, with cutoffs searched on the fit's out-of-fold scores."""
    t = run.tables
    names = sorted(run.models)
    truth = t["data"] if "bin" in t["data"].columns else None
    tables = {"output": outputs.output_table(t["inputs"], t["mapping"], t["standard"], t["pooled"], t["scores"], names, truth=truth)}
    if truth is not None:
        tables["performance"] = outputs.performance_table(t["pooled"], t["scores"], truth, train=t["train"])
        tables["calibration"] = metrics.calibration(t["pooled"].select("compound_id", F.col("clf").alias("p")).join(truth.select("compound_id", F.col("bin").alias("y")), "compound_id"), [])
    return tables


def run_folds(data: DataFrame, folds: DataFrame, descriptors: list[Descriptor], settings: Settings | None = None) -> DataFrame:
    """strategy, fold, compound_id, y, p: on each fold's train side everything a fit learns (models, skill out of fold,
    error curves, ranks, domains), applied to its test side.

    A fold whose train side lacks a class is left out. Folds drive ML jobs one after another; each job is distributed.
    """
    s = settings or Settings()
    matrices = {d.name: kept(features_of(data, d), "matrix") for d in descriptors}
    sides = folds.filter(~F.col("is_test")).groupBy("fold").agg(F.count_distinct("bin").alias("classes")).filter("classes = 2")
    out = None
    for fold in [r.fold for r in sides.orderBy("fold").collect()]:  # a row a fold
        rows = folds.filter(F.col("fold") == fold).select("compound_id", "is_test", F.col("bin").alias("y"))
        joined = {n: kept(x.join(rows, "compound_id"), "fold") for n, x in matrices.items()}
        run = Run({})
        learn(run, {n: x.filter(~F.col("is_test")).drop("is_test") for n, x in joined.items()}, s)
        scores = apply(run, {n: joined[n].filter("is_test").select("compound_id", "features") for n in run.models})
        pooled = bagging.pool_scores(scores, run.bag or run.pool_model, **run.signals).select("compound_id", F.col("clf").alias("p"))
        one = pooled.join(rows.filter("is_test").select("compound_id", "y"), "compound_id").select(F.lit(fold.rsplit("_", 1)[0]).alias("strategy"), F.lit(fold).alias("fold"), "compound_id", "y", "p")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise RuntimeError("no fold has both classes on its train side")
    return out
