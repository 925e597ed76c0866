"""Job telemetry: step logs (run, name, t in seconds, cpu, ram_used_gb, ram_total_gb) as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Phase order, and steps that timing leaves out.
PHASES = ["setup", "describe", "projections", "treat", "estimate", "pool", "report", "finish"]
EXCLUDED = ("report", "finish")


def log_step(name: str, t: float, cpu: float | None = None, ram_used_gb: float | None = None, ram_total_gb: float | None = None) -> dict:
    """A step-log record."""
    pct = 100 * ram_used_gb / ram_total_gb if ram_used_gb is not None and ram_total_gb else None
    return {"name": name, "t": t, "cpu": cpu, "ram_used_gb": ram_used_gb, "ram_total_gb": ram_total_gb, "ram_pct": pct}


def step_durations(log: DataFrame, start: DataFrame | None = None, *, run: str = "run") -> DataFrame:
    """run, name, first_t, t, seconds: the last record of each step, in order of first appearance; seconds since the step
    before (the first since the run's start, or its own first record), never negative. Runs are independent partitions."""
    steps = log.filter(~F.col("name").isin(*EXCLUDED)).groupBy(run, "name").agg(F.min("t").alias("first_t"), F.max("t").alias("t"))
    if start is not None:
        steps = steps.join(start.select(run, F.col("t").alias("_s")), run, "left")
    else:
        steps = steps.withColumn("_s", F.lit(None).cast("double"))
    order = Window.partitionBy(run).orderBy("first_t", "name")
    before = F.coalesce(F.lag("t").over(order), F.col("_s"), F.col("first_t"))
    return steps.select(run, "name", "first_t", "t", F.greatest(F.lit(0.0), (F.col("t") - before).cast("double")).alias("seconds"))


def peaks(log: DataFrame, *, run: str = "run") -> DataFrame:
    """run, cpu and ram_used_gb at their highest, and the last ram_total_gb."""
    return log.groupBy(run).agg(F.max("cpu").alias("cpu"), F.max("ram_used_gb").alias("ram_used_gb"), F.max_by("ram_total_gb", "t").alias("ram_total_gb"))


def collapse_phase(steps: DataFrame, phase: str = "setup", keep: str = "standardise_smiles", *, run: str = "run") -> DataFrame:
    """Steps (run, name, phase, first_t, seconds, cpu, ram_used_gb) with one phase reduced to `keep` and everything else of
    it; seconds add up, peaks stay; a phase of one step is left as it is."""
    in_phase = F.col("phase") == phase
    many = steps.filter(in_phase).groupBy(run).agg(F.count("*").alias("_n"), F.min("first_t").alias("_at"))
    rows = steps.join(many, run, "left")
    fold = in_phase & (F.col("_n") > 1)
    name = F.when(fold & (F.col("name") != keep), F.lit(f"other-{phase}")).otherwise(F.col("name"))
    at = F.when(fold, F.col("_at")).otherwise(F.col("first_t"))
    out = rows.groupBy(run, name.alias("name"), "phase").agg(F.min(at).alias("first_t"), F.sum("seconds").alias("seconds"), F.max("cpu").alias("cpu"), F.max("ram_used_gb").alias("ram_used_gb"))
    return out.select(run, "name", "phase", "first_t", "seconds", "cpu", "ram_used_gb")


def phase_totals(steps: DataFrame, *, run: str = "run") -> DataFrame:
    """run, phase, place (in the fixed order) and seconds, where positive."""
    place = F.array_position(F.array(*map(F.lit, PHASES)), F.col("phase"))
    return steps.groupBy(run, "phase").agg(F.sum("seconds").alias("seconds")).filter("seconds > 0").withColumn("place", place.cast("int")).select(run, "phase", "place", "seconds")


def usage_timeline(log: DataFrame, *, run: str = "run") -> DataFrame:
    """run, name, t, cpu, ram_used_gb and elapsed since the run's first record, with seconds (of the step in all) and place
    (1: the run's longest step, of equals the first by name)."""
    steps = step_durations(log, run=run)
    longest = steps.withColumn("place", F.row_number().over(Window.partitionBy(run).orderBy(F.desc(F.round("seconds", 3)), "name")))
    return _timeline(log, run).join(longest.select(run, "name", "seconds", "place"), [run, "name"], "left")


def _timeline(log: DataFrame, run: str) -> DataFrame:
    return log.withColumn("elapsed", F.col("t") - F.min("t").over(Window.partitionBy(run))).select(run, "name", "t", "elapsed", "cpu", "ram_used_gb")


def eta(status: DataFrame) -> DataFrame:
    """seconds left from (state, elapsed): mean finished time x queued + what the running ones still need."""
    mean = F.avg(F.when(F.col("state") == "done", F.col("elapsed")))
    known = status.agg(mean.alias("_m"), F.count_if(F.col("state") == "queued").alias("_q"))
    running = status.filter(F.col("state") == "running").join(F.broadcast(known)).agg(F.sum(F.greatest(F.lit(0.0), F.col("_m") - F.col("elapsed"))).alias("_r"))
    return known.join(F.broadcast(running)).select((F.col("_m") * F.col("_q") + F.coalesce("_r", F.lit(0.0))).alias("seconds"))


def load_level(share: Column) -> Column:
    """low below 50, medium below 80, else high; null for null."""
    return F.when(share < 50, "low").when(share < 80, "medium").when(share.isNotNull(), "high")


def bar_length(seconds: Column, longest: Column) -> Column:
    return F.greatest(F.lit(2.0), 100 * seconds / longest)
