"""Logistic fits of one variable for many groups at once: Newton's method, one aggregate over all groups a round.

A group's sums (gradient and curvature, six numbers) come from one pass over its rows, combined before the shuffle; the
two-by-two systems are solved on the driver, a row a group. Groups that have converged are left out of later passes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.shared import kept

ROUNDS = 50
#: A group is done when a step moves neither number by more.
TOLERANCE = 1e-10


@dataclass
class _Line:
    """A group's state: what was reached, the step tried from it, and the loss there."""

    slope: float
    intercept: float
    loss: float = math.inf
    step: tuple[float, float] = (0.0, 0.0)
    done: bool = False


def fit_lines(df: DataFrame, by: list[str], x: str, y: str, *, penalty: float = 1.0, rounds: int = ROUNDS) -> DataFrame:
    """by, slope, intercept of P(y = 1) = 1 / (1 + exp(-(slope * x + intercept))), fitted with penalty * slope^2 / 2.

    Rows without x or y are left out. A group of one class has slope 0 and an intercept of 16 either way."""
    spark = df.sparkSession
    usable = df.filter(F.col(x).isNotNull() & ~F.isnan(F.col(x).cast("double")) & F.col(y).isNotNull())
    rows = kept(usable.select(F.struct(*by).alias("_g"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")), "points")
    kind = rows.schema["_g"].dataType.simpleString()
    start = rows.groupBy("_g").agg(F.avg("_y").alias("rate")).collect()  # a row a group
    state = {}
    for r in start:
        mixed = 0 < r["rate"] < 1
        state[r["_g"]] = _Line(0.0, math.log(r["rate"] / (1 - r["rate"])) if mixed else math.copysign(16.0, r["rate"] - 0.5), done=not mixed)
    for _ in range(rounds):
        open_ = {g: s for g, s in state.items() if not s.done}
        if not open_:
            break
        tried = {g: (s.slope + s.step[0], s.intercept + s.step[1]) for g, s in open_.items()}
        table = spark.createDataFrame([(g, *t) for g, t in tried.items()], f"_g {kind}, _s double, _b double")
        for r in _sums(rows.join(F.broadcast(table), "_g")).collect():
            _advance(state[r["_g"]], *tried[r["_g"]], r, penalty)
    found = [(g, s.slope, s.intercept) for g, s in state.items()]
    out = spark.createDataFrame(found, f"_g {kind}, slope double, intercept double")
    return out.select(*(F.col("_g")[b].alias(b) for b in by), "slope", "intercept")


def _sums(rows: DataFrame) -> DataFrame:
    z = F.col("_s") * F.col("_x") + F.col("_b")
    q = 1 / (1 + F.exp(-z))
    w, off, x = q * (1 - q), F.col("_y") - q, F.col("_x")
    # log(1 + e^z) - y z, without an overflow
    loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - F.col("_y") * z
    sums = {"loss": loss, "g0": off, "g1": off * x, "h0": w, "h1": w * x, "h2": w * x * x}
    return rows.groupBy("_g").agg(*(F.sum(v).alias(n) for n, v in sums.items()))


def _advance(s: _Line, slope: float, intercept: float, r, penalty: float) -> None:
    """Take the step that was tried if it lowers the loss, and try the next; else try half of it."""
    loss = r["loss"] + penalty * slope * slope / 2
    if loss > s.loss + 1e-9 * abs(s.loss):
        s.step = (s.step[0] / 2, s.step[1] / 2)
        s.done = max(map(abs, s.step)) < TOLERANCE
        return
    s.slope, s.intercept, s.loss = slope, intercept, loss
    g0, g1 = r["g0"], r["g1"] - penalty * slope
    h0, h1, h2 = max(r["h0"], 1e-300), r["h1"], r["h2"] + penalty
    det = h0 * h2 - h1 * h1
    s.step = ((h0 * g1 - h1 * g0) / det, (h2 * g0 - h1 * g1) / det) if det > 0 else (0.0, 0.0)
    s.done = abs(s.step[0]) < TOLERANCE * max(1.0, abs(slope)) and abs(s.step[1]) < TOLERANCE * max(1.0, abs(intercept))
