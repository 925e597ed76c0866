"""Column functions on small sorted arrays: interpolation, logits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-7


def interpolate(x: Column, knots: Column, at: str = "r", value: str = "e") -> Column:
    """Linear interpolation over an array of structs sorted by `at`; ends are held, of equal knots the last counts."""
    below = F.filter(knots, lambda k: k[at] <= x)
    above = F.filter(knots, lambda k: k[at] > x)
    lo, hi = F.element_at(below, -1), F.get(above, F.lit(0))
    inside = lo[value] + (hi[value] - lo[value]) * (x - lo[at]) / (hi[at] - lo[at])
    return F.when(F.size(below) == 0, hi[value]).when(F.size(above) == 0, lo[value]).otherwise(inside)


def clip(x: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """x held to [lo, hi]; null stays null."""
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNotNull(), out)


def logit(p: Column, eps: float = EPS) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.ln(q / (1 - q))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))
