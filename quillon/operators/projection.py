"""Learned two-dimensional projections that are fitted once, saved, and applied to new rows.

`pca`: the two first principal components. `spectral`: a layout of landmarks, a fixed number of rows with the least hashes
(documented bound; what is learned from). Each landmark is joined to its nearest ones; the two slowest eigenvectors of the
graph's normalised Laplacian are the landmarks' places. A row's place is the mean of those of its nearest landmarks, weighted
by a kernel of the distance, so a row has the same place at fit and at predict, whatever rows come with it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.selection import bars

LANDMARKS, NEIGHBOURS = 512, 12


@dataclass
class Projection:
    """kind, and its arrays: for pca center and axes; for spectral the landmarks, their places and kernel widths."""

    kind: str
    center: np.ndarray
    axes: np.ndarray
    widths: np.ndarray

    def place(self, x: np.ndarray) -> np.ndarray:
        """x and y of each row."""
        if self.kind == "pca":
            return (x - self.center) @ self.axes
        if len(self.center) == 0:
            return np.full((len(x), 2), np.nan)
        far = distances(x, self.center)
        near = np.argsort(far, axis=1, kind="stable")[:, : min(NEIGHBOURS, len(self.center))]
        d = np.take_along_axis(far, near, axis=1)
        w = np.exp(-(((d - d[:, :1]) / self.widths[near]) ** 2))
        return np.einsum("ij,ijk->ik", w, self.axes[near]) / w.sum(axis=1, keepdims=True)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0.0))


def spectral_layout(points: np.ndarray, neighbours: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
    """Places (two numbers a point, of deviation 1) and kernel widths of points, by their neighbour graph."""
    n = len(points)
    k = min(neighbours, n - 1)
    if k < 1:
        return np.zeros((n, 2)), np.ones(n)
    far = distances(points, points)
    np.fill_diagonal(far, np.inf)
    near = np.argsort(far, axis=1, kind="stable")[:, :k]
    width = np.maximum(np.take_along_axis(far, near, axis=1)[:, -1], 1e-12)
    graph = np.full((n, n), 1e-6)  # parts without a joint edge keep a faint one
    rows = np.repeat(np.arange(n), k)
    graph[rows, near.ravel()] = np.exp(-(far[rows, near.ravel()] ** 2) / (width[rows] * width[near.ravel()]))
    graph = np.maximum(graph, graph.T)
    np.fill_diagonal(graph, 0.0)
    root = 1 / np.sqrt(graph.sum(axis=1))
    values, vectors = np.linalg.eigh(root[:, None] * graph * root[None, :])
    places = (vectors[:, np.argsort(-values, kind="stable")[1:3]]) * root[:, None]
    if places.shape[1] < 2:
        places = np.column_stack([places, np.zeros(n)])
    places *= np.where(places[np.argmax(np.abs(places), axis=0), [0, 1]] < 0, -1.0, 1.0)  # a sign that is always the same
    spread = places.std(axis=0)
    return places / np.where(spread > 0, spread, 1.0), width


def landmarks(df: DataFrame, vector: str, id_col: str, count: int) -> np.ndarray:
    """The vectors of `count` rows of least hash (of all, if fewer), in order of hash and id."""
    h = F.xxhash64(F.lit(7), F.col(id_col))
    # the hash's upper bits: whole numbers that a double holds
    rows = df.filter(F.col(vector).isNotNull()).select(F.col(id_col).cast("string").alias("_id"), F.col(vector).cast("array<double>").alias("_v"), F.shiftright(h, 12).cast("double").alias("_h"))
    bar = bars(rows.select("_h"), [], "_h", F.lit(count)).first()
    if bar is None or bar["bar"] is None:
        return np.zeros((0, 0))
    got = rows.filter(F.col("_h") <= bar["bar"]).orderBy("_h", "_id").limit(count).collect()
    return np.array([r["_v"] for r in got], dtype=float)


def fit_projection(df: DataFrame, vector: str, kind: str = "pca", *, id_col: str = "compound_id", count: int = LANDMARKS) -> Projection:
    if kind == "spectral":
        points = landmarks(df, vector, id_col, count)
        return Projection(kind, points, *spectral_layout(points))
    if kind != "pca":
        raise ValueError(f"pca or spectral, not {kind!r}")
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    rows = df.filter(F.col(vector).isNotNull()).select(array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    center = np.array(rows.select(Summarizer.mean(F.col("v"))).first()[0].toArray())
    axes = PCA(k=2, inputCol="v", outputCol="c").fit(rows).pc.toArray()
    axes = axes * np.where(axes[np.argmax(np.abs(axes), axis=0), [0, 1]] < 0, -1.0, 1.0)
    return Projection(kind, center, axes, np.zeros(0))


def project(df: DataFrame, model: Projection, vector: str, *, id_col: str = "compound_id", name: str | None = None) -> DataFrame:
    """compound_id, name, x, y of rows with a vector."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("x double, y double")
    def place(v: pd.Series) -> pd.DataFrame:
        at = shared.value.place(np.array(v.tolist(), dtype=float)) if len(v) else np.zeros((0, 2))
        return pd.DataFrame({"x": at[:, 0], "y": at[:, 1]})

    rows = df.filter(F.col(vector).isNotNull()).select(F.col(id_col).alias("compound_id"), place(F.col(vector)).alias("_p"))
    return rows.select("compound_id", F.lit(name or model.kind).alias("name"), "_p.x", "_p.y")


def save_projection(spark: SparkSession, model: Projection, path: str) -> None:
    """One row, with the arrays and their widths."""
    row = (model.kind, model.center.ravel().tolist(), int(model.center.shape[-1]) if model.center.size else 0, model.axes.ravel().tolist(), model.widths.tolist())
    spark.createDataFrame([row], "kind string, center array<double>, dims int, axes array<double>, widths array<double>").write.mode("overwrite").parquet(path)


def load_projection(spark: SparkSession, path: str) -> Projection:
    r = spark.read.parquet(path).first()
    center = np.array(r["center"]).reshape(-1, r["dims"]) if r["dims"] else np.zeros((0, 0))
    return Projection(r["kind"], center[0] if r["kind"] == "pca" else center, np.array(r["axes"]).reshape(-1, 2), np.array(r["widths"]))
