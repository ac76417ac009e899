"""Gaussian mixtures with full covariances, fitted by passes over the table.

A pass sends the components to every task, each batch returns its sums of responsibilities,
deviations and their products, and the driver updates k small matrices. So a pass moves
k * (columns + 1)^2 numbers, whatever the table's size, and all decompositions run on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.operators.kmeans import Model, nearest_centers

# ---- Fixed values: the fit's settings ----
RIDGE = 1e-6
GAIN = 1e-3
PASSES = 100


@dataclass
class Mixture:
    """Components, and the mean log-likelihood of a row under them, pass by pass."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    likelihoods: list[float]

    def log_densities(self, data: np.ndarray) -> np.ndarray:
        """Log of weight times density, rows by components."""
        out = np.empty((len(data), len(self.means)))
        for i, (w, mean, cov) in enumerate(zip(self.weights, self.means, self.covariances)):
            factor = np.linalg.cholesky(cov)
            inverse = np.linalg.inv(factor)
            off = (data - mean) @ inverse.T
            out[:, i] = (
                np.log(w) - np.log(np.diag(factor)).sum() - (off * off).sum(axis=1) / 2
                - data.shape[1] * np.log(2 * np.pi) / 2
            )
        return out


def _sums(points: DataFrame, columns: list[str], share, means: np.ndarray) -> pd.DataFrame:
    """Per component: weight, sums of deviations from ``means`` and of their products, likelihood.

    ``share`` gives a batch's responsibilities and its log-likelihood by component.
    """
    d = len(columns)
    names = ["n", "likelihood", *[f"s{i}" for i in range(d)], *[f"p{i}" for i in range(d * d)]]

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = batch[columns].to_numpy(dtype=float)
            if not len(data):
                continue
            resp, likelihood = share(data)
            rows = []
            for i, mean in enumerate(means):
                off = data - mean
                weighted = off * resp[:, [i]]
                rows.append([
                    resp[:, i].sum(), likelihood if i == 0 else 0.0, *weighted.sum(axis=0),
                    *(weighted.T @ off).ravel(),
                ])
            found = pd.DataFrame(rows, columns=names)
            found.insert(0, "component", np.arange(len(means)))
            yield found

    schema = "component long, " + ", ".join(f"{n} double" for n in names)
    return (
        points.select(*columns).mapInPandas(add_up, schema).groupBy("component")
        .agg(*[F.sum(n).alias(n) for n in names]).orderBy("component").toPandas()
    )


def _updated(sums: pd.DataFrame, means: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    d = means.shape[1]
    # An empty component keeps a trace of weight, as its logarithm is needed.
    n = sums["n"].to_numpy() + 10 * np.finfo(float).eps
    step = sums[[f"s{i}" for i in range(d)]].to_numpy() / n[:, None]
    products = sums[[f"p{i}" for i in range(d * d)]].to_numpy().reshape(-1, d, d) / n[:, None, None]
    covariances = products - step[:, :, None] * step[:, None, :] + RIDGE * np.eye(d)
    return n / n.sum(), means + step, covariances


def fit_mixture(
    points: DataFrame, columns: Sequence[str], start: Model, gain: float = GAIN,
    passes: int = PASSES,
) -> Mixture:
    """Expectation and maximisation from a k-means model's clusters.

    Ends when the mean log-likelihood of a row gains less than ``gain``, or after ``passes``.
    """
    columns = list(columns)
    keep = points.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        k = len(start.centers)
        context = points.sparkSession.sparkContext
        sent = context.broadcast(start.centers)

        def by_center(data: np.ndarray):
            (label, _), = nearest_centers(data, sent.value, [slice(0, k)])
            return (label[:, None] == np.arange(k)).astype(float), 0.0

        sums = _sums(keep, columns, by_center, start.centers)
        sent.destroy()
        mixture = Mixture(*_updated(sums, start.centers), [])
        rows = float(sums["n"].sum())
        while True:
            sent_mixture = context.broadcast(mixture)

            def by_density(data: np.ndarray, sent=sent_mixture):
                logs = sent.value.log_densities(data)
                top = logs.max(axis=1, keepdims=True)
                total = top + np.log(np.exp(logs - top).sum(axis=1, keepdims=True))
                return np.exp(logs - total), float(total.sum())

            sums = _sums(keep, columns, by_density, mixture.means)
            sent_mixture.destroy()
            seen = [*mixture.likelihoods, float(sums["likelihood"].sum()) / rows]
            if len(seen) > passes or (len(seen) > 1 and seen[-1] - seen[-2] < gain):
                mixture.likelihoods = seen
                return mixture
            mixture = Mixture(*_updated(sums, mixture.means), seen)
    finally:
        keep.unpersist()


def assign_mixture(points: DataFrame, columns: Sequence[str], mixture: Mixture) -> DataFrame:
    """(CustomerID, label): each row's component of highest posterior, from 0."""
    columns = list(columns)
    sent = points.sparkSession.sparkContext.broadcast(mixture)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            logs = sent.value.log_densities(batch[columns].to_numpy(dtype=float))
            yield pd.DataFrame({
                "CustomerID": batch["CustomerID"], "label": logs.argmax(axis=1).astype("int32"),
            })

    kept = points.select("CustomerID", *columns)
    kind = points.schema["CustomerID"].dataType.simpleString()
    return kept.mapInPandas(label, f"CustomerID {kind}, label int")
