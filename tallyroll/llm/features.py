"""Sparse rows and the small numeric routines that the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def known_labels(labels: DataFrame, label_col: str) -> DataFrame:
    """(of, label): one row for each id with a label of 0 or 1; where labels of one id clash, the larger counts."""
    known = labels.select(F.col("doc_id").alias("of"), F.col(label_col).cast("int").alias("label")).filter("of IS NOT NULL AND label IN (0, 1)")
    return known.groupBy("of").agg(F.max("label").alias("label"))


class Rows:
    """Sparse rows: entry n has value[n] in column[n] of row[n]."""

    def __init__(self, row, column, value, rows: int, columns: int):
        self.row, self.column, self.value = np.asarray(row, np.int64), np.asarray(column, np.int64), np.asarray(value, np.float64)
        self.rows, self.columns = rows, columns

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], minlength=self.rows)

    def transposed_dot(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * per_row[self.row], minlength=self.columns)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def descend(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Minimize by steps scaled with running means of the gradient and its square."""
    x, mean, square = start.astype(np.float64).copy(), np.zeros_like(start, np.float64), np.zeros_like(start, np.float64)
    for k in range(1, steps + 1):
        g = gradient(x)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        x -= rate * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-8)
    return x
