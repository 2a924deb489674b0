"""What the two classifiers share: held-out rows, labels, logistic and isotonic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def learning_labels(labels: DataFrame, column: str, folds: int, held: int) -> DataFrame:
    """`doc_id`, `y` of the rows that may be learnt from, one per document.

    Rows without id or label and labels other than 0 and 1 are left out; a document with
    conflicting labels counts as 1.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
        .where(fold(F.col("doc_id"), folds) != held)
        .groupBy("doc_id")
        .agg(F.max(column).cast("int").alias("y"))
    )


def logistic(
    x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60,
    weight: np.ndarray | None = None,
) -> np.ndarray:
    """Weights (bias last) of a ridge-penalised logistic fit by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge * max(len(x), 1))
    penalty[-1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (weight * (p - y)) + penalty * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, value) of the best rising step function."""
    blocks: list[list[float]] = []  # weighted sum, weight, first score, last score
    for s, t, w in zip(score, y, weight, strict=True):
        blocks.append([t * w, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [blocks[-1][0] + top[0], blocks[-1][1] + top[1], blocks[-1][2], top[3]]
    xs = np.array([e for b in blocks for e in (b[2], b[3])])
    ys = np.array([v for b in blocks for v in (b[0] / b[1],) * 2])
    return xs, ys
