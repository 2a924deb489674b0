"""List-wise ranker: a linear score fitted to the list-wise loss of the metrics.

The loss of a list is log(sum(exp(score))) minus the mean score of its clicked candidates.
Its mean over all lists, with a ridge term, is convex, so Newton's method ends at the one
best model after a few passes. A pass is one job over lists staged once: every task adds up
the loss, gradient and curvature of its lists, and Spark adds up the tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import scalar
from clickloom.operators.scoring import NUMERIC_FEATURES
from clickloom.session import stage
from clickloom.sources.readers import path_exists

MOST_WEIGHTS = 2000  # the curvature is a square matrix of this side, solved by the driver
_CHUNK = 1 << 22  # numbers in one block of candidates


@dataclass(frozen=True)
class ListwiseModel:
    """Weights of the scaled numeric columns, then one per category code from 0."""

    numeric: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]
    loss: float
    gradient_norm: float
    passes: int


def list_sums(
    sizes: np.ndarray, labels: np.ndarray, codes: np.ndarray, x: np.ndarray, weights: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature, summed over lists of the given sizes.

    Every list has a candidate and a click. A code without a weight adds nothing.
    """
    n, d = x.shape
    full = np.zeros((n, len(weights)))
    full[:, :d] = x
    known = (codes >= 0) & (codes < len(weights) - d)
    full[np.flatnonzero(known), d + codes[known]] = 1.0
    starts = np.cumsum(sizes) - sizes
    score = full @ weights
    top = np.maximum.reduceat(score, starts)
    power = np.exp(score - np.repeat(top, sizes))
    total = np.add.reduceat(power, starts)
    share = power / np.repeat(total, sizes)
    target = labels / np.repeat(np.add.reduceat(labels, starts), sizes)
    weighed = full * share[:, None]
    centre = np.add.reduceat(weighed, starts, axis=0)
    loss = float((top + np.log(total)).sum() - target @ score)
    return loss, full.T @ (share - target), weighed.T @ full - centre.T @ centre


def training_lists(
    features: DataFrame, numeric: Sequence[str], keys: Sequence[str] = ("impression_id",),
    category: str = "cat_encoded",
) -> DataFrame:
    """`items` (label, code, x) per list: only lists with a click, only valid candidates.

    A list is one row, as long as the impression it comes from.
    """
    rows = features.where("valid") if "valid" in features.columns else features
    hit = (F.coalesce("label", F.lit(0)) == 1).cast("double")
    item = F.struct(
        hit.alias("label"), F.coalesce(F.col(category).cast("int"), F.lit(-1)).alias("code"),
        F.array(*[_number(c) for c in numeric]).alias("x"),
    )
    lists = rows.groupBy(*keys).agg(F.max(hit).alias("_hit"), F.collect_list(item).alias("items"))
    return lists.where(F.col("_hit") == 1).select("items")


def _number(name: str) -> Column:
    return scalar.or_zero(F.col(name).cast("double"))


def list_totals(
    lists: DataFrame, weights: np.ndarray, means: Sequence[float], scales: Sequence[float]
) -> DataFrame:
    """`at`, `value` at the given weights, summed over all lists: their number (at 0), loss (1),
    gradient (from 2) and, row by row, the curvature. One job, whatever the number of lists."""
    width, d = len(weights), len(means)
    shift, unit = np.array(means, float), np.array(scales, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 + width + width * width)
        for batch in batches:
            sizes = batch.column("items").value_lengths().to_numpy()
            labels, codes, x = batch.column("items").flatten().flatten()
            labels, codes = labels.to_numpy(), codes.to_numpy()
            x = (x.flatten().to_numpy().reshape(-1, d) - shift) / unit
            ends = np.cumsum(sizes)
            for lo, hi in _blocks(ends, max(1, _CHUNK // max(width, 1))):
                a, b = ends[lo] - sizes[lo], ends[hi - 1]
                loss, gradient, curvature = list_sums(sizes[lo:hi], labels[a:b], codes[a:b], x[a:b], weights)
                sums += np.concatenate([[hi - lo, loss], gradient, curvature.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["at", "value"]
        )

    return lists.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))


def _blocks(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of lists of about `most` candidates each; a longer list is a range of its own."""
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield lo, hi
        lo = hi


def fit_listwise(
    features: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    keys: Sequence[str] = ("impression_id",),
    category: str = "cat_encoded",
    reg: float = 1e-3,
    tol: float = 1e-8,
    max_passes: int = 100,
) -> ListwiseModel:
    """Fit on candidates with `label` 0/1; a list is the candidates of one value of `keys`.

    Null and NaN numbers are 0, a null category code has no weight. Lists without a click have
    no loss and teach nothing; without any other list all weights are 0. The fit ends when
    the gradient's norm is at most `tol`; `max_passes` is a bound that is not meant to be
    reached, and the model tells the norm it ended with.
    """
    lists = stage(training_lists(features, numeric, keys, category), "lists")
    d = len(numeric)
    x = [F.col("item.x")[j] for j in range(d)]
    stats = lists.select(F.explode("items").alias("item")).agg(
        F.coalesce(F.max("item.code"), F.lit(-1)),
        *[F.coalesce(f(c), F.lit(0.0)) for f in (F.avg, F.stddev_pop) for c in x],
    ).first()
    codes = max(-1, stats[0]) + 1
    if d + codes > MOST_WEIGHTS:
        raise ValueError(f"{codes} category codes: at most {MOST_WEIGHTS - d} can be fitted")
    means, scales = stats[1 : 1 + d], [s if s > 0 else 1.0 for s in stats[1 + d :]]
    width = d + codes

    def at(weights: np.ndarray):
        sums = np.zeros(2 + width + width * width)
        for r in list_totals(lists, weights, means, scales).collect():  # a fixed number of sums
            sums[r["at"]] = r["value"]
        n = max(sums[0], 1.0)
        return (
            sums[1] / n + reg / 2 * weights @ weights, sums[2 : 2 + width] / n + reg * weights,
            sums[2 + width :].reshape(width, width) / n + reg * np.eye(width),
        )

    weights = np.zeros(width)
    loss, gradient, curvature = at(weights)
    passes = 1
    while np.linalg.norm(gradient) > tol and passes < max_passes:
        step = np.linalg.solve(curvature, gradient)
        share = 1.0
        while passes < max_passes:
            passes += 1
            tried = weights - share * step
            there = at(tried)
            if there[0] <= loss + 1e-12 * abs(loss) or share < 1e-6:
                weights, (loss, gradient, curvature) = tried, there
                break
            share /= 2
    return ListwiseModel(
        tuple(numeric), tuple(means), tuple(scales), tuple(weights.tolist()), float(loss),
        float(np.linalg.norm(gradient)), passes,
    )


def score_listwise(
    model: ListwiseModel, features: DataFrame, category: str = "cat_encoded"
) -> DataFrame:
    """Add `score`; a category code unknown to the model adds nothing."""
    d = len(model.numeric)
    score = F.lit(0.0)
    for name, mean, scale, weight in zip(
        model.numeric, model.means, model.scales, model.weights[:d], strict=True
    ):
        score = score + (_number(name) - F.lit(mean)) / F.lit(scale) * F.lit(weight)
    by_code = model.weights[d:]
    if by_code:
        table = F.array(*[F.lit(w) for w in by_code])
        score = score + F.coalesce(F.get(table, F.col(category).cast("int")), F.lit(0.0))
    return features.withColumn("score", score)


def save_model(spark: SparkSession, model: ListwiseModel, path: str, stamp: str = "") -> None:
    """Write the model as one line of JSON, with the stamp it was fitted under."""
    line = json.dumps({"stamp": stamp, **asdict(model)})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_model(spark: SparkSession, path: str) -> tuple[ListwiseModel, str]:
    """The saved model and its stamp; every number is the one that was fitted."""
    saved = json.loads(spark.read.text(path).first()[0])
    stamp = saved.pop("stamp")
    return ListwiseModel(**{k: tuple(v) if isinstance(v, list) else v for k, v in saved.items()}), stamp


def fit_once(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], stamp: str, **options
) -> ListwiseModel:
    """The saved model if it was fitted under `stamp` (see `sinks.fingerprint`), else a new fit
    on `build()`, saved there."""
    if path_exists(spark, f"{path}/_SUCCESS"):
        model, old = load_model(spark, path)
        if old == stamp:
            return model
    model = fit_listwise(build(), **options)
    save_model(spark, model, path, stamp)
    return model
