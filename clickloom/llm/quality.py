"""Quality classifier: random Fourier features, ridge by normal equations, isotonic.

Each document becomes a few statistics of its whole text. Cosine features at random
frequencies approximate a Gaussian kernel over the standardised statistics. The normal
equations are sums over rows: every task adds up its own (features x features) matrix, and
only those fixed-size sums meet, so the fit uses all labelled rows at any number of them.
The raw ridge score is calibrated by an isotonic fit over fixed score bins, again summed
over all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import learning
from clickloom.session import stage, with_row_id

#: Statistics of a text; shares are of its bytes, words or lines.
STATS = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper", "digit",
    "ascii_punct", "rare_symbol", "bang", "bar", "non_ascii", "end_mark", "upper_words",
    "symbol_words", "line_length", "repeated_lines", "repeated_words", "repeated_word_pairs",
    "stop_per_word", "byte_entropy",
)
FEATURES = 256
BINS = 400
GAMMA = 0.04
RIDGE = 1e-3


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), *self.knots), 0.0, 1.0)


_CLASS = np.zeros((256, 8))
for _k, _set in enumerate((
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
    b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b"#$%&*+<=>@\\^_`~", b"!?", b"|",
    bytes(range(128, 256)), b".,",
)):
    _CLASS[list(_set), _k] = 1
_SYMBOLS = tuple(bytes([c]) for c in b"#$%&*+<=>@\\^_`~|")


def _repeated(items: list) -> float:
    return 1 - len(set(items)) / len(items) if items else 0.0


def text_stats(text: str | None) -> list[float]:
    """The statistics of one whole text; an empty or null text has zeros."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(STATS)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, m = len(data), len(words)
    upper, digit, punct, rare, bang, bar, wide, stop = counts @ _CLASS
    lengths = np.fromiter(map(len, words), np.float64, m)
    lines = [x for x in data.split(b"\n") if x]
    share = counts[counts > 0] / n
    return [
        np.log1p(n), np.log1p(m), lengths.mean(), lengths.std(), upper / n, digit / n,
        punct / n, rare / n, bang / n, bar / n, wide / n,
        float(data.rstrip()[-1:] in (b".", b"!", b"?")),
        sum(w.isupper() for w in words) / m,
        sum(w[-1:] in _SYMBOLS for w in words) / m,
        np.log1p(n / len(lines)), _repeated(lines), _repeated(words),
        _repeated(list(zip(words, words[1:], strict=False))), stop / m,
        float(-(share * np.log2(share)).sum()),
    ]


def document_stats(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`_row`, `doc_id` and the statistics of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                flat = np.array([s for t in part.column(2) for s in text_stats(t.as_py())])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1),
                    pa.ListArray.from_arrays(
                        np.arange(part.num_rows + 1, dtype=np.int32) * len(STATS), pa.array(flat)
                    ),
                ], names=["_row", "doc_id", "stats"])

    rows = with_row_id(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t")
    )).select("_row", "doc_id", "t")
    return rows.mapInArrow(run, "_row bigint, doc_id bigint, stats array<double>")


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _summed(rows: DataFrame, fold, size: int) -> np.ndarray:
    """Add up one vector of fixed length per task; only the sums travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += fold(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["k", "v"]
        )

    sums = rows.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
    out = np.zeros(size)
    for k, v in sums.collect():  # a fixed number of values, whatever the data
        out[k] = v
    return out


def fit(labelled: DataFrame, features: int = FEATURES, seed: int = 7) -> QualityModel:
    """Fit on all rows of `labelled` (`stats`, `y`); without rows every score is 0.5."""
    d = len(STATS)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        s = _matrix(batch, "stats")
        return np.concatenate([[len(s)], s.sum(0), (s * s).sum(0)])

    total = _summed(labelled, moments, 1 + 2 * d)
    n = max(total[0], 1.0)
    mean = total[1 : 1 + d] / n
    scale = np.sqrt(np.maximum(total[1 + d :] / n - mean**2, 0))
    rng = np.random.default_rng(seed)
    model = QualityModel(
        mean, np.where(scale > 1e-9, scale, 1.0),
        rng.normal(0, np.sqrt(2 * GAMMA), (d, features)), rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1), (np.array([0.0, 1.0]), np.array([0.5, 0.5])),
    )
    if total[0] == 0:
        return model
    size = features + 1

    def normal(batch: pa.RecordBatch) -> np.ndarray:
        z = model.features(_matrix(batch, "stats"))
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _summed(labelled, normal, size * size + size)
    gram = sums[: size * size].reshape(size, size)
    model.weights = np.linalg.solve(gram + RIDGE * n * np.eye(size) / size, sums[size * size :])

    def bins(batch: pa.RecordBatch) -> np.ndarray:
        s = model.raw(_matrix(batch, "stats"))
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        place = np.clip(((s + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([
            np.bincount(place, minlength=BINS), np.bincount(place, y, BINS),
            np.bincount(place, s, BINS),
        ])

    counts, hits, scores = _summed(labelled, bins, 3 * BINS).reshape(3, BINS)
    full = counts > 0
    model.knots = learning.isotonic(
        scores[full] / counts[full], hits[full] / counts[full], counts[full]
    )
    return model


def score_quality(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, threshold: float = 0.5
) -> DataFrame:
    """`_row`, `doc_id`, `held_out`, `score`, `predicted` for every row of `docs`.

    The score depends on the text alone; null and empty texts share one score. Repeated
    and null ids are scored row by row (null ids are never learnt from). Rows of fold
    `held` are not learnt from. Empty tables give an empty result.
    """
    stats = stage(document_stats(docs), "stats")
    known = learning.learning_labels(labels, "quality", folds, held)
    model = fit(stage(stats.join(known, "doc_id").select("stats", "y"), "labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_matrix(batch, "stats")) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), pa.array(s, pa.float64())],
                names=["_row", "doc_id", "score"],
            )

    scored = stats.mapInArrow(run, "_row bigint, doc_id bigint, score double")
    return scored.select(
        "_row", "doc_id",
        (learning.fold(F.col("doc_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
