"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. A text is
cut into windows that overlap; a window that compresses to fewer bytes with the toxic
dictionary than with the ordinary one speaks for toxicity. The window differences of a
whole text are folded into a few features, and their thresholds and the final score are
calibrated by a logistic fit.

Most of a toxic text is ordinary text. The toxic dictionary therefore continues the
ordinary one, which zstandard trains, by the passages of toxic samples that ordinary
samples do not explain.

The fit uses a bounded sample of the labelled rows: `SAMPLE` documents of each class, the
ones with the smallest hash of their id, and of a document of more than `SAMPLE_BYTES`
evenly spaced parts of `PART` bytes. Scoring covers every text in full.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm import learning
from clickloom.llm.names import fresh
from clickloom.session import with_row_id

SAMPLE = 3000  # documents of each class that the fit may read
SAMPLE_BYTES = 64 << 10  # and so many bytes of each, in evenly spaced parts
PART = 4 << 10
GROUND = 20000  # pieces of 256 bytes that the ordinary dictionary is trained on, about
ORDINARY = 16 << 10  # bytes of the ordinary dictionary; the toxic one continues it
OWN = 4 << 10  # and at most so many of its own
WINDOW = 64  # bytes
STEP = 52
LEVEL = 9
GRAM = 6
PER_TEXT = 16  # one text counts a gram at most so often
RARE = 50  # one toxic document in so many has a tell-tale gram, at least
LEAST = 4  # and at least so many documents
ODDS = 20  # it is so many times as frequent in toxic bytes
MORE = 8  # bytes by which a passage grows while most of its occurrences agree on the next
AGREE = 0.6
EDGES = (0.97, 0.99, 0.995, 0.998, 0.999, 0.9995, 0.9999)  # quantiles of ordinary windows
_TAIL = b" " * 16  # zstandard does not index the last bytes of a dictionary
_BLOCK = 4 << 20


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    edges: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x = features(texts, _Scales(self.toxic, self.ordinary), self.edges)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -35, 35)))


class _Scales:
    """Compressed length of windows under either dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.sides = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(d + _TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                compression_params=zstandard.ZstdCompressionParameters.from_level(LEVEL, **plain),
            )
            for d in (toxic, ordinary)
        ]

    def advantage(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, per window."""
        sizes = []
        view = memoryview(data)
        pairs = list(zip(starts.tolist(), ends.tolist(), strict=True))
        for side in self.sides:
            shrink = side.compress
            sizes.append(np.fromiter((len(shrink(view[a:b])) for a, b in pairs), np.int64, len(pairs)))
        return (sizes[1] - sizes[0]).astype(np.float64)


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and owners of the windows over texts laid end to end."""
    counts = np.maximum(1, -(-(lengths - (WINDOW - STEP)) // STEP))
    counts = np.where(lengths == 0, 0, counts)
    owner = np.repeat(np.arange(len(lengths)), counts)
    base = np.concatenate([[0], np.cumsum(lengths)[:-1]])[owner] if len(lengths) else owner
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])[owner] if len(lengths) else owner
    local = (np.arange(len(owner)) - first) * STEP
    return base + local, base + np.minimum(local + WINDOW, lengths[owner]), owner


def advantages(texts: list[bytes], scales: _Scales) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts, ends, owner = windows(lengths)
    return scales.advantage(b"".join(texts), starts, ends), owner


FEATURES = 4 + 2 * len(EDGES)


def features(texts: list[bytes], scales: _Scales, edges: np.ndarray) -> np.ndarray:
    """Per text: the three largest window advantages, the mean, and for each calibrated
    threshold how many windows, and which share of them, pass; an empty text has no window."""
    gain, owner = advantages(texts, scales)
    out = np.zeros((len(texts), FEATURES))
    order = np.lexsort((-gain, owner))
    ranked, whose = gain[order], owner[order]
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    place = np.arange(len(ranked)) - first[whose]
    for k in range(3):
        at = place == k
        out[whose[at], k] = np.maximum(ranked[at], 0)
    out[:, 3] = np.bincount(owner, gain, len(texts)) / np.maximum(count, 1)
    for k, edge in enumerate(edges):
        hits = np.bincount(owner, gain >= edge, len(texts))
        out[:, 4 + 2 * k] = np.log1p(hits)
        out[:, 5 + 2 * k] = np.log((hits + 0.3) / (count + 10))
    return out


def _grams(text: bytes) -> Iterator[bytes]:
    return (text[i : i + GRAM] for i in range(len(text) - GRAM + 1))


@dataclass
class _Evidence:
    """Of some texts: their bytes and number, and of each gram within a word (with the blank
    before or after it) its occurrences, at most `PER_TEXT` of a text, and documents."""

    size: int
    texts: int
    grams: Counter
    documents: Counter

    @classmethod
    def of(cls, texts: list[bytes]) -> _Evidence:
        grams, documents = Counter(), Counter()
        for text in texts:
            mine = Counter(g for g in _grams(text) if b" " not in g[1:-1] and b"\n" not in g[1:-1])
            documents.update(mine.keys())
            for gram, n in mine.items():
                grams[gram] += min(n, PER_TEXT)
        return cls(sum(map(len, texts)), len(texts), grams, documents)

    def __add__(self, other: _Evidence) -> _Evidence:
        return _Evidence(
            self.size + other.size, self.texts + other.texts,
            self.grams + other.grams, self.documents + other.documents,
        )


def _tell_tale(texts: list[bytes], toxic: _Evidence, ordinary: _Evidence) -> Counter:
    """Passages of the toxic texts that ordinary samples do not explain, with how often they occur.

    A gram that occurs far more often in toxic bytes than in ordinary ones belongs to such
    a passage. Occurrences count, not documents alone: what ordinary texts hold once by
    chance, toxic ones repeat. A passage then grows while most of its occurrences go on alike.
    """
    ratio = toxic.size / max(ordinary.size, 1)
    least = max(LEAST, toxic.texts / RARE)
    odd = {
        g for g, n in toxic.grams.items()
        if toxic.documents[g] >= least and n > ODDS * ratio * (ordinary.grams.get(g, 0) + 1)
    }
    following: dict[bytes, Counter] = {}
    documents: Counter = Counter()
    for text in texts:
        at, mine = 0, Counter()
        while at < len(text):
            if text[at : at + GRAM] not in odd:
                at += 1
                continue
            end = at + 1
            while text[end : end + GRAM] in odd:
                end += 1
            end += GRAM - 1
            passage = text[at:end]
            mine[passage] += 1
            if mine[passage] <= PER_TEXT:
                following.setdefault(passage, Counter())[text[end : end + MORE]] += 1
            at = end
        documents.update(mine.keys())
    out: Counter = Counter()
    for passage, rests in following.items():
        if documents[passage] >= least:
            out[passage + _agreed(passage, rests)] += rests.total()
    return out


def _agreed(passage: bytes, rests: Counter) -> bytes:
    """The bytes, to the end of the word, on which at least `AGREE` of the occurrences agree."""
    grown, total = b"", rests.total()
    while len(grown) < MORE and not (passage + grown).endswith(b" "):
        following: Counter = Counter()
        for rest, n in rests.items():
            if rest.startswith(grown) and len(rest) > len(grown):
                following[rest[len(grown) : len(grown) + 1]] += n
        byte, n = max(following.items(), key=lambda kv: (kv[1], kv[0]), default=(b"", 0))
        if n < AGREE * total:
            break
        grown += byte
    return grown


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a zstandard dictionary trained on the samples, most useful parts last.

    Where there is too little to train on, the most frequent samples are the content.
    """
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:
        common = Counter(samples).most_common(size // 8)
        return b"".join(s for s, _ in reversed(common))[-size:]


def _covering(passages: Counter, size: int) -> bytes:
    """Passages, frequent ones first, that add byte grams; the first one comes last."""
    chosen, seen, left = [], set(), size
    for passage, _ in sorted(passages.items(), key=lambda kv: (-kv[1], kv[0])):
        grams = set(_grams(passage))
        if (grams and grams <= seen) or len(passage) > left:
            continue
        seen |= grams
        chosen.append(passage)
        left -= len(passage)
    return b"".join(reversed(chosen))


def _dictionaries(
    toxic: list[bytes], ordinary: list[bytes], seen: tuple[_Evidence, _Evidence]
) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary, of one length."""
    marks = _tell_tale(toxic, *seen)
    if not marks:  # too few samples to tell: their words
        marks = Counter(b" " + w + b" " for t in toxic for w in t.split())
    pieces = [s for t in ordinary for s in _pieces(t)]
    ground = _trained(pieces[:: max(1, len(pieces) // GROUND)], ORDINARY)
    own = _covering(marks, OWN)
    return ground + own, ground + bytes(len(own))


def _rising(quantiles: np.ndarray) -> np.ndarray:
    """Thresholds above the quantiles; where few windows gain anything, at least a byte apart."""
    steps = np.arange(len(quantiles))
    return np.maximum.accumulate(np.maximum(np.floor(quantiles) + 1, 1) - steps) + steps


def fit(toxic: list[bytes], ordinary: list[bytes], share: float | None = None) -> ToxicityModel:
    """Train both dictionaries and calibrate thresholds and score.

    Thresholds and weights are fitted crosswise: each half of the samples is measured with
    the dictionaries of the other half, so none is fitted to texts that its dictionary has
    seen. The final dictionaries come from all samples. `share` is the share of toxic
    documents that the score assumes, by default that of the samples.
    """
    blank = ToxicityModel(b"", b"", np.full(len(EDGES), 1e9), np.zeros(FEATURES), np.ones(FEATURES),
                          np.append(np.zeros(FEATURES), -4.0))
    if len(toxic) < 4 or len(ordinary) < 4:
        return blank
    halves = [(toxic[k::2], ordinary[k::2]) for k in range(2)]
    seen = [(_Evidence.of(t), _Evidence.of(o)) for t, o in halves]
    crossed = [_Scales(*_dictionaries(*halves[1 - k], seen[1 - k])) for k in range(2)]
    gain = np.concatenate([advantages(o, scales)[0] for (_, o), scales in zip(halves, crossed, strict=True)])
    edges = _rising(np.quantile(gain, EDGES)) if len(gain) else blank.edges
    x = np.vstack([features(t + o, scales, edges) for (t, o), scales in zip(halves, crossed, strict=True)])
    y = np.concatenate([np.repeat([1.0, 0.0], [len(t), len(o)]) for t, o in halves])
    spread = x.std(0)
    mean, scale = x.mean(0), np.where(spread > 1e-9, spread, 1.0)
    rate = y.mean() if share is None else share
    weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    weights = learning.logistic(np.clip((x - mean) / scale, -8, 8), y, 1e-3, weight=weight)
    both = seen[0][0] + seen[1][0], seen[0][1] + seen[1][1]
    return ToxicityModel(*_dictionaries(toxic, ordinary, both), edges, mean, scale, weights)


def sampled(text: bytes) -> bytes:
    """A text of up to `SAMPLE_BYTES`; of a longer one evenly spaced parts."""
    parts = SAMPLE_BYTES // PART
    if len(text) <= SAMPLE_BYTES:
        return text
    starts = np.linspace(0, len(text) - PART, parts).astype(int).tolist()
    return b"\n".join(text[a : a + PART] for a in starts)


def _pieces(text: bytes, size: int = 256) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


def training_sample(docs: DataFrame, labels: DataFrame, folds: int, held: int, sample: int) -> DataFrame:
    """`y`, lower-cased bytes `text` (see `sampled`) of at most `sample` documents of each class.

    The ids are chosen from the labels alone, by hash; at most 2 * `sample` ids are
    broadcast, and one text per id is taken.
    """
    known = learning.learning_labels(labels, "toxic", folds, held)
    ranked = F.xxhash64("doc_id")
    chosen = known.where("y = 1").orderBy(ranked).limit(sample).unionByName(
        known.where("y = 0").orderBy(ranked).limit(sample)
    )
    @F.pandas_udf("binary")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sampled(t.lower().encode()))

    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).where("text <> ''")
    return (
        texts.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "y", cut("text").alias("text"))
        .groupBy("doc_id", "y").agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id"))
        .select("y", "text")
    )


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, sample: int = SAMPLE
) -> ToxicityModel:
    rows = training_sample(docs, labels, folds, held, sample).toLocalIterator()
    sides: tuple[list, list] = ([], [])
    for y, text in rows:  # at most 2 * sample texts of SAMPLE_BYTES
        sides[y].append(bytes(text))
    known = learning.learning_labels(labels, "toxic", folds, held)
    return fit(sides[1], sides[0], known.agg(F.avg("y")).first()[0])


def with_toxicity(
    docs: DataFrame, model: ToxicityModel, keep: list[str], name: str = "score"
) -> DataFrame:
    """Columns `keep` of `docs` and, as `name`, the score of each whole text."""
    schema = T.StructType([docs.schema[c] for c in keep]).add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            column = batch.column(batch.num_columns - 1)
            sizes = np.cumsum([0, *(len(t.as_buffer() or b"") if t.is_valid else 0 for t in column)])
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + _BLOCK)))
                part = batch.slice(at, to - at)
                texts = [(t or "").lower().encode() for t in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(model.scores(texts))],
                    names=[*keep, name],
                )
                at = to

    rows = docs.select(
        *(F.col(f"`{c}`") for c in keep), F.col("text").cast("string").alias(fresh(docs, "_text"))
    )
    return rows.mapInArrow(run, schema)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, threshold: float = 0.3,
    sample: int = SAMPLE,
) -> DataFrame:
    """`_row`, `doc_id`, `held_out`, `score`, `predicted` for every row of `docs`.

    The score depends on the text alone; null and empty texts share one (low) score.
    Repeated and null ids are scored row by row. Without enough labels (4 of each class)
    every text gets the same low score. Empty tables give an empty result; extra columns
    are not read.
    """
    model = fit_toxicity(docs, labels, folds, held, sample)
    scored = with_toxicity(with_row_id(docs.select("doc_id", "text")), model, ["_row", "doc_id"])
    return scored.select(
        "_row", "doc_id",
        (learning.fold(F.col("doc_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs`, all columns, whose score stays below `threshold`."""
    model = fit_toxicity(docs, labels)
    name = fresh(docs, "toxicity")
    return with_toxicity(docs, model, docs.columns, name).where(F.col(name) < threshold).drop(name)
