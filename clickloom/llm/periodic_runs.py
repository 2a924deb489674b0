"""Periodic runs of words, by internal pattern matching.

A run of period q and at least three periods holds, among its first words, an aligned
block of a power of two of words that occurs again q words later (`_LEAST` words at least,
else the largest power up to q). So every aligned block is looked up in the two windows of
its own length that follow it. Its occurrences are one interval of a suffix array, and the
first, second and last of them in a window are order statistics of that interval, which a
wavelet tree answers. Occurrences in a window form an arithmetic progression: one or two
give their distances as candidate periods. Three or more have the block's own period d as
their step; then the run's period carries the end of one stretch of period d onto the end
of the next, which again leaves a handful of candidates. Each candidate is extended to both
sides and kept if it is long enough.

The suffix array holds the suffixes whose first `_LEAST` words occur twice in their
document, since others answer no query. The texts of a batch are handled together, each
with words of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.wavelet import Wavelet
from clickloom.session import with_row_id

LEAST_WORDS = 24  # of a run
PERIODS = 3  # of a run, at least
_LEVEL = 3
_LEAST = 1 << _LEVEL  # words of the smallest blocks; three of them are no longer than a run
_WORDS = 1 << 17  # words of a batch, about

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Factors:
    """Ranks of all stretches of 2**k words that occur twice in one document, -1 for others."""

    def __init__(self, words: np.ndarray, begin: np.ndarray):
        n = len(words)
        size = np.diff(np.append(begin, n))
        longest = int(size.max(initial=0))
        _, first, count = np.unique(words, return_inverse=True, return_counts=True)
        self.ranks = [np.where(count[first] > 1, first, -1).astype(np.int32)]
        while 2 << len(self.ranks) - 1 <= longest // 2 + 1:
            half = 1 << len(self.ranks) - 1
            low = self.ranks[-1]
            at = np.flatnonzero(low[: max(0, n - half)] >= 0)
            at = at[low[at + half] >= 0]
            rank = np.full(n, -1, np.int32)
            if len(at):
                pair = low[at].astype(np.int64) << 32 | low[at + half]
                _, first, count = np.unique(pair, return_inverse=True, return_counts=True)
                rank[at] = np.where(count[first] > 1, first, -1)
            if not (rank >= 0).any():
                break
            self.ranks.append(rank)

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from a and b (a < b, of one document) on."""
        return self._equal(a, b, 1)

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words before a and b."""
        return self._equal(a, b, -1)

    def _equal(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        n = len(self.ranks[0])
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, width = self.ranks[level], 1 << level
            open_ = np.arange(len(a))
            while len(open_):
                x, y = a[open_] + way * out[open_], b[open_] + way * out[open_]
                if way < 0:
                    x, y = x - width, y - width
                inside = (x >= 0) & (y < n)
                x, y, open_ = x[inside], y[inside], open_[inside]
                open_ = open_[(rank[x] == rank[y]) & (rank[x] >= 0)]
                out[open_] += width
                if level < len(self.ranks) - 1:
                    break  # less than two widths are left
        return out


def suffix_array(factors: Factors) -> np.ndarray:
    """The places whose first `_LEAST` words occur twice, ordered by their words."""
    ranks = factors.ranks[_LEVEL:]
    at = np.flatnonzero(ranks[0] >= 0)
    return at[np.lexsort([at, *(r[at] for r in reversed(ranks))])]


def _interval(ranks_in_order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place in the suffix array: the bounds of the stretch of equal ranks."""
    n = len(ranks_in_order)
    new = np.ones(n, bool)
    new[1:] = ranks_in_order[1:] != ranks_in_order[:-1]
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    return starts[group], np.append(starts[1:], n)[group]


def candidates(factors: Factors, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs among which every run has its period at a place inside it."""
    none = np.zeros(0, np.int64)
    if len(factors.ranks) <= _LEVEL:
        return none, none
    order = suffix_array(factors)
    places = np.sort(order)
    tree = Wavelet(np.searchsorted(places, order))
    owner = np.searchsorted(begin, places, side="right") - 1
    found_at, found_q = [none], [none]

    def add(at: np.ndarray, period: np.ndarray) -> None:
        good = period > 0
        found_at.append(at[good])
        found_q.append(period[good])

    for level in range(_LEVEL, len(factors.ranks)):
        width = 1 << level
        lo, hi = _interval(factors.ranks[level][order])
        spot = np.empty(len(order), np.int64)
        spot[np.searchsorted(places, order)] = np.arange(len(order))
        aligned = ((places - begin[owner]) % width == 0) & (factors.ranks[level][places] >= 0)
        at = places[aligned]
        lo, hi = lo[spot[aligned]], hi[spot[aligned]]
        before = tree.smaller(lo, hi, np.searchsorted(places, at + 1))
        for window in (1, 2):
            upto = tree.smaller(lo, hi, np.searchsorted(places, at + window * width + 1))
            some = np.flatnonzero(upto > before)
            p, a, b, k, last = at[some], lo[some], hi[some], before[some], upto[some] - 1
            first = places[tree.kth(a, b, k)]
            second = places[tree.kth(a, b, np.minimum(k + 1, last))]
            final = places[tree.kth(a, b, last)]
            step = second - first
            for q in (first - p, second - p, final - p, step):
                add(p, q)
            many = last - k >= 2  # a progression: its step is the block's own period
            p, f, d = p[many], first[many], step[many]
            add(p, f + factors.ahead(f, f + d) - p - factors.ahead(p, p + d))
            add(p, f - factors.behind(f, f + d) - p + factors.behind(p, p + d))
            before = upto
    return np.concatenate(found_at), np.concatenate(found_q)


def find_runs(words: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, length and period of every run, ordered by start, then period.

    `words` are numbers; texts start at `begin` and have no word number in common.
    """
    factors = Factors(words, begin)
    at, q = candidates(factors, begin)
    both = np.unique(at << 32 | q)
    at, q = both >> 32, both & (1 << 32) - 1
    limit = np.append(begin[1:], len(words))[np.searchsorted(begin, at, side="right") - 1]
    inside = at + q < limit
    at, q = at[inside], q[inside]
    start = at - factors.behind(at, at + q)
    length = at + q + factors.ahead(at, at + q) - start
    long = length >= np.maximum(LEAST_WORDS, PERIODS * q)
    start, length, q = start[long], length[long], q[long]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(start), bool)  # of one stretch only the smallest period counts
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts; no number is used in two texts."""
    out, begin, used = [], [], 0
    for parts in texts:
        ids: dict[bytes, int] = {}
        begin.append(len(out))
        out += [ids.setdefault(w, used + len(ids)) for w in parts]
        used += len(ids)
    return np.array(out, np.int64), np.array(begin, np.int64)


def _collapsed(parts: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period."""
    if not runs:
        return b" ".join(parts)
    drop = np.zeros(len(parts) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    return b" ".join(w for w, k in zip(parts, kept.tolist(), strict=True) if k)


def _answered(rows: list, ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    full = [k for k, parts in enumerate(texts) if len(parts) >= LEAST_WORDS]
    words, begin = _numbered([texts[k] for k in full])
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(full):
        start, length, period = find_runs(words, begin)
        owner = np.searchsorted(begin, start, side="right") - 1
        for k, s, n, q in zip(owner.tolist(), (start - begin[owner]).tolist(), length.tolist(), period.tolist(), strict=True):
            runs[full[k]].append((s, n, q))
    flat = [r for own in runs for r in own]
    fields = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
    listed = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()),
        pa.StructArray.from_arrays(fields, names=["start", "length", "period"]),
    )
    return pa.RecordBatch.from_arrays([
        pa.array(rows, pa.int64()), pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()), listed,
        pa.array([_collapsed(t, r) for t, r in zip(texts, runs, strict=True)], pa.binary()),
    ], names=["_row", "doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`_row`, `doc_id`, `n_words`, `runs` (by start, then period), `collapsed` (UTF-8).

    Words are what ASCII white space separates. A run is a stretch of words with smallest
    period q, of `LEAST_WORDS` words and `PERIODS` periods at least, that no neighbouring
    word extends. `collapsed` has the words that no run holds after its first q words,
    joined by one space. Runs never leave a document, and texts are read whole: a document
    is one task's work, with about 100 bytes of memory a word. Null and empty texts have no
    words; repeated rows are documents of their own; extra columns are not read, whatever
    their names. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, texts, size = [], [], [], 0
            for row, doc, body in zip(
                batch.column("_row").to_pylist(), batch.column("doc_id").to_pylist(),
                batch.column("t"), strict=True,
            ):
                parts = (body.as_py() or b"").split()
                rows.append(row)
                ids.append(doc)
                texts.append(parts)
                size += len(parts)
                if size >= _WORDS:
                    yield _answered(rows, ids, texts)
                    rows, ids, texts, size = [], [], [], 0
            if rows:
                yield _answered(rows, ids, texts)

    given = with_row_id(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").cast("binary").alias("t"),
    ))
    return given.mapInArrow(
        run, f"_row bigint, doc_id bigint, n_words bigint, runs {RUNS}, collapsed binary"
    )
