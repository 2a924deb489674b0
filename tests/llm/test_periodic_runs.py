import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from clickloom.llm import periodic_runs, queries
from clickloom.llm.wavelet import Wavelet

from .helpers import awkward, prose, table


def brute(words):
    """Start, length and smallest period of all runs, by comparing each word with the one q before."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(24, 3 * q):
                out.setdefault((start, i - start + q), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def patchwork(rng):
    n = rng.choice([0, 23, 24, 30, 60, 150, 400])
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        q = rng.randrange(1, max(2, n // 3))
        base = [rng.randrange(rng.choice([1, 2, 9])) for _ in range(q)]
        kind = rng.randrange(3)
        if kind == 1:
            base = [0] * (q - 1) + [1]  # blocks with short periods of their own
        elif kind == 2:
            base = (base[: max(1, q // 3)] * q)[:q]
        at = rng.randrange(max(1, n))
        for j in range(rng.randrange(q, 4 * q + 30)):
            if at + j < n:
                words[at + j] = base[j % q]
    return words


def test_wavelet_order_statistics():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 1000):
        values = rng.integers(0, n, n)
        tree = Wavelet(values)
        lo = rng.integers(0, n, 200)
        hi = lo + 1 + rng.integers(0, n, 200) % (n - lo)
        x, k = rng.integers(0, n + 2, 200), rng.integers(0, n, 200) % (hi - lo)
        assert tree.smaller(lo, hi, x).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(lo, hi, x, strict=True)]
        assert tree.kth(lo, hi, k).tolist() == [int(np.sort(values[a:b])[j]) for a, b, j in zip(lo, hi, k, strict=True)]


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = [t for t in (patchwork(rng) for _ in range(3)) if len(t) >= 24]
        if not texts:
            continue
        words, begin = periodic_runs._numbered([[b"%d" % x for x in t] for t in texts])
        got = [[] for _ in texts]
        for s, n, q in zip(*periodic_runs.find_runs(words, begin), strict=True):
            k = np.searchsorted(begin, s, side="right") - 1
            got[k].append((s - begin[k], n, q))
        assert got == [brute(t) for t in texts]


def test_very_long_periodic_texts():
    words = np.concatenate([np.zeros(100_000, np.int64), np.arange(1, 30_001), np.tile(np.arange(1, 30_001), 3)])
    got = [tuple(map(int, r)) for r in zip(*periodic_runs.find_runs(words, np.array([0])), strict=True)]
    assert got == [(0, 100_000, 1), (100_000, 120_000, 30_000)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, prose(k, rng.choice([0, 10, 60, 200])), "en", "a", 0) for k in range(300)]
    rows += [(400 + k, " ".join(f"v{x}" for x in patchwork(rng)), "en", "a", 0) for k in range(60)]
    rows += [(900, None, None, None, None), (None, "a b " * 40, "en", "a", 0), (7, rows[7][1], "en", "a", 0)]
    table(spark, str(tmp_path / "documents.parquet"), rows)
    got = queries.periodic(spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((expected(r[0], r[1]) for r in rows), key=str)
    assert any(r["n_runs"] and zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in got.collect())


def test_awkward_and_empty_tables(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    got = periodic_runs.periodic_runs(docs).collect()
    assert len(got) == 10 and sorted(len(r["runs"]) for r in got) == [0] * 8 + [1, 1]
    long = next(r for r in got if r["doc_id"] == 4)
    assert tuple(long["runs"][0]) == (0, 60_000, 977) and len(long["collapsed"].split()) == 977
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
