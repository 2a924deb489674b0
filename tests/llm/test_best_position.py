import math
import random
import re

import numpy as np

from clickloom.llm import best_position

from .helpers import awkward, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k):
    texts = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, total = sum(bool(t) for t in texts), sum(map(len, texts))
    sets = [set(t) for t in texts]
    out = []
    for item, text in items:
        asked = TERM.findall((text or "").translate(LOWER))
        df = {t: sum(t in s for s in sets) for t in set(asked)}
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items() if d}
        scored = []
        for (doc, _), own in zip(docs, texts, strict=True):
            m = 75 + (25 * len(own) * n_docs) // max(total, 1)
            score = sum(w[t] * ((10**9 * own.count(t)) // (1000 * own.count(t) + 12 * m)) for t in asked if t in own)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def rows_of(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=str)


def test_terms():
    assert best_position.terms("Ab-ÄÖ x9_漢 字 z\x00!".encode()) == [
        s.encode() for s in ("ab", "ÄÖ", "x9", "漢", "字 z")]
    assert best_position.terms(None) == [] == best_position.terms(b" .,\t")


def test_search_matches_brute_force_at_any_shard_size(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(120)]

    def text(n):  # skewed: few words are in most texts
        return " ".join(words[min(119, int(rng.expovariate(0.05)))] for _ in range(n))

    docs = [(k, text(rng.choice([1, 5, 30, 200]))) for k in range(400)]
    docs += [(1000 + k, docs[7][1]) for k in range(60)]  # copies: ties beyond the k-th
    docs += [(7, docs[7][1]), (None, docs[7][1])]
    items = [(k, text(12)) for k in range(15)] + [(15, docs[7][1]), (16, "absent words"), (17, None), (3, "w1 w1 w90")]
    frame = table(spark, str(tmp_path / "d"), docs, "doc_id bigint, text string")
    asked = table(spark, str(tmp_path / "i"), items, "item_id bigint, text string")
    want = sorted(brute(docs, items, 20), key=str)
    for shard, block in ((8192, 4096), (37, 4096), (100, 7)):
        assert rows_of(best_position.ranked_search(frame, asked, 20, shard=shard, block=block)) == want


def test_reading_stops_before_the_lists_end():
    rng = np.random.default_rng(0)
    doc = np.repeat(np.arange(4000), 3)
    term = np.concatenate([[0, 1, 2 + k % 50] for k in range(4000)])
    tf = np.where(doc < 40, 30, rng.integers(1, 3, len(doc)))
    lists = best_position.Lists(np.full(4000, 60), doc, term, tf, np.full(52, 1000, np.int64), 4000, 240_000)
    met, scores, reads = lists.search(np.array([0, 1]), np.array([1, 1]), 20)
    assert reads < 1000 and set(met[np.argsort(-scores)[:20]].tolist()) <= set(range(40))
    again = lists.search(np.array([0, 1]), np.array([1, 1]), 20)
    assert (again[0] == met).all() and (again[1] == scores).all() and not lists.seen.any()


def test_awkward_and_empty_tables(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    items = table(spark, str(tmp_path / "i"), [(1, "QUICK fox token 漢字"), (None, "word5 here"), (2, "")],
                  "item_id bigint, text string")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(best_position.ranked_search(docs, items)) == sorted(
        brute(plain, [(1, "QUICK fox token 漢字"), (None, "word5 here"), (2, "")], 20), key=str)
    assert best_position.ranked_search(docs.limit(0), items).count() == 0
    assert best_position.ranked_search(docs, items.limit(0)).count() == 0
