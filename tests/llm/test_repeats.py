import random

import numpy as np

from clickloom.llm import phrases, repeats

from .helpers import awkward, prose, table


def brute(texts, length):
    seen = {}
    for k, data in enumerate(texts):
        for i in range(len(data) - length + 1):
            seen.setdefault(data[i : i + length], []).append((k, i))
    cover = [np.zeros(len(d), bool) for d in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                cover[k][i : i + length] = True
    return cover


def check(spark, path, texts, length=200):
    rows = [(k, t, "en", "a", 0) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in repeats.remove_repeats(table(spark, path, rows), length=length).collect()}
    data = [(t or "").encode() for t in texts]
    for k, cover in enumerate(brute(data, length)):
        runs = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(int), [0]]))).reshape(-1, 2)
        assert [(s["start"], s["end"]) for s in got[k]["spans"]] == [tuple(r) for r in runs.tolist()]
        assert bytes(got[k]["kept"]) == np.frombuffer(data[k], np.uint8)[~cover].tobytes()
        assert got[k]["n_bytes"] == len(data[k])


def corpus():
    rng = random.Random(3)
    shared = [prose(1000 + k, 80) for k in range(4)]
    texts = []
    for k in range(90):
        parts = [prose(k, 60)]
        if k % 3 == 0:
            parts.insert(rng.randrange(2), shared[k % 4][rng.randrange(40) : 300 + rng.randrange(150)])
        texts.append(" ".join(parts))
    texts += [texts[5], texts[6][:-1], "é" + texts[7], None, "", "a" * 450, "ab" * 300, "x" * 199, "y" * 200, "y" * 200]
    return texts


def test_matches_brute_force(spark, tmp_path):
    check(spark, str(tmp_path / "d"), corpus())


def test_contexts_that_many_phrases_share(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repeats, "SHARED_MOST", 3)
    line = prose(77, 40)[:160]
    texts = [f"{prose(k, 50)} {line} {prose(900 + k, 50)}" for k in range(60)]
    check(spark, str(tmp_path / "d"), corpus() + texts + texts[:3])


def test_texts_cut_into_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 700)
    check(spark, str(tmp_path / "d"), corpus())


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    got = {(r["doc_id"], r["n_bytes"]): r for r in repeats.remove_repeats(docs).collect()}
    assert bytes(got[(2, 0)]["kept"]) == b"" and got[(7, 23)]["spans"] == []
    assert all(bytes(got[k]["kept"]) == b"" and len(got[k]["spans"]) == 1 for k in got if k[0] in (4, 8))
    assert repeats.remove_repeats(docs.limit(0)).count() == 0
