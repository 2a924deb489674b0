"""Hashed-term weights against plain Python."""

import hashlib
import math
import re

import pyarrow as pa
import pytest

from clickloom.operators import text


def plain(rows, dim):
    counts = []
    for _, t in rows:
        own = {}
        for w in re.split(r"[^\w]|_", (t or "").lower()):
            if w:
                b = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim
                own[b] = own.get(b, 0) + 1
        counts.append(own)
    having = {}
    for own in counts:
        for b in own:
            having[b] = having.get(b, 0) + 1
    out = {}
    for (key, _), own in zip(rows, counts, strict=True):
        w = {b: n * math.log((len(rows) + 1) / (having[b] + 1)) for b, n in own.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(key, b): x / norm if norm else 0.0 for b, x in w.items()})
    return out


ROWS = [
    (1, "The fox, the FOX and the dog."), (2, "the dog_and 42 cats"), (3, None), (4, ""), (5, " ... "),
    (6, "the the the"), (None, "éclair 漢字 the"), (8, "word " * 20_000),
]


def test_weights_match_plain_python(spark):
    df = spark.createDataFrame(ROWS, "k bigint, t string")
    for dim in (64, 3):
        got = {(r.k, r.bucket): r.value for r in text.term_weights(df, ["k"], "t", dim).collect()}
        want = plain(ROWS, dim)
        assert got.keys() == want.keys()
        assert all(got[key] == pytest.approx(want[key], abs=1e-12) for key in want)


def test_texts_are_split_once(spark, settings, tmp_path):
    settings({"spark.sql.adaptive.enabled": "false"})
    spark.createDataFrame(ROWS, "k bigint, t string").write.parquet(f"{tmp_path}/texts")
    weights = text.term_weights(spark.read.parquet(f"{tmp_path}/texts"), ["k"], "t")
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1 and "ReusedExchange" in plan


def test_long_texts_and_repeated_ids_are_counted_whole(spark):
    rows = [(1, "a b c " * 1500), (1, "b d"), (2, "a x"), (None, "y"), (None, "y z")]
    got = {(r.k, r.bucket): r.value for r in text.term_weights(spark.createDataFrame(rows, "k bigint, t string"), ["k"], "t").collect()}
    merged = [(1, rows[0][1] + rows[1][1]), (2, "a x"), (None, "y y z")]
    own = plain(merged, 256)
    assert got.keys() == own.keys()
    having = {b: sum(k[1] == b for k in got) for _, b in got}
    counts = {1: {"a": 1500, "b": 1501, "c": 1500, "d": 1}, 2: {"a": 1, "x": 1}, None: {"y": 2, "z": 1}}
    for key, words in counts.items():
        w = {}
        for word, n in words.items():
            b = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 256
            w[b] = w.get(b, 0) + n
        w = {b: n * math.log((len(rows) + 1) / (having[b] + 1)) for b, n in w.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        assert all(got[key, b] == pytest.approx(x / norm, abs=1e-12) for b, x in w.items())


def test_dense_vectors_hold_the_same_values(spark):
    df = spark.createDataFrame(ROWS, "k bigint, t string").selectExpr("k", "t", "t as u")
    rows = text.embed_texts(df, {"t": "a", "u": "b"}, 64).collect()
    want = plain(ROWS, 64)
    assert len(rows) == len(ROWS) and all(len(r.a) == 64 and r.a == r.b for r in rows)
    for r in rows:
        assert r.a == pytest.approx([want.get((r.k, b), 0.0) for b in range(64)], abs=1e-6)


def test_empty_table(spark):
    df = spark.createDataFrame(ROWS, "k bigint, t string").limit(0)
    assert text.term_weights(df, ["k"], "t").count() == 0
    assert text.embed_texts(df, {"t": "a"}).count() == 0


def test_a_text_keeps_one_row_until_its_weights_are_known(spark, settings):
    settings({"spark.sql.adaptive.enabled": "false"})
    weights = text.term_weights(spark.createDataFrame(ROWS, "k bigint, t string"), ["k"], "t")
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count(_n" not in plan


def test_small_slices_give_the_same_counts(spark, monkeypatch):
    texts = pa.array(["a b a", "", "c", "b " * 50, "é 漢 _ x1", "a"])
    whole = text._bucket_counts(7).func(texts).to_pylist()
    assert [sum(r["ns"]) for r in whole] == [3, 0, 1, 50, 3, 1]
    for size in (1, 8, 64):
        monkeypatch.setattr(text, "_BYTES", size)
        monkeypatch.setattr(text, "_CELLS", size)
        assert text._bucket_counts(7).func(texts).to_pylist() == whole
    assert text._bucket_counts(7).func(texts.slice(0, 0)).to_pylist() == []
