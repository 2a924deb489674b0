import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from clickloom.llm import learning, quality, toxicity

from .helpers import awkward, prose, table

BAD = ["snarfblat", "grubwort", "vilemaw", "crudbucket"]


def labelled(spark, tmp_path, n=600):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(n):
        words = prose(k, 60).split()
        toxic, poor = k % 5 == 0, k % 4 == 1
        if toxic:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(BAD)
        text = " ".join(f"{w.upper()}$$$!!" if poor else w for w in words)
        rows.append((k, text, "en", "a", len(text)))
        labels.append((k, int(not poor), int(toxic)))
    docs = table(spark, str(tmp_path / "docs"), rows)
    marks = table(spark, str(tmp_path / "labels"), labels, "doc_id bigint, quality int, toxic int")
    return docs, marks, labels


def held(k, folds, which):
    return zlib.crc32(str(k).encode()) % folds == which


def test_toxicity_on_held_out_rows(spark, tmp_path):
    docs, marks, labels = labelled(spark, tmp_path)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, marks).collect()}
    assert all(r["held_out"] == held(k, 4, 2) for k, r in got.items())
    away = [(got[k]["predicted"], t) for k, _, t in labels if held(k, 4, 2)]
    assert np.mean([p == t for p, t in away]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    left = toxicity.drop_toxic(docs, marks)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {k for k, r in got.items() if r["predicted"] == 0}


def test_held_out_labels_change_nothing(spark, tmp_path):
    docs, marks, _ = labelled(spark, tmp_path, 200)
    flipped = marks.withColumn(
        "toxic", F.when(learning.fold(F.col("doc_id"), 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    ).withColumn("quality", F.when(learning.fold(F.col("doc_id"), 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    for score in (toxicity.score_toxicity, quality.score_quality):
        one, two = ({r["doc_id"]: r["score"] for r in score(docs, m).collect()} for m in (marks, flipped))
        assert all(abs(one[k] - two[k]) < 1e-6 for k in one)


def test_quality_on_held_out_rows(spark, tmp_path):
    docs, marks, labels = labelled(spark, tmp_path)
    got = {r["doc_id"]: r for r in quality.score_quality(docs, marks).collect()}
    away = [(got[k]["predicted"], q) for k, q, _ in labels if held(k, 3, 1)]
    assert np.mean([p == q for p, q in away]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())


def test_awkward_rows_and_few_labels(spark, tmp_path):
    docs = awkward(spark, str(tmp_path / "d"))
    marks = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None), (3, 0, 0), (99, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    for score in (toxicity.score_toxicity, quality.score_quality):
        got = score(docs, marks).collect()
        assert len(got) == 10 and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (2, 3)}) == 1
        assert score(docs.limit(0), marks).count() == 0
        assert score(docs, marks.limit(0)).count() == 10
    assert toxicity.drop_toxic(docs, marks).columns == docs.columns


def test_logistic_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 1)))).astype(float)
    assert np.abs(learning.logistic(x, y, 1e-6) - [2, -1, -1]).max() < 0.25
    xs, ys = learning.isotonic(np.arange(6.0), np.array([0, 1, 0, 0, 1, 1.0]), np.ones(6))
    assert (np.diff(ys) >= 0).all() and ys[0] == 0 and ys[-1] == 1 and abs(ys[2] - 1 / 3) < 1e-9
    assert len(xs) == len(ys)
