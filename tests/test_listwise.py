"""The list-wise ranker against finite differences, the metric's loss, and its own optimum."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import listwise, metrics

NUMERIC = ("a", "b")
SCHEMA = "impression_id long, pos int, label int, cat_encoded int, a double, b double, valid boolean"


def rows(n=120, seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        size = 1 + int(rng.integers(0, 6))
        x = rng.normal(size=(size, 2)) * (1.0, 40.0)
        best = int(np.argmax(x[:, 0] - x[:, 1] / 40 + rng.gumbel(size=size)))
        for pos in range(size):
            label = int(pos == best or (k % 9 == 0 and pos == 0)) if k % 7 else 0
            out.append((k, pos, label, int(rng.integers(0, 3)), *x[pos].tolist(), True))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_sums_agree_with_finite_differences():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 4, 2, 6])
    labels = np.array([1, 0, 1, 1, 0, 0, 1, 0, 0, 0, 1, 0, 0], float)
    codes, x, w = rng.integers(-1, 4, 13), rng.normal(size=(13, 2)), rng.normal(size=5)
    loss, gradient, curvature = listwise.list_sums(sizes, labels, codes, x, w)
    for j, e in enumerate(np.eye(5) * 1e-5):
        up, down = (listwise.list_sums(sizes, labels, codes, x, w + s * e) for s in (1, -1))
        assert gradient[j] == pytest.approx((up[0] - down[0]) / 2e-5, abs=1e-7)
        assert curvature[j] == pytest.approx((up[1] - down[1]) / 2e-5, abs=1e-7)
    assert np.isfinite(listwise.list_sums(sizes, labels, codes, x * 1e4, w)[0])


def test_blocks_hold_every_list_once():
    ends = np.cumsum([3, 1, 50, 2, 2, 2])
    assert list(listwise._blocks(ends, 5)) == [(0, 2), (2, 3), (3, 5), (5, 6)]


def test_fit_reaches_the_optimum_of_the_metrics_loss(spark):
    data = frame(spark, rows())
    model = listwise.fit_listwise(data, NUMERIC, reg=0.01)
    assert model.gradient_norm < 1e-8 and model.passes < 20
    assert model.weights[0] > 0.5 and model.weights[1] < -0.5
    scored = listwise.score_listwise(model, data)
    told = metrics.impression_metrics(scored).where("n_pos > 0").agg(F.avg("listnet")).first()[0]
    ridge = 0.005 * sum(w * w for w in model.weights)
    assert model.loss == pytest.approx(told + ridge, abs=1e-9)
    for j in range(len(model.weights)):
        for move in (0.01, -0.01):
            other = [*model.weights]
            other[j] += move
            worse = listwise.ListwiseModel(NUMERIC, model.means, model.scales, tuple(other), 0.0, 0.0, 0)
            there = metrics.impression_metrics(listwise.score_listwise(worse, data))
            value = there.where("n_pos > 0").agg(F.avg("listnet")).first()[0]
            assert value + 0.005 * sum(w * w for w in other) > model.loss


def test_lists_in_any_partitioning_give_the_same_model(spark):
    data = frame(spark, rows())
    one = listwise.fit_listwise(data.coalesce(1), NUMERIC)
    many = listwise.fit_listwise(data.repartition(16), NUMERIC)
    assert many.weights == pytest.approx(one.weights, abs=1e-7)


def test_odd_rows(spark):
    data = rows(40)
    odd = [
        (900, 0, 1, None, None, float("nan"), True), (900, 1, 0, 2, 1.0, 1.0, True),
        (901, 0, None, 1, 1.0, 1.0, True), (902, 0, 1, 1, 5.0, 5.0, True),
        (903, 0, 1, 1, 1.0, 2.0, True), (903, 1, 0, 0, 9.9, 9.9, False),
    ]
    model = listwise.fit_listwise(frame(spark, data + odd), NUMERIC)
    assert model.gradient_norm < 1e-8 and len(model.weights) == 5
    scored = listwise.score_listwise(model, frame(spark, odd + [(904, 0, 0, 77, 0.0, 0.0, True)]))
    assert scored.where("score is null or isnan(score)").count() == 0 and scored.count() == 7
    without = listwise.fit_listwise(frame(spark, [r for r in data + odd if r[6]]), NUMERIC)
    assert len(without.weights) == len(model.weights)
    nothing = listwise.fit_listwise(frame(spark, []), NUMERIC)
    assert nothing.weights == (0.0, 0.0) and nothing.gradient_norm == 0.0
    with pytest.raises(ValueError, match="category codes"):
        listwise.fit_listwise(frame(spark, [(1, 0, 1, 5000, 0.0, 0.0, True)]), NUMERIC)


def test_a_model_is_read_back_until_its_stamp_changes(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return frame(spark, rows(40))

    path = f"{tmp_path}/model"
    first = listwise.fit_once(spark, path, build, "one", numeric=NUMERIC)
    assert listwise.fit_once(spark, path, build, "one", numeric=NUMERIC) == first and len(calls) == 1
    listwise.fit_once(spark, path, build, "two", numeric=NUMERIC)
    assert len(calls) == 2 and listwise.load_model(spark, path)[1] == "two"
