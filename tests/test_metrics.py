"""Metrics against a plain restatement of the published formulas."""

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from clickloom.operators import metrics, ranking
from clickloom.sources import sinks

SCHEMA = "impression_id bigint, pos int, article_id bigint, label int, score double"


def table(seed=1, n=60, levels=6):
    rng = random.Random(seed)
    rows = []
    for imp in range(n):
        size = rng.randrange(1, 15)
        rate = rng.choice([0.0, 0.3, 0.3, 1.0])
        for pos in range(size):
            score = rng.randrange(levels) / 2.0 - 1.0 if rng.random() < 0.7 else rng.gauss(0, 2)
            rows.append((imp, pos, 100 + pos, int(rng.random() < rate), score))
    return rows


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def area(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    if not pos or not neg:
        return None
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def expected(rows):
    out = {}
    for imp, g in groups(rows).items():
        order = sorted(g, key=lambda r: (-r[4], r[1]))
        labels = [r[3] for r in order]
        rr = next((1 / (i + 1) for i, y in enumerate(labels) if y), 0.0)
        ndcg = {}
        for k in (5, 10):
            dcg = sum(y / math.log2(i + 2) for i, y in enumerate(labels[:k]))
            ideal = sum(y / math.log2(i + 2) for i, y in enumerate(sorted(labels, reverse=True)[:k]))
            ndcg[k] = dcg / (ideal + 1e-4)
        s = [r[4] for r in order]
        lse = max(s) + math.log(sum(math.exp(x - max(s)) for x in s))
        n_pos = sum(labels)
        listnet = -sum(y / (n_pos or 1) * (x - lse) for x, y in zip(s, labels))
        bce = sum(math.log1p(math.exp(-x)) if y else math.log1p(math.exp(x)) for x, y in zip(s, labels))
        out[imp] = (rr, ndcg[5], ndcg[10], area([(r[4], r[3]) for r in g]), bce, listnet)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_impression_metrics(spark, seed):
    rows = table(seed)
    want = expected(rows)
    got = metrics.impression_metrics(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(want)
    for r in got:
        rr, n5, n10, auc, bce, listnet = want[r.impression_id]
        assert r.rr == pytest.approx(rr)
        assert r.ndcg5 == pytest.approx(n5) and r.ndcg10 == pytest.approx(n10)
        assert (r.auc is None) == (auc is None)
        assert auc is None or r.auc == pytest.approx(auc)
        assert r.bce_sum == pytest.approx(bce) and r.listnet == pytest.approx(listnet)


def test_evaluate_report(spark):
    rows = table(5)
    want = expected(rows)
    got = metrics.evaluate(spark.createDataFrame(rows, SCHEMA), suffix="_v").first()
    sizes = {i: len(g) for i, g in groups(rows).items()}
    aucs = {i: w[3] for i, w in want.items() if w[3] is not None}
    assert got.n_impressions_v == len(want)
    assert got.auc_v == pytest.approx(sum(aucs.values()) / len(aucs))
    assert got.auc_weighted_v == pytest.approx(
        sum(a * sizes[i] for i, a in aucs.items()) / sum(sizes[i] for i in aucs)
    )
    assert got.mrr_v == pytest.approx(sum(w[0] for w in want.values()) / len(want))
    bce = sum(w[4] for w in want.values()) / (len(rows) + 1e-4)
    listnet = sum(w[5] for w in want.values()) / len(want)
    assert got.loss_v == pytest.approx(bce + 0.5 * listnet)
    only = metrics.evaluate(spark.createDataFrame(rows, SCHEMA), loss_weights={"bce_loss": 1.0}).first()
    assert only.loss == pytest.approx(bce)


def test_batched_area_weighs_batches_and_skips_one_class_ones(spark):
    rows = table(7)
    order = sorted(groups(rows))
    batches = {imp: i // 4 for i, imp in enumerate(order)}
    total = weight = used = 0
    for b in set(batches.values()):
        pairs = [(r[4], r[3]) for r in rows if batches[r[0]] == b]
        a = area(pairs)
        if a is not None:
            total, weight, used = total + a * len(pairs), weight + len(pairs), used + 1
    got = metrics.auc_batched(metrics.assign_batches(spark.createDataFrame(rows, SCHEMA), 4)).first()
    assert got.n_batches == used and got.auc == pytest.approx(total / weight)


@pytest.mark.parametrize("partitions", [1, 16])
def test_global_area_with_a_hot_score(spark, settings, partitions):
    settings({"spark.sql.shuffle.partitions": str(partitions)})
    rows = table(11, levels=2)
    df = spark.createDataFrame(rows, SCHEMA)
    got = metrics.auc_global(df).first()
    assert got.auc == pytest.approx(area([(r[4], r[3]) for r in rows]))
    spark_ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert got.auc == pytest.approx(spark_ml.evaluate(df.withColumn("label", F.col("label").cast("double"))))


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1, 0, 1, 1, 0.5), (1, 1, 2, 1, 0.1)], SCHEMA)
    row = metrics.impression_metrics(df).first()
    assert row.auc is None and row.rr == 1.0
    assert metrics.auc_global(df).first().auc is None


def test_padded_and_unlabelled_rows_are_left_out(spark):
    rows = [(1, 0, 1, 1, 0.5, True), (1, 1, 2, 0, 0.9, True), (1, 2, 0, 0, 9.0, False), (1, 3, 5, -1, 9.0, True)]
    df = spark.createDataFrame(rows, SCHEMA + ", valid boolean")
    row = metrics.impression_metrics(df).first()
    assert (row.n, row.n_pos, row.rr, row.auc) == (2, 1, 0.5, 0.0)


def test_ranks_break_ties_by_position_and_put_nan_last(spark):
    rows = [(1, 0, 10, 0, 0.5), (1, 1, 11, 1, 0.5), (1, 2, 12, 0, float("nan")), (1, 3, 13, 1, 0.9), (1, 4, 14, 0, None)]
    ranked = ranking.rank_candidates(spark.createDataFrame(rows, SCHEMA))
    assert [r["rank"] for r in ranked.orderBy("pos").collect()] == [2, 3, 4, 1, 5]
    top = ranking.top_candidates(spark.createDataFrame(rows, SCHEMA), 2).collect()
    assert {r.article_id for r in top} == {13, 10}
    clicked = {r.article_id: r for r in ranking.clicked_ranks(ranked).collect()}
    assert clicked[11]["rank"] == 3 and clicked[11].hit == 1 and clicked[11].rank_share == 0.6
    assert set(clicked) == {11, 13}


def test_ranks_are_a_permutation_and_submission_lists_them(spark, tmp_path):
    rows = table(13)
    ranked = ranking.rank_candidates(spark.createDataFrame(rows, SCHEMA))
    want = {}
    for imp, g in groups(rows).items():
        order = [r[1] for r in sorted(g, key=lambda r: (-r[4], r[1]))]
        want[imp] = f"{imp} [{','.join(str(order.index(p) + 1) for p in range(len(g)))}]"
    path = str(tmp_path / "submission")
    sinks.write_submission(ranked, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(want.values())


def test_model_comparison_and_choice(spark):
    a = spark.createDataFrame([(1, 0, 10, 1, 0.9), (1, 1, 11, 0, 0.1)], SCHEMA)
    b = spark.createDataFrame([(1, 0, 10, 1, 0.1), (1, 1, 11, 0, 0.9)], SCHEMA)
    both = ranking.stack_models({"a": a, "b": b})
    got = {r.model: r for r in ranking.compare_models(both).collect()}
    assert (got["a"].top_articles, got["a"].best_clicked_rank) == ("10,11", 1)
    assert (got["b"].top_articles, got["b"].best_clicked_rank, got["b"].hits) == ("11,10", 2, 1)
    assert metrics.best_model(metrics.evaluate(both, ["model"])).first().model == "a"


def test_scores_that_are_no_numbers_rank_last_and_have_no_loss(spark):
    rows = [(1, 0, float("nan"), 0), (1, 1, 0.5, 1), (1, 2, 0.2, 0), (2, 0, None, 1), (2, 1, 0.3, 0), (3, 0, None, 1)]
    scored = spark.createDataFrame(rows, "impression_id int, pos int, score double, label int")
    per = {r.impression_id: r for r in metrics.impression_metrics(scored).collect()}
    assert per[1].auc == 1.0 and per[2].auc == 0.0 and per[1].n_scored == 2
    assert all(r.bce_sum == r.bce_sum and r.listnet == r.listnet for r in per.values())
    assert per[3].bce_sum == 0.0 and per[3].listnet == 0.0
    one = scored.where("impression_id = 1")
    assert metrics.auc_global(one).first().auc == 1.0
    report = metrics.evaluate(scored).first()
    want = sum(math.log1p(math.exp(s)) - s * y for s, y in ((0.5, 1), (0.2, 0), (0.3, 0)))
    assert report.bce_loss == pytest.approx(want / (3 + metrics.EPS)) and report.loss == report.loss


def test_batched_report(spark):
    rows = [(k, p, float((7 * k + 3 * p) % 5), int(p == k % 3)) for k in range(12) for p in range(3)]
    scored = spark.createDataFrame(rows, "impression_id int, pos int, score double, label int")
    want = metrics.auc_batched(metrics.assign_batches(scored, 4)).first().auc
    assert metrics.evaluate_batched(scored, 4).first().auc == pytest.approx(want)
    both = scored.withColumn("model", F.lit("m"))
    assert metrics.evaluate_batched(both, 4, ["model"]).first().auc == pytest.approx(want)
