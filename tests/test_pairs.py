"""Pair scoring by a grid of cells, and profiles of several models in one pass."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import history, pairs, profiles, scoring

from tests.test_scoring import impressions, tables


def test_products_match_numpy_with_gaps(spark, settings):
    settings({"spark.sql.shuffle.partitions": "9"})
    rng = np.random.default_rng(0)
    users = {k: rng.normal(size=5).tolist() for k in range(40)}
    articles = {k: rng.normal(size=5).astype(np.float32).tolist() for k in range(30)}
    articles[3] = [1.0, 2.0]  # another width
    articles[4] = [1.0, None, 3.0, 4.0, 5.0]
    articles[5] = None
    users[6] = []
    asked = [(int(u), int(a)) for u, a in zip(rng.integers(0, 45, 900), rng.integers(0, 35, 900), strict=True)]
    asked += [(7, 7)] * 500 + [(None, 1), (1, None)]
    got = pairs.pair_products(
        spark.createDataFrame(asked, "user_id bigint, article_id bigint"),
        spark.createDataFrame(list(users.items()), "user_id bigint, p array<double>"),
        spark.createDataFrame(list(articles.items()), "article_id bigint, v array<float>"),
        [("p", "v")],
    ).collect()
    seen = {(r.user_id, r.article_id): r.dots[0] for r in got}
    assert len(got) == len(seen) == len({p for p in asked if None not in p})
    for (u, a), dot in seen.items():
        x, y = users.get(u), articles.get(a)
        if not x or not y or len(x) != len(y) or None in y:
            assert dot is None
        else:
            assert dot == pytest.approx(float(np.dot(x, y)))


def test_no_exchange_holds_a_vector_with_a_candidate(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    cut, vecs = tables(spark)
    scored = scoring.score_candidates(impressions(spark), profiles.mean_profiles(cut, vecs), vecs)
    plan = scored._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
    assert len(inputs) > 4 and "BroadcastHashJoin" not in plan
    for columns in inputs:
        names = {c.split("#")[0].strip() for c in columns.split(",")}
        assert not (names & {"profile", "vector", "_p0", "_v", "wide", "narrow"} and names & {"label", "impression_id", "pos"})
    assert any("wide" in columns for columns in inputs)


def test_a_hot_user_and_article_are_spread_over_the_grid(spark, settings):
    settings({"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"})
    side = 8
    hot = [(1, a) for a in range(3000)] + [(u, 1) for u in range(3000)]
    frame = spark.createDataFrame(hot, "user_id bigint, article_id bigint")
    cell = F.pmod(F.xxhash64("user_id"), F.lit(side)) * side + F.pmod(F.xxhash64("article_id"), F.lit(side))
    largest = frame.distinct().groupBy(cell.alias("c")).count().agg(F.max("count")).first()[0]
    assert largest < 6000 / side * 2
    one = spark.createDataFrame([(k, [1.0]) for k in range(3000)], "user_id bigint, p array<double>")
    got = pairs.pair_products(frame, one, one.toDF("article_id", "v"), [("p", "v")])
    assert got.where("dots[0] = 1.0").count() == len(set(hot))


def test_joint_profiles_equal_the_single_ones(spark):
    cut, vecs = tables(spark)
    normed = vecs.withColumn("norm", F.lit(2.0) + F.col("article_id"))
    head = history.cut_history(cut, "head", 2, ("ts",), "ts")
    unit = normed.select("article_id", F.transform("vector", lambda x: x / F.lit(1.0)).alias("vector"), "norm")
    got = {r.user_id: r for r in profiles.joint_profiles(cut, head, normed, "norm").collect()}
    scaled = unit.select("article_id", F.zip_with("vector", F.array_repeat("norm", 3), lambda x, n: x / n).alias("vector"))
    want = {
        "similarity": profiles.mean_profiles(cut, scaled),
        "uniform": profiles.mean_profiles(head, vecs, mask_unknown=False),
        "quality": profiles.quality_profiles(cut, vecs),
    }
    for name, table in want.items():
        single = {r.user_id: r.profile for r in table.collect()}
        assert set(single) == {u for u, r in got.items() if r[name] is not None}
        for user, profile in single.items():
            assert got[user][name] == pytest.approx(profile)


def test_joint_profiles_send_the_vectors_by_user_once(spark):
    cut, vecs = tables(spark)
    normed = vecs.withColumn("norm", F.lit(2.0))
    head = history.cut_history(cut, "head", 2, ("ts",), "ts")
    plan = profiles.joint_profiles(cut, head, normed, "norm")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "aggregate_metrics" not in plan


def test_joint_profiles_keep_null_users_widths_and_odd_numbers_apart(spark):
    items = [
        (None, 1, 9.0, 1.0), (None, 2, 0.0, 0.0), (1, 1, 9.0, 1.0), (1, 3, 0.0, 0.0), (2, 4, 9.0, 1.0), (3, 77, 9.0, 1.0),
    ]
    recent = spark.createDataFrame(items, "user_id bigint, article_id bigint, log_time double, scroll double")
    vectors = [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0]), (3, [float("inf"), 1.0]), (4, [1.0, 2.0, 4.0])]
    vecs = spark.createDataFrame(vectors, "article_id bigint, vector array<float>").withColumn("norm", F.lit(1.0))
    got = {r.user_id: r for r in profiles.joint_profiles(recent, recent.limit(0), vecs, "norm").collect()}
    assert set(got) == {None, 1, 2} and all(r.uniform is None for r in got.values())
    assert got[None].similarity == pytest.approx([7 / 3, 4.0])
    assert got[2].similarity == [1.0, 2.0, 4.0]
    assert got[1].similarity == [float("inf"), 1.5]
    with pytest.raises(Exception, match="null"):
        broken = spark.createDataFrame([(1, [1.0, None])], "article_id bigint, vector array<float>").withColumn("norm", F.lit(1.0))
        profiles.joint_profiles(recent, recent.limit(0), broken, "norm").collect()
