"""Sampling policies on hand fixtures, invariants, independence of partitioning."""

import hashlib

import pytest
from pyspark.sql import functions as F

from clickloom.operators import candidates, sampling

ROWS = [
    (1, [1, 2], [2, 1]),                      # nothing left to draw from
    (2, [5, 6, 7], [6]),                      # two negatives for four draws
    (3, [8, 9], []),                          # no click
    (4, [10, 11, 12, 13, 14, 15, 11], [10, 12]),
    (5, None, None),
]
SCHEMA = "impression_id bigint, article_ids_inview array<bigint>, article_ids_clicked array<bigint>"


def draw(spark, policy, **kw):
    out = sampling.sample_candidates(spark.createDataFrame(ROWS, SCHEMA), policy, **kw).collect()
    return {(r.impression_id, r.positive): r for r in out}


def ids(row):
    return [c.article_id for c in row.candidates]


def key(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def test_per_click(spark):
    got = draw(spark, "per_click")
    assert set(got) == {(1, 1), (1, 2), (2, 6), (4, 10), (4, 12)}
    assert ids(got[1, 1]) == [1] * 5
    assert set(ids(got[2, 6])[1:]) <= {5, 7} and len(ids(got[2, 6])) == 5
    pool = sorted([11, 13, 14, 15], key=lambda a: key(42, 4, 10, a))
    assert ids(got[4, 10]) == [10, *pool]
    short = sorted([5, 7], key=lambda a: key(42, 2, 6, a))
    drawn = [short[int(key(42, 2, 6, i)[:8], 16) % 2] for i in range(4)]
    assert ids(got[2, 6]) == [6, *drawn]


def test_padded(spark):
    got = draw(spark, "padded")
    assert len(got) == 3
    (row,) = [r for k, r in got.items() if k[0] == 2]
    assert sorted(ids(row)[1:3]) == [5, 7] and ids(row)[3:] == [0, 0]
    assert [c.valid for c in row.candidates] == [True, True, True, False, False]
    (empty,) = [r for k, r in got.items() if k[0] == 1]
    assert ids(empty)[1:] == [0] * 4
    assert [c.label for c in row.candidates] == [1, 0, 0, 0, 0]


def test_padded_in_first_mode_follows_list_order(spark):
    got = draw(spark, "padded", mode="first")
    assert set(got) == {(1, 2), (2, 6), (4, 10)}
    assert ids(got[4, 10]) == [10, 11, 13, 14, 15]
    assert ids(got[2, 6]) == [6, 5, 7, 0, 0]


def test_cycled(spark):
    got = draw(spark, "cycled")
    (row,) = [r for k, r in got.items() if k[0] == 2]
    a, b = sorted([5, 7], key=lambda x: key(42, 2, 6, x))
    assert ids(row) == [6, a, b, a, b]
    (empty,) = [r for k, r in got.items() if k[0] == 1]
    assert ids(empty) == [ids(empty)[0]] * 5


def test_first_inview_stands_in_for_a_missing_click(spark):
    padded = draw(spark, "padded", no_click="first_inview")
    assert (3, 8) in padded and 5 not in {k[0] for k in padded}
    cycled = draw(spark, "cycled", no_click="first_inview")
    assert ids(cycled[5, 0]) == [0] * 5


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        draw(spark, "other")


@pytest.mark.parametrize("policy", sampling.POLICIES)
def test_negatives_are_never_clicks_and_do_not_depend_on_partitions(spark, policy):
    rows = spark.range(400).select(
        F.col("id").alias("impression_id"),
        F.transform(F.sequence(F.lit(1), F.col("id") % 9 + 1), lambda x: (x * 7 + F.col("id")) % 23 + 1)
        .alias("article_ids_inview"),
    ).withColumn("article_ids_clicked", F.filter("article_ids_inview", lambda x: x % 3 == 0))
    runs = []
    for parts in (1, 4, 64):
        out = sampling.sample_candidates(rows.repartition(parts), policy).collect()
        runs.append(sorted((r.impression_id, r.positive, tuple(ids(r))) for r in out))
        for r in out:
            clicks = {c for c in r.article_ids_clicked}
            real = {c.article_id for c in r.candidates[1:] if c.valid}
            assert len(r.candidates) == 5
            assert not (real & clicks) or r.pool_size == 0
    assert runs[0] == runs[1] == runs[2]


def test_shuffle_orders_by_key_inside_partitions(spark):
    df = spark.range(200).select(F.col("id").alias("k"))
    out = sampling.shuffle_samples(df, ["k"], seed=1)
    parts = out.select(F.spark_partition_id().alias("p"), "shuffle_key", "k").collect()
    assert sorted(r.k for r in parts) == list(range(200))
    for p in {r.p for r in parts}:
        keys = [r.shuffle_key for r in parts if r.p == p]
        assert keys == sorted(keys)


def test_full_lists_and_labels(spark):
    rows = candidates.full_candidates(spark.createDataFrame(ROWS, SCHEMA))
    out = candidates.explode_candidates(rows, ["impression_id"]).collect()
    got = {(r.impression_id, r.pos): (r.article_id, r.label) for r in out}
    assert len(got) == 2 + 3 + 2 + 7
    assert got[4, 0] == (10, 1) and got[4, 1] == (11, 0) and got[4, 2] == (12, 1)
