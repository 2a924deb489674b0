"""Plans and results when one key holds a third of all rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators import candidates, history, ordering, profiles, scoring

HOT = 7
SPLITTABLE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def reads(spark, n=6000):
    """Long history, a third of it by one user and a third on one article."""
    i = F.col("id")
    return spark.range(n, numPartitions=6).select(
        F.when(i % 3 == 0, F.lit(HOT)).otherwise(i % 40).cast("bigint").alias("user_id"),
        i.alias("event_id"),
        F.when(i % 3 == 1, F.lit(5)).otherwise(i * 7 % 50).cast("bigint").alias("article_id"),
        (i % 101).cast("double").alias("scroll_percentage"),
        (i % 300).cast("double").alias("read_time"),
        (i * 13 % 997).cast("double").alias("impression_time"),
    )


def impressions(spark, n=3000):
    i = F.col("id")
    rows = spark.range(n, numPartitions=6).select(
        i.alias("impression_id"),
        F.when(i % 3 != 0, F.lit(HOT)).otherwise(i % 40).cast("bigint").alias("user_id"),
        F.array((i % 50), ((i + 1) % 50), ((i + 2) % 50)).alias("article_ids_inview"),
        F.array(i % 50).alias("article_ids_clicked"),
    )
    return candidates.full_candidates(rows)


def vectors(spark):
    return spark.range(60).select(
        F.col("id").alias("article_id"),
        F.array(*[((F.col("id") * (k + 3)) % 11 / 11.0) for k in range(4)]).alias("vector"),
    )


STORED = ("impression_time", "event_id")


def test_a_hot_pair_is_split_when_scores_meet_candidates(spark, settings):
    settings(SPLITTABLE)
    cut = history.cut_history(reads(spark), "tail", 30, STORED)
    profile = profiles.mean_profiles(cut, vectors(spark))
    same = F.when(F.col("user_id") == HOT, F.transform("candidates", lambda c: c.withField("article_id", F.lit(5).cast("bigint"))))
    hot = impressions(spark).withColumn("candidates", F.coalesce(same, "candidates"))
    scored = scoring.score_candidates(hot, profile, vectors(spark))
    assert "SortMergeJoin(skew=true)" in final_plan(scored)
    assert scored.count() == 9000


def test_split_join_gives_the_same_scores(spark, settings):
    def run():
        cut = history.cut_history(reads(spark), "tail", 30, STORED)
        profile = profiles.mean_profiles(cut, vectors(spark))
        rows = scoring.score_candidates(impressions(spark), profile, vectors(spark)).collect()
        return {(r.impression_id, r.pos): round(r.score, 9) for r in rows}

    plain = run()
    settings(SPLITTABLE)
    assert run() == plain


def test_history_cut_limits_rows_before_the_exchange(spark):
    plan = history.cut_history(reads(spark), "recent", 30, STORED)._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("30, Final"), plan.index("30, Partial")
    assert before < plan.index("Exchange hashpartitioning(user_id") < after


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_positions_of_a_hot_key_span_partitions(spark, settings, partitions):
    settings({
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    data = reads(spark, 3000)
    got = ordering.position_in_group(data, ["user_id"], STORED)
    rows = got.select("user_id", "pos", *STORED).collect()
    assert len(rows) == 3000
    want = {}
    for r in sorted(data.collect(), key=lambda r: (r.impression_time, r.event_id)):
        want.setdefault(r.user_id, []).append(r.event_id)
    assert all(want[r.user_id][r.pos] == r.event_id for r in rows)


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_positions_by_slice_exchange_the_rows_once(spark, settings, partitions):
    settings({**SPLITTABLE, "spark.sql.shuffle.partitions": str(partitions)})
    data = reads(spark, 3000)
    got = ordering.position_by_slice(data, ["user_id"], STORED, F.floor(F.col("impression_time") / 50), start=3)
    rows = got.collect()
    want = {}
    for r in sorted(data.collect(), key=lambda r: (r.impression_time, r.event_id)):
        want.setdefault(r.user_id, []).append(r.event_id)
    assert len(rows) == 3000 and got.columns == [*data.columns, "pos"]
    assert all(want[r.user_id][r.pos - 3] == r.event_id for r in rows)
    again = got.select("*")  # a plan that has not run
    plan = again._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    whole = [c for c in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan) if "read_time" in c]
    assert len(whole) == 1 and "ExistingRDD" not in plan
    largest = got.groupBy("user_id", F.floor(F.col("impression_time") / 50)).count().agg(F.max("count")).first()[0]
    assert largest < 3000 / 3 / 10  # what one task must sort, of a user with a third of all rows


def test_running_total_of_ids(spark):
    rng = random.Random(5)
    ids = sorted({rng.randrange(-500, 1 << 20) for _ in range(400)} | {rng.randrange(1 << 30) for _ in range(100)})
    values = [(k, rng.randrange(9)) for k in ids]
    table = spark.createDataFrame(values, "k bigint, v bigint").repartition(7)
    for inclusive in (True, False):
        out = ordering.running_total_of_ids(table, "k", "v", "total", inclusive, bits=6)
        total, want = 0, {}
        for k, v in values:
            want[k] = total + (v if inclusive else 0)
            total += v
        assert {r.k: r.total for r in out.collect()} == want
    assert ordering.running_total_of_ids(table.limit(0), "k", "v", "total").count() == 0


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_dense_index_and_running_total(spark, settings, partitions):
    settings({
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    rng = random.Random(3)
    keys = [rng.randrange(10_000) for _ in range(700)]
    df = spark.createDataFrame([(k,) for k in keys + [None]], "k bigint")
    got = {r.k: r.idx for r in ordering.dense_index(df, "k", start=1).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(set(keys)))}

    values = [(k, rng.randrange(5)) for k in sorted(set(keys))]
    table = spark.createDataFrame(values, "k bigint, v bigint")
    for inclusive in (True, False):
        out = ordering.running_total(table, ["k"], "v", "total", inclusive)
        total, want = 0, {}
        for k, v in values:
            want[k] = total + (v if inclusive else 0)
            total += v
        assert {r.k: r.total for r in out.collect()} == want


def test_latest_by_takes_the_last_write(spark):
    rows = [(1, 10, "a"), (1, 12, "b"), (1, 11, "c"), (2, 5, "d")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    got = {r.k: r.v for r in ordering.latest_by(df, ["k"], ["t"]).collect()}
    assert got == {1: "b", 2: "d"}
