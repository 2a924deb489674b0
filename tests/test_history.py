"""Hand fixtures: history cuts, padding, cold start, cleaning, encodings."""

import math

import pytest
from pyspark.sql import functions as F

from clickloom.functions import arrays, hashing, quality, scalar, vectors
from clickloom.operators import encode, features, history

HISTORY = (
    "user_id bigint, article_id_fixed array<int>, scroll_percentage_fixed array<double>, "
    "read_time_fixed array<double>, impression_time_fixed array<double>"
)


def wide(spark):
    long = list(range(1, 36))
    return spark.createDataFrame(
        [
            (1, long, [float(i) for i in long], [i * 10.0 for i in long], [i * 100.0 for i in long]),
            (2, [7, 8, 9], [10.0, None, 30.0], [1.0, -5.0, None], [3.0, 1.0, 2.0]),
            (3, [], [], [], []),
            (4, None, None, None, None),
        ],
        HISTORY,
    )


def lists(spark, policy, n):
    items = history.explode_history(wide(spark))
    out = history.history_lists(items, policy, n, ["pos"]).collect()
    return {r.user_id: r.hist for r in out}


def test_explode_keeps_users_without_items(spark):
    rows = history.explode_history(wide(spark)).collect()
    assert len(rows) == 35 + 3 + 1 + 1
    assert {r.user_id for r in rows if r.article_id is None} == {3, 4}


def test_tail_keeps_all_fields_aligned(spark):
    hist = lists(spark, "tail", 30)[1]
    assert [x.article_id for x in hist] == list(range(6, 36))
    assert all(
        x.scroll == pytest.approx(x.article_id / 100)
        and x.read_time == x.article_id * 10
        and x.ts == x.article_id * 100
        for x in hist
    )


def test_head_keeps_the_first_in_stored_order(spark):
    got = lists(spark, "head", 50)
    assert [x.article_id for x in got[1]] == list(range(1, 36))
    assert [x.article_id for x in lists(spark, "head", 2)[2]] == [7, 8]
    assert set(got) == {1, 2}


def test_recent_orders_by_time(spark):
    assert [x.article_id for x in lists(spark, "recent", 2)[2]] == [9, 7]


def test_cleaning_of_missing_and_negative_values(spark):
    hist = lists(spark, "tail", 30)[2]
    assert [x.scroll for x in hist] == [0.1, 0.0, 0.3]
    assert [x.read_time for x in hist] == [1.0, -5.0, 0.0]
    assert [x.log_time for x in hist] == [pytest.approx(math.log(2)), 0.0, 0.0]


@pytest.mark.parametrize("side,want", [("left", [0, 0, 7, 8, 9]), ("right", [7, 8, 9, 0, 0])])
def test_padding_sides(spark, side, want):
    items = history.explode_history(wide(spark))
    out = history.padded(history.history_lists(items, "tail", 5, ["pos"]), 5, side, ["article_id"])
    assert {r.user_id: r.article_id for r in out.collect()}[2] == want


def test_absent_user_gets_empty_or_zero_lists(spark):
    items = history.explode_history(wide(spark))
    per_user = history.history_lists(items, "tail", 5, ["pos"])
    imps = spark.createDataFrame([(10, 2), (11, 99), (12, 3)], "impression_id int, user_id bigint")
    sizes = {r.impression_id: len(r.hist) for r in history.with_history(imps, per_user).collect()}
    assert sizes == {10: 3, 11: 0, 12: 0}
    zeros = history.with_padded_history(imps, per_user, 5, "left", ["article_id", "scroll"]).collect()
    got = {r.impression_id: (r.article_id, r.scroll) for r in zeros}
    assert got[11] == ([0] * 5, [0.0] * 5) == got[12]


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError):
        history.cut_history(history.explode_history(wide(spark)), "middle", 3, ["pos"])


def test_encode_lists_keeps_order_duplicates_and_empty_rows(spark):
    index = encode.article_index(spark.createDataFrame([(50,), (30,), (40,)], "article_id int"))
    rows = spark.createDataFrame(
        [(1, [40, 99, 30, 40], [30], "a"), (2, [], None, "b"), (3, None, [50, 7], "c")],
        "k int, inv array<int>, clk array<int>, other string",
    )
    out = encode.encode_lists(rows, {"inv": "inv_ids", "clk": "clk_ids"}, index).collect()
    got = {r.k: (r.inv_ids, r.clk_ids, r.other) for r in out}
    assert got == {1: ([2, 0, 1, 2], [1], "a"), 2: ([], [], "b"), 3: ([], [3, 0], "c")}


def test_encode_lists_keeps_rows_that_share_an_id(spark):
    index = encode.article_index(spark.createDataFrame([(50,), (30,)], "article_id int"))
    rows = spark.range(10_000, numPartitions=6).select(
        F.lit(0).alias("impression_id"), (F.col("id") % 7).alias("user_id"),
        F.array(F.lit(30), F.lit(50).cast("int"), (F.col("id") % 3).cast("int")).alias("inv"),
    )
    out = encode.encode_lists(rows, {"inv": "inv_ids"}, index)
    assert out.count() == 10_000
    assert [tuple(r.inv_ids) for r in out.select("inv_ids").distinct().collect()] == [(1, 2, 0)]
    counts = {r.user_id: r["count"] for r in out.groupBy("user_id").count().collect()}
    assert counts == {u: len(range(u, 10_000, 7)) for u in range(7)}


def test_repeated_history_rows_stay_aligned(spark):
    articles = encode.article_index(spark.createDataFrame([(7,), (9,)], "article_id int"))
    users = encode.user_index(spark.createDataFrame([(2,), (5,)], "user_id bigint"))
    twice = wide(spark).unionByName(wide(spark))
    rows = features.history_features(twice, articles, users).collect()
    assert len(rows) == 2 * len(features.history_features(wide(spark), articles, users).collect())
    assert all(len(r.hist_ids) == len(r.hist_scroll) == len(r.hist_ts) for r in rows)


def test_history_features_drop_unmapped_users(spark):
    articles = encode.article_index(spark.createDataFrame([(7,), (9,)], "article_id int"))
    users = encode.user_index(spark.createDataFrame([(2,), (5,)], "user_id bigint"))
    rows = features.history_features(wide(spark), articles, users).collect()
    assert [(r.user_id, r.hist_ids) for r in rows] == [(0, [1, 0, 2])]
    assert rows[0].hist_scroll[0] == pytest.approx(0.1)
    assert rows[0].hist_ts == [3.0, 1.0, 2.0]


def test_category_dictionary_always_has_the_unknown_name(spark):
    names = spark.createDataFrame([("sport",), ("news",), ("news",)], "category_str string")
    got = {r.category_str: r.cat_id for r in encode.category_dictionary(names).collect()}
    assert got == {"UNK": 0, "news": 1, "sport": 2}
    codes = {r.category_str: r.code for r in encode.category_codes(names).collect()}
    assert codes == {"news": 1, "sport": 2}


def test_epoch_ignores_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179575' a, timestamp'2024-01-01 00:00:07.5 UTC' b, "
                   "date'2024-01-02' c, 5 d")
    got = df.select(*[scalar.epoch_seconds(F.col(c), df.schema[c].dataType) for c in "abcd"]).first()
    assert list(got) == [1704067207.179575, 1704067207.5, 1704153600.0, 5.0]
    with pytest.raises(TypeError):
        scalar.epoch_seconds(F.col("x"), df.selectExpr("'x' x").schema["x"].dataType)


def test_scalar_functions(spark):
    row = spark.range(1).select(
        scalar.bucketize(F.lit(0.999), 11).alias("b1"),
        scalar.bucketize(F.lit(1.7), 11).alias("b2"),
        scalar.bucketize(F.lit(-1.0), 11).alias("b3"),
        scalar.full_title(F.lit(None), F.lit("s")).alias("t"),
        scalar.text_head(F.lit("abcdef"), 3).alias("h"),
        scalar.with_prefix(F.lit("x")).alias("p"),
        scalar.freshness(F.lit(0.0), F.lit(7200.0)).alias("f"),
        scalar.recency(F.lit(0.0), F.lit(7200.0)).alias("r"),
        scalar.sigmoid(F.lit(0.5)).alias("s"),
        scalar.time_of_day(F.lit(86400.0 + 21600)).alias("d"),
        scalar.log_read_time(F.lit(float("nan"))).alias("n"),
        hashing.shard_of(F.lit(5), 3).alias("shard"),
    ).first()
    assert (row.b1, row.b2, row.b3) == (9, 10, 0)
    assert (row.t, row.h, row.p) == (" s", "abc", "passage: x")
    assert row.f == pytest.approx(math.log(3)) and row.r == 0.0
    assert row.s == pytest.approx(0.622459, abs=1e-6)
    assert row.d == 0.25 and row.n == 0.0 and row.shard in (0, 1, 2)


def test_quality_classes_do_not_overlap(spark):
    rows = [(4.1, 0.3), (4.0, 0.3), (4.1, 0.05), (1.0, 0.9), (2.0, 0.15)]
    df = spark.createDataFrame(rows, "t double, s double")
    got = df.select(quality.is_high(F.col("t"), F.col("s")), quality.is_low(F.col("t"), F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, False), (False, True), (False, True), (False, False)]


def test_array_functions(spark):
    row = spark.range(1).select(
        arrays.tail(F.array(*map(F.lit, [1, 2, 3])), 2).alias("t"),
        arrays.tail(F.array(*map(F.lit, [1, 2, 3])), 9).alias("t9"),
        arrays.head(F.array(*map(F.lit, [1, 2, 3])), 2).alias("h"),
        arrays.pad_left(F.array(F.lit(5)), 3, "int").alias("l"),
        arrays.pad_right(F.array(F.lit(5)), 3, "int").alias("r"),
        arrays.flagged(F.array(F.lit(5), F.lit(6)), F.array(F.lit(0), F.lit(1))).alias("f"),
        arrays.not_clicked(F.array(*map(F.lit, [4, 3, 4, 2])), F.array(F.lit(3))).alias("n"),
        arrays.real_ids(F.array(*map(F.lit, [0, 3, 0]))).alias("v"),
        arrays.valid_mask(F.array(*map(F.lit, [0, 3]))).alias("m"),
        arrays.sinusoidal(F.lit(0.5), 4).alias("s"),
    ).first()
    assert (row.t, row.t9, row.h) == ([2, 3], [1, 2, 3], [1, 2])
    assert (row.l, row.r, row.f) == ([0, 0, 5], [5, 0, 0], [6])
    assert (row.n, row.v, row.m) == ([4, 2], [3], [False, True])
    want = [math.sin(0.5), math.sin(0.005), math.cos(0.5), math.cos(0.005)]
    assert row.s == pytest.approx(want)


def test_zero_vector_normalises_to_zeros(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    plain = [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()]
    assert plain == [[0.0, 0.0], [0.6, 0.8]]
    eps = [r[0] for r in df.select(vectors.l2_normalize(F.col("v"), 1e-4)).collect()]
    assert eps[0] == [0.0, 0.0] and eps[1][0] == pytest.approx(3 / 5.0001)
