"""Profiles, scorers, candidate features, learned and external models, text."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import candidates, encode, features, history, profiles, ranker, scoring, text

READS = (
    "user_id bigint, event_id bigint, article_id bigint, scroll_percentage double, read_time double, "
    "impression_time double"
)
VECTORS = {1: [1.0, 0.0, 2.0], 2: [0.0, 1.0, 1.0], 3: [2.0, 2.0, 0.0]}
# User 1: high, low, neither, and an unknown article; user 2: no high, no low; user 3: only unknown.
ROWS = [
    (1, 1, 1, 90.0, 100.0, 10.0),
    (1, 2, 2, 5.0, 0.5, 20.0),
    (1, 3, 3, 15.0, 20.0, 30.0),
    (1, 4, 9, 80.0, 200.0, 40.0),
    (2, 5, 3, 50.0, 20.0, 10.0),
    (2, 6, 9, 50.0, 20.0, 20.0),
    (3, 7, 9, 50.0, 20.0, 20.0),
]
STORED = ("impression_time", "event_id")


def tables(spark):
    cut = history.cut_history(spark.createDataFrame(ROWS, READS), "recent", 30, STORED)
    vecs = spark.createDataFrame(list(VECTORS.items()), "article_id bigint, vector array<double>")
    return history.clean_items(cut), vecs


def profile_of(df):
    return {r.user_id: r.profile for r in df.collect()}


def v(*ids):
    return np.mean([VECTORS.get(i, [0.0] * 3) for i in ids], axis=0)


def test_mean_profiles_mask_or_count_unknown_items(spark):
    cut, vecs = tables(spark)
    masked = profile_of(profiles.mean_profiles(cut, vecs))
    assert set(masked) == {1, 2}
    assert masked[1] == pytest.approx(v(1, 2, 3)) and masked[2] == pytest.approx(v(3))
    counted = profile_of(profiles.mean_profiles(cut, vecs, mask_unknown=False))
    assert counted[1] == pytest.approx(v(1, 2, 3, 9)) and counted[2] == pytest.approx(v(3, 9))


def test_quality_profiles_pool_an_empty_class_over_all_items(spark):
    cut, vecs = tables(spark)
    got = profile_of(profiles.quality_profiles(cut, vecs))
    weight = 1 / (1 + math.exp(-0.5))
    assert got[1] == pytest.approx(v(1, 2, 3) + v(1) - weight * v(2))
    assert got[2] == pytest.approx(v(3) + v(3, 9) - weight * v(3, 9))
    assert 3 not in got


def impressions(spark):
    rows = [(100, 1, [1, 2, 9], [2]), (101, 2, [3], []), (102, 8, [1], [1])]
    schema = "impression_id bigint, user_id bigint, article_ids_inview array<bigint>, article_ids_clicked array<bigint>"
    return candidates.full_candidates(spark.createDataFrame(rows, schema))


def test_scores_are_dots_and_zero_when_unknown(spark):
    cut, vecs = tables(spark)
    plain = scoring.Scorer(profiles.mean_profiles(cut, vecs))
    wide = scoring.Scorer(profiles.mean_profiles(cut, vecs), scale_by_width=True)
    both = scoring.score_models(impressions(spark), {"a": plain, "b": wide}, vecs).collect()
    got = {(r.model, r.impression_id, r.pos): r.score for r in both}
    assert len(got) == 10
    assert got["a", 100, 0] == pytest.approx(float(v(1, 2, 3) @ VECTORS[1]))
    assert got["a", 100, 2] == 0.0 and got["a", 102, 0] == 0.0
    assert got["b", 100, 0] == pytest.approx(got["a", 100, 0] / math.sqrt(3))
    single = scoring.score_candidates(impressions(spark), plain.profiles, vecs).collect()
    assert {(r.impression_id, r.pos): r.score for r in single} == {k[1:]: s for k, s in got.items() if k[0] == "a"}


def feature_table(spark, **kw):
    import datetime as dt

    cut, vecs = tables(spark)
    lists = history.history_lists(spark.createDataFrame(ROWS, READS), "tail", 30, STORED)
    arts = spark.createDataFrame(
        [(1, "a", 10, 20, 30.0, 0.5, 0.0), (2, None, None, None, None, None, 3600.0), (3, "b", 1, 1, 1.0, 1.0, 0.0)],
        "article_id bigint, category_str string, total_pageviews bigint, total_inviews bigint, "
        "total_read_time double, sentiment_score double, published_time double",
    )
    feats = features.article_features(arts, encode.category_codes(arts))
    imps = impressions(spark).withColumn("impression_time", F.lit(7200.0)).withColumn(
        "age", F.when(F.col("user_id") == 1, F.lit(50)))
    return scoring.candidate_features(imps, lists, profiles.mean_profiles(cut, vecs), feats, vecs, **kw)


def test_candidate_features(spark):
    got = {(r.impression_id, r.pos): r for r in feature_table(spark).collect()}
    one = got[100, 0]
    assert one.cat_encoded == 1 and one.norm_views == pytest.approx(math.log(11), abs=1e-6)
    assert one.freshness == pytest.approx(math.log(3)) and one.similarity == pytest.approx(float(v(1, 2, 3) @ VECTORS[1]))
    assert one.norm_age == 0.5 and one.log_hist_len == pytest.approx(math.log(5))
    assert one.day_time == pytest.approx(7200 / 86400)
    assert one.mean_scroll == pytest.approx(0.475) and one.max_time == 200.0
    assert one.max_recency == pytest.approx(math.log1p((7200 - 10) / 3600))
    assert got[100, 1].cat_encoded == 0 and got[100, 1].norm_views == 0.0
    unknown, cold = got[100, 2], got[102, 0]
    assert unknown.is_unknown and unknown.freshness == 0.0 and unknown.similarity == 0.0
    assert (cold.log_hist_len, cold.mean_recency, cold.norm_age) == (0.0, 0.0, 0.0)
    old = {(r.impression_id, r.pos): r for r in feature_table(spark, unknown_freshness="epoch").collect()}
    assert old[100, 2].freshness == pytest.approx(math.log(3))


def test_learned_ranker_finds_a_separating_feature(spark):
    i = F.col("id")
    rows = spark.range(300).select(
        i.alias("impression_id"), (i % 2).cast("int").alias("label"), (i % 3).cast("int").alias("cat_encoded"),
        *[(F.when(i % 2 == 1, F.lit(3.0)).otherwise(F.lit(-3.0)) if c == "similarity" else (i % 7) * 1.0).alias(c)
          for c in scoring.NUMERIC_FEATURES],
    )
    model = ranker.fit_ranker(rows)
    scored = ranker.score_ranker(model, rows)
    low = scored.where("label = 1").agg(F.min("score")).first()[0]
    high = scored.where("label = 0").agg(F.max("score")).first()[0]
    assert low > 0 > high and scored.count() == 300


def test_external_model_sees_all_rows(spark):
    def make():
        def predict(batch):
            return batch[:, 0] * 2.0 - batch[:, 1]

        return predict

    rows = spark.range(1000).select("id", (F.col("id") * 1.0).alias("a"), F.lit(1.0).alias("b"))
    got = scoring.score_with(rows, make, ["a", "b"], batch_size=64).collect()
    assert all(r.score == 2.0 * r.id - 1.0 for r in got) and len(got) == 1000


def test_padding_is_scored_below_everything(spark):
    rows = spark.createDataFrame([(1.0, True), (5.0, False)], "score double, valid boolean")
    assert [r.score for r in scoring.mask_padding(rows).collect()] == [1.0, -1e4]


def test_text_vectors(spark):
    long = "solsikke " * 5000 + "hale"
    rows = [(1, "Red fox, red hound."), (2, "red HOUND red fox"), (3, "æble på bordet"), (4, None), (5, long), (6, "solsikke " * 5000)]
    df = spark.createDataFrame(rows, "article_id int, body string")
    out = {r.article_id: np.array(r.vec) for r in text.embed_texts(df, {"body": "vec"}, 512).collect()}
    assert out[1] == pytest.approx(out[2])
    assert np.linalg.norm(out[3]) == pytest.approx(1.0, abs=1e-5) and not out[4].any()
    assert np.count_nonzero(out[3]) == 3
    assert np.count_nonzero(out[5]) == 2 and np.count_nonzero(out[6]) == 1


def test_external_encoder_gets_prefixed_texts(spark):
    def make():
        def encode_batch(texts):
            return np.array([[float(len(t)), 1.0 if t.startswith("passage: ") else 0.0] for t in texts], dtype="float32")

        return encode_batch

    df = spark.createDataFrame([(1, "abc")], "article_id int, body string")
    (row,) = text.embed_texts(df, {"body": "vec"}, make_encoder=make).collect()
    assert row.vec == pytest.approx([12 / math.hypot(12, 1), 1 / math.hypot(12, 1)], abs=1e-6)


def test_article_and_category_embeddings(spark):
    docs = spark.createDataFrame(
        [(1, "news", "t1", None, "body one"), (2, None, "t2", "s2", "body two"), (3, "lost", "t3", None, None)],
        "article_id int, category_str string, title string, subtitle string, body string",
    ).withColumn("published_time", F.lit(0))
    known = encode.category_dictionary(docs.where("article_id < 3"))
    described = spark.createDataFrame([("news", "what happened today")], "category_str string, description string")
    names = {r.category_str: r.description for r in text.category_descriptions(known, described).collect()}
    assert names == {"news": "what happened today", "UNK": text.UNKNOWN_DESCRIPTION}
    cats = text.category_vectors(known, 64, described)
    out = {r.article_id: r for r in text.embed_articles(features.article_text(docs), cats, 64).collect()}
    assert len(out) == 3 and out[3].category_vector is None
    assert len(out[2].title_vector) == 64 and out[2].category_str == "UNK" and out[2].category_vector is not None
