"""A raw folder end to end: preprocess, embed, sample, score, evaluate, submit."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clickloom import workflows
from clickloom.operators import candidates, history, metrics, profiles, scoring
from clickloom.sources import readers, sinks

T = dt.datetime(2024, 1, 2, 6)
ARTICLES = [(30 + i, 100 + i % 2, None if i == 3 else f"c{i % 2}", f"title {i}", None, f"body {i} " * 400, T, 5 * i, i, 1.0 * i, 0.1)
            for i in range(6)]
ARTICLE_SCHEMA = (
    "article_id int, category int, category_str string, title string, subtitle string, body string, "
    "published_time timestamp_ntz, total_pageviews int, total_inviews int, total_read_time float, sentiment_score float"
)
HISTORY_SCHEMA = (
    "user_id int, article_id_fixed array<int>, scroll_percentage_fixed array<float>, "
    "read_time_fixed array<float>, impression_time_fixed array<timestamp_ntz>"
)
BEHAVIOR_SCHEMA = (
    "impression_id int, user_id int, impression_time timestamp_ntz, article_ids_inview array<int>, "
    "{clicked}device_type int, age int, gender int, is_subscriber boolean, is_sso_user boolean"
)


def raw_folder(spark, root):
    spark.createDataFrame(ARTICLES, ARTICLE_SCHEMA).write.parquet(f"{root}/articles.parquet")
    reads = [(1, [30, 31, 99], [50.0, None, 10.0], [60.0, 2.0, 1.0], [T, T, T]), (3, [32], [1.0], [1.0], [T]), (9, [30], [1.0], [1.0], [T])]
    shown = [(10, 1, T, [32, 30, 31], [30], 1, 40, 0, True, False), (11, 2, T, [33, 34], [34], None, None, None, None, None)]
    for split in ("train", "validation"):
        spark.createDataFrame(reads, HISTORY_SCHEMA).write.parquet(f"{root}/{split}/history.parquet")
        clicked = BEHAVIOR_SCHEMA.format(clicked="article_ids_clicked array<int>, ")
        spark.createDataFrame(shown, clicked).write.parquet(f"{root}/{split}/behaviors.parquet")
    hidden = [r[:4] + r[5:] for r in shown] + [(12, 3, T, [35], 1, 1, 1, True, True)]
    spark.createDataFrame(hidden, BEHAVIOR_SCHEMA.format(clicked="")).write.parquet(f"{root}/test/behaviors.parquet")


def test_raw_folder_to_submission(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    raw_folder(spark, raw)
    workflows.preprocess(spark, raw, out)
    arts = {r.id_encoded: r for r in spark.read.parquet(f"{out}/articles_processed.parquet").collect()}
    assert set(arts) == {1, 2, 3, 4, 5, 6} and {r.cat_encoded for r in arts.values()} == {1, 2}
    hist = {r.user_id: r for r in spark.read.parquet(f"{out}/train/history_processed.parquet").collect()}
    assert set(hist) == {0, 2} and hist[0].hist_ids == [1, 2, 0]
    test = {r.impression_id: r for r in spark.read.parquet(f"{out}/test/behaviors_processed.parquet").collect()}
    assert test[12].inv_ids == [6] and test[12].clk_ids == [] and test[12].user_id == 2
    assert readers.read_split(spark, out, "test", "history_processed") is None

    table = workflows.embed(spark, raw, out, dim=64)
    assert table.count() == 7 and table.where("idx = 0").first().article_id == -1

    vecs = profiles.article_vectors(table.where("idx > 0"), "idx", "title_vector", eps=1e-4, normalize=True)
    behaviors = readers.read_split(spark, out, "validation", "behaviors_processed")
    raw_history = readers.read_split(spark, out, "validation", "history_processed").select(
        "user_id", F.col("hist_ids").alias("article_id_fixed"), F.col("hist_scroll").alias("scroll_percentage_fixed"),
        F.col("hist_time").alias("read_time_fixed"), F.col("hist_ts").alias("impression_time_fixed"))
    cut = history.cut_history(history.explode_history(raw_history), "tail", 30, ["pos"])
    lists = candidates.full_candidates(behaviors, "inv_ids", "clk_ids")
    scored = scoring.score_candidates(lists, profiles.mean_profiles(cut, vecs), vecs)
    report = metrics.evaluate(scored).first()
    assert report.n_impressions == 2 and 0.0 <= report.auc <= 1.0 and 0.0 < report.mrr <= 1.0
    workflows.submit(scored, f"{out}/submission")
    lines = {r.value.split(" ")[0]: r.value for r in spark.read.text(f"{out}/submission").collect()}
    assert set(lines) == {"10", "11"} and lines["11"] == "11 [1,2]"


def test_a_second_run_sees_new_articles_and_parameters(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    raw_folder(spark, raw)
    workflows.preprocess(spark, raw, out)
    workflows.embed(spark, raw, out, dim=32)
    more = [(90 + i, *ARTICLES[i][1:]) for i in range(2)]
    spark.createDataFrame(more, ARTICLE_SCHEMA).write.mode("append").parquet(f"{raw}/articles.parquet")
    workflows.preprocess(spark, raw, out)
    arts = spark.read.parquet(f"{out}/articles_processed.parquet").collect()
    assert sorted(r.id_encoded for r in arts) == list(range(1, 9))
    table = workflows.embed(spark, raw, out, dim=48)
    assert table.count() == 9 and {len(r.title_vector) for r in table.collect()} == {48}


def test_unchanged_inputs_are_read_back(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    raw_folder(spark, raw)
    first = workflows.article_map(spark, raw, out).inputFiles()
    assert sorted(workflows.article_map(spark, raw, out).inputFiles()) == sorted(first)


def test_fit_save_score_and_submit_in_input_order(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    raw_folder(spark, raw)
    workflows.preprocess(spark, raw, out)
    model = workflows.fit(spark, raw, out, dim=32)
    assert model.gradient_norm < 1e-8
    saved = (tmp_path / "out" / "ranker" / "_SUCCESS").stat().st_mtime_ns
    assert workflows.fit(spark, raw, out, dim=32) == model
    assert (tmp_path / "out" / "ranker" / "_SUCCESS").stat().st_mtime_ns == saved
    scored = workflows.rank(spark, raw, out, "validation", dim=32)
    assert scored.count() == 5 and scored.where("score is null or isnan(score)").count() == 0
    assert metrics.evaluate(scored).first().n_impressions == 2
    workflows.rank(spark, raw, out, "test", dim=32)
    parts = sorted((tmp_path / "raw" / "test" / "behaviors.parquet").glob("part-*"))
    order = [k for part in parts for k in pq.read_table(part).column("impression_id").to_pylist()]
    assert [int(x.split(" ")[0]) for x in lines_in_order(f"{out}/test/submission")] == order


def lines_in_order(folder):
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    return [x for f in parts for x in open(f"{folder}/{f}").read().splitlines()]


@pytest.mark.parametrize("partitions", [1, 64])
def test_submission_keeps_the_order_of_the_files(spark, tmp_path, settings, partitions):
    settings({"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.enabled": "false"})
    ids = [k * 7919 % 4001 for k in range(3000)]
    for lo in range(0, 3000, 1000):
        part = spark.createDataFrame([(k,) for k in ids[lo : lo + 1000]], "impression_id int").coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/in-{lo}")
    found = spark.read.parquet(*[f"{tmp_path}/in-{lo}" for lo in range(0, 3000, 1000)])
    order = readers.with_scan_order(found)
    ranked = spark.createDataFrame([(k, p, 2 - p) for k in ids for p in range(2)], "impression_id int, pos int, rank int")
    sinks.write_submission(ranked, f"{tmp_path}/out", order=order)
    assert lines_in_order(f"{tmp_path}/out") == [f"{k} [2,1]" for k in ids]


def test_the_last_row_of_an_id_wins_on_read(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    rows = [(k % 40, None if k % 40 == 7 else k % 3, [k]) for k in range(900)]
    spark.createDataFrame(rows, "a int, b int, x array<int>").coalesce(1).write.parquet(path)
    want = {}
    for a, b, x in rows:
        want[(a, b) if b is not None else (a, tuple(x))] = (a, b, tuple(x))
    got = readers.scan_last(spark, path, ["a", "b"]).collect()
    assert sorted(map(repr, ((r.a, r.b, tuple(r.x)) for r in got))) == sorted(map(repr, want.values()))
    narrow = readers.scan_last(spark, path, ["a"], ["a", "b"])
    assert narrow.columns == ["a", "b"] and narrow.count() == 40


def test_history_cut_is_built_once_per_state_of_the_files(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    raw_folder(spark, raw)
    first = workflows.history_cut(spark, raw, out, "train")
    files = sorted(first.inputFiles())
    assert {r.user_id: [x.article_id for x in r.hist] for r in first.collect()}[1] == [30, 31, 99]
    assert sorted(workflows.history_cut(spark, raw, out, "train").inputFiles()) == files
    more = spark.createDataFrame([(50, [33, 34], [1.0, 2.0], [1.0, 2.0], [T, T])], HISTORY_SCHEMA)
    more.write.mode("append").parquet(f"{raw}/train/history.parquet")
    again = workflows.history_cut(spark, raw, out, "train")
    assert again.where("user_id = 50").count() == 1 and sorted(again.inputFiles()) != files


def test_uneven_lists_are_aligned_by_ids_and_counted(spark):
    t = dt.datetime(2024, 1, 2, 6)
    wide = spark.createDataFrame(
        [(1, [5, 6], [1.0], [1.0, 2.0, 3.0], [t, t]), (2, None, [1.0], None, None), (3, [7], [1.0], [2.0], [t]), (4, [], [], [], [])],
        HISTORY_SCHEMA,
    )
    got = sorted((r.user_id, -1 if r.pos is None else r.pos, r.article_id, r.scroll_percentage) for r in history.explode_history(wide).collect())
    assert got == [(1, 0, 5, 1.0), (1, 1, 6, None), (2, -1, None, None), (3, 0, 7, 1.0), (4, -1, None, None)]
    assert tuple(history.misaligned_histories(wide).first()) == (4, 2)
