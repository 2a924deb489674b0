"""The ranker queries over rows of their own."""

import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ranker
from clickloom.plans import scores
from clickloom.plans.clicklog import ClickLog


@pytest.fixture
def folder(spark, tmp_path):
    first = datetime.datetime(2024, 1, 1)
    kinds = ("view", "click", "error")
    events = [
        (i, first + datetime.timedelta(hours=3 * i), i % 5, kinds[i % 3], float(i % 7), f'{{"k": {i % 9}}}') for i in range(236)
    ]
    tables = {
        "events": (events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
        "documents": ([(i, f"text {i}", "en", "web", 6) for i in range(8)], "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        "embeddings": ([(i, [float(i), 1.0]) for i in range(8)], "vec_id bigint, embedding array<float>"),
        "labels": ([(i, i % 2, 0) for i in range(4)], "doc_id bigint, quality int, toxic int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_the_splits_share_one_table_of_article_numbers(spark, folder, monkeypatch):
    made, make = [], scores.article_numbers

    def counted(log):
        made.append(log)
        return make(log)

    seen = []
    monkeypatch.setattr(scores, "article_numbers", counted)
    monkeypatch.setattr(ranker, "fit_ranker", seen.append)
    monkeypatch.setattr(ranker, "score_ranker", lambda model, rows: rows.withColumn("score", F.lit(0.0)))
    scores.learned_ranker(ClickLog(spark, folder))
    assert len(made) == 1
    for train in seen:  # no plan of a split adds up the exposures of all events again
        assert "total_inviews" not in train._jdf.queryExecution().optimizedPlan().toString()
        assert train.count() > 0
