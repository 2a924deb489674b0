"""Readers, sinks, schema checks, and the streaming job."""

import pytest
from pyspark.sql import functions as F

from clickloom import session
from clickloom.operators import encode, features
from clickloom.sources import readers, sinks
from clickloom.streaming import behaviors as stream

BEHAVIORS = (
    "impression_id bigint, user_id bigint, impression_time timestamp_ntz, article_ids_inview array<int>, "
    "article_ids_clicked array<int>, device_type int, age int, gender int, is_subscriber boolean, "
    "is_sso_user boolean, session_id bigint"
)


def raw_behaviors(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 2, 6)
    rows = [
        (1, 20, t, [30, 99, 40], [40], 2, 50, 1, True, None, 7),
        (2, 10, t, [40], [], None, None, None, None, False, 8),
        (3, 77, t, [], [], 1, 20, 0, False, True, 9),
    ]
    return spark.createDataFrame(rows, BEHAVIORS)


def maps(spark):
    articles = encode.article_index(spark.createDataFrame([(30,), (40,)], "article_id int"))
    users = encode.user_index(spark.createDataFrame([(10,), (20,)], "user_id bigint"))
    return articles, users


def test_behavior_features_with_and_without_optional_columns(spark):
    articles, users = maps(spark)
    raw = raw_behaviors(spark)
    full = {r.impression_id: r for r in features.behavior_features(raw, articles, users).collect()}
    one = full[1]
    assert (one.inv_ids, one.clk_ids, one.user_id) == ([1, 0, 2], [2], 1)
    assert (one.imp_ts, one.norm_age, one.is_subscriber, one.is_sso_user) == (1704175200.0, 0.5, 1, 0)
    assert (full[2].device_type, full[2].norm_age, full[2].gender) == (0, 0.0, 0)
    assert (full[3].inv_ids, full[3].clk_ids, full[3].user_id) == ([], [], 0)
    bare = features.behavior_features(raw.drop("article_ids_clicked", "session_id"), articles, users, None)
    rows = {r.impression_id: r for r in bare.collect()}
    assert "session_id" not in bare.columns
    assert rows[1].clk_ids == [] and rows[1].inv_ids == [1, 0, 2] and rows[3].user_id is None


def test_splits(spark, tmp_path):
    root = str(tmp_path)
    raw_behaviors(spark).write.parquet(f"{root}/train/behaviors.parquet")
    raw_behaviors(spark).write.parquet(f"{root}/val/behaviors.parquet")
    assert readers.read_split(spark, root, "test", "behaviors") is None
    assert readers.read_split(spark, root, "validation", "behaviors", ["user_id"]).columns == ["user_id"]
    users = readers.read_splits(spark, root, "behaviors", ["user_id"])
    assert users.count() == 6 and encode.user_index(users).count() == 3
    assert readers.read_splits(spark, root, "history", ["user_id"]) is None


def test_aliases_keys_and_clicks(spark):
    df = spark.createDataFrame([([1, 2, 3], [0, 1, 1])], "inv_ids array<int>, labels array<int>")
    df = readers.resolve_column(df, readers.INVIEW_NAMES, "article_ids_inview")
    assert readers.with_clicks(df).first().clk_ids == [2, 3]
    assert readers.with_clicks(df.drop("labels")).first().clk_ids == []
    clicked = df.withColumn("article_ids_clicked", F.array(F.lit(1)))
    assert readers.with_clicks(clicked).first().clk_ids == [1]
    with pytest.raises(ValueError):
        readers.resolve_column(df, ["nope"], "x")
    with pytest.raises(ValueError):
        readers.with_impression_key(df)
    assert readers.with_impression_key(df, compat=True).first().impression_id == 0
    keyed = readers.with_impression_key(df.withColumn("k", F.lit(5)), "k")
    assert keyed.first().impression_id == 5


def test_row_filters(spark):
    rows = [("12", [1], []), ("x1", [1], [1]), ("13", [], [2]), (None, [1], []), ("14", None, None)]
    df = spark.createDataFrame(rows, "user_id string, article_ids_inview array<int>, clk array<int>")
    assert [r.user_id for r in features.valid_rows(df).collect()] == [12]
    assert features.with_any_item(df, "article_ids_inview", "clk").count() == 4
    assert features.clicked_only(df, "clk").count() == 2


def test_build_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for _ in range(2):
        assert sinks.materialize(spark, str(tmp_path / "t"), build).count() == 5
    assert len(calls) == 1


def test_bucketed_tables_join_without_an_exchange(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"drop table if exists {name}")
    a = sinks.materialize_bucketed(spark, "bucketed_a", lambda: spark.range(50).withColumnRenamed("id", "user_id"), "user_id", 4)
    b = sinks.materialize_bucketed(spark, "bucketed_b", lambda: spark.range(50).withColumnRenamed("id", "user_id"), "user_id", 4)
    joined = a.join(b, "user_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"drop table {name}")


def test_vector_width_and_schema_alignment(spark):
    same = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "v array<double>")
    assert readers.check_vector_width(same, "v") == 2
    with pytest.raises(ValueError):
        readers.check_vector_width(same.union(spark.createDataFrame([([1.0],)], "v array<double>")), "v")
    other = spark.createDataFrame([("7", 1)], "b string, a int")
    target = spark.createDataFrame([(1, 2)], "a bigint, b int").schema
    assert readers.align_schema(other, target).schema.simpleString() == "struct<a:bigint,b:int>"


def test_embedding_table_has_a_zero_pad_row(spark):
    vectors = "title_vector array<float>, body_vector array<float>, category_vector array<float>"
    rows = [(40, [1.0, 2.0], [3.0, 4.0], [5.0, 6.0]), (30, [7.0, 8.0], [9.0, 1.0], [2.0, 3.0])]
    index = encode.article_index(spark.createDataFrame([(30,), (40,)], "article_id int"))
    out = sinks.embedding_table(spark.createDataFrame(rows, "article_id int, " + vectors), index, 2)
    got = {r.idx: (r.article_id, r.title_vector) for r in out.collect()}
    assert got == {0: (-1, [0.0, 0.0]), 1: (30, [7.0, 8.0]), 2: (40, [1.0, 2.0])}


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    articles, users = maps(spark)
    raw = raw_behaviors(spark)
    folder = f"{tmp_path}/in"
    raw.where("impression_id < 3").repartition(2).write.parquet(folder)

    def run():
        source = stream.read_behavior_stream(spark, folder, raw.schema, files_per_trigger=1)
        encoded = stream.encode_behaviors_long(source, articles, users)
        stream.run_to_completion(encoded, f"{tmp_path}/out", f"{tmp_path}/progress")
        return sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))

    def batch(rows):
        return sorted(map(tuple, stream.encode_behaviors_long(rows, articles, users).collect()))

    assert run() == batch(raw.where("impression_id < 3"))
    late = raw.where("impression_id = 1").withColumn("impression_id", F.lit(4).cast("bigint"))
    late.write.mode("append").parquet(folder)
    assert run() == batch(raw.where("impression_id < 3").union(late))


def test_working_paths_lie_in_the_shared_folder(spark):
    path = session.working_path(spark, "x")
    assert path.startswith(session.shared_dir(spark)) and path != session.working_path(spark, "x")


class _Context:
    """Stands in for a context without a checkpoint folder."""

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, setting=None):
        self.sparkContext = _Context(master)
        self.conf = {session.CHECKPOINT_SETTING: setting} if setting else {}


def test_shared_folder_rules():
    assert session.shared_dir(_Session("k8s://x", "s3://b/ck/")) == "s3://b/ck"
    with pytest.raises(ValueError):
        session.shared_dir(_Session("k8s://x"))
    local = _Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.sparkContext.folder
