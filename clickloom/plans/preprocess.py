"""Queries: scans, projections, scalar functions, dictionaries, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import arrays, hashing, quality, scalar
from clickloom.operators import encode, features, history
from clickloom.operators.ordering import latest_by, position_by_slice
from clickloom.plans import clicklog
from clickloom.plans.registry import big, query, r6
from clickloom.sources import readers


@query("scan_project", "select doc_id, lang, source, n_chars from documents")
def scan_project(log):
    return readers.scan(log.spark, f"{log.folder}/documents.parquet", ["doc_id", "lang", "source", "n_chars"])


@query("distinct_users", "select distinct user_id from events")
def distinct_users(log):
    return readers.scan(log.spark, f"{log.folder}/events.parquet", ["user_id"]).distinct()


@query(
    "behaviors_without_clicks",
    """select impression_id, count(*) n_inview, cast(0 as bigint) n_clicked, impression_id session_id
    from bl_test group by impression_id""",
)
def behaviors_without_clicks(log):
    rows = log.behaviors("test", clicks=False)
    return readers.with_clicks(rows).select(
        "impression_id",
        big(F.size("article_ids_inview"), "n_inview"),
        big(F.size("clk_ids"), "n_clicked"),
        readers.optional_column(rows, "session_id", "bigint").alias("session_id"),
    )


@query(
    "clicks_from_labels",
    """select impression_id, row_number() over (partition by impression_id order by pos)-1 pos, article_id
    from bl_train where clicked=1""",
)
def clicks_from_labels(log):
    rows = log.behaviors("train")
    flags = arrays.click_flags(F.col("article_ids_inview"), F.col("article_ids_clicked"))
    labelled = rows.withColumn("labels", flags).drop("article_ids_clicked")
    renamed = labelled.withColumnRenamed("article_ids_inview", "inv_ids")
    resolved = readers.resolve_column(renamed, readers.INVIEW_NAMES, "article_ids_inview")
    clicks = readers.with_clicks(resolved)
    return clicks.select("impression_id", F.posexplode("clk_ids").alias("pos", "article_id")).select(
        "impression_id", big("pos", "pos"), "article_id"
    )


@query(
    "shard_assign",
    """select impression_id, ('0x'||substr(md5('0|'||impression_id),1,8))::bigint % 8 shard
    from (select distinct impression_id from bl_train)""",
)
def shard_assign(log):
    return log.behaviors("train").select(
        "impression_id", hashing.shard_of(F.col("impression_id"), 8).alias("shard")
    )


@query(
    "articles_features",
    """select article_id, id_encoded::bigint id_encoded, cat_encoded::bigint cat_encoded,
      round(norm_views,5) norm_views, round(norm_inviews,5) norm_inviews,
      round(sentiment_score,5) sentiment_score, round(norm_read_time,4)::double norm_read_time,
      published_time from feats""",
)
def articles_features(log):
    raw = log.raw_articles
    index = encode.article_index(log.article_ids())
    out = features.article_features(raw, encode.category_codes(log.article_documents), index)

    def stored(name, digits=5):
        return F.round(F.col(name).cast("double"), digits).alias(name)

    return out.select(
        "article_id", big("id_encoded", "id_encoded"), big("cat_encoded", "cat_encoded"),
        stored("norm_views"), stored("norm_inviews"), stored("sentiment_score"),
        stored("norm_read_time", 4), "published_time",
    )


@query(
    "history_features",
    """select h.user_id, u.idx user_idx, row_number() over (partition by h.user_id order by t,event_id)-1 pos,
      coalesce(a.idx,0) id_encoded, round(scroll,4) scroll, round(read_time,3) read_time, round(t,6) ts
    from hist_train h join user_idx u using (user_id) left join art_idx a using (article_id)""",
)
def history_features(log):
    items = position_by_slice(
        log.history_items("train"), ["user_id"], clicklog.STORED, F.date_trunc("hour", "impression_time")
    )
    users = encode.user_index(log.split_users())
    articles = encode.article_index(log.article_ids())
    out = features.history_item_features(items, articles, users)
    return out.select(
        "user_id", big("user_idx", "user_idx"), "pos", big("id_encoded", "id_encoded"),
        F.round(F.col("scroll").cast("double"), 4).alias("scroll"),
        F.round(F.col("read_time").cast("double"), 3).alias("read_time"),
        r6("ts", "ts"),
    )


@query(
    "history_features_lists",
    """select u.idx user_id, h.pos, coalesce(a.idx,0) hist_id, round(scroll,4) hist_scroll,
      round(read_time,3) hist_time, round(t,6) hist_ts
    from first50_train h join user_idx u using (user_id) left join art_idx a using (article_id)""",
)
def history_features_lists(log):
    """The list form, on histories already cut to 50 items."""
    raw = log.history_items("train")
    fields = ["article_id", "scroll_percentage", "read_time", "impression_time"]
    lists = history.history_lists(raw, "head", 50, clicklog.STORED, fields)
    wide = lists.select("user_id", *[
        F.col("hist")[f].alias(to) for f, to in zip(
            fields, ["article_id_fixed", "scroll_percentage_fixed", "read_time_fixed", "impression_time_fixed"])
    ])
    users = encode.user_index(log.split_users())
    articles = encode.article_index(log.article_ids())
    out = features.history_features(wide, articles, users)
    item = F.posexplode(F.arrays_zip("hist_ids", "hist_scroll", "hist_time", "hist_ts"))
    return out.select("user_id", item.alias("pos", "x")).select(
        big("user_id", "user_id"), big("pos", "pos"), big("x.hist_ids", "hist_id"),
        F.round(F.col("x.hist_scroll").cast("double"), 4).alias("hist_scroll"),
        F.round(F.col("x.hist_time").cast("double"), 3).alias("hist_time"),
        r6("x.hist_ts", "hist_ts"),
    )


@query(
    "behaviors_features",
    """select i.impression_id, u.idx user_id, round(imp_t,6) imp_ts, coalesce(device_type,0)::bigint device_type,
      round(coalesce(age,0)/100.0,4) norm_age, coalesce(gender,0)::bigint gender,
      is_subscriber::bigint is_subscriber, coalesce(is_sso_user,0)::bigint is_sso_user, session_id,
      l.inv_ids, coalesce(l.clk_ids,'') clk_ids
    from imp_train i join user_idx u using (user_id) join (
      select impression_id, string_agg(coalesce(idx,0)::varchar, ',' order by pos) inv_ids,
        string_agg(coalesce(idx,0)::varchar, ',' order by pos) filter (clicked=1) clk_ids
      from bl_train left join art_idx using (article_id) group by impression_id) l using (impression_id)""",
    unknown_articles=True,
)
def behaviors_features(log):
    rows = log.behaviors("train")
    users = encode.user_index(log.split_users())
    articles = encode.article_index(log.article_ids())
    out = features.behavior_features(rows, articles, users)
    return out.select(
        "impression_id", big("user_id", "user_id"), r6("imp_ts", "imp_ts"),
        big("device_type", "device_type"),
        F.round(F.col("norm_age").cast("double"), 4).alias("norm_age"),
        *[big(c, c) for c in ("gender", "is_subscriber", "is_sso_user", "session_id")],
        F.array_join(F.col("inv_ids").cast("array<string>"), ",").alias("inv_ids"),
        F.array_join(F.col("clk_ids").cast("array<string>"), ",").alias("clk_ids"),
    )


@query(
    "article_text",
    """select article_id, published published_time, coalesce(category_str,'UNK') category_str,
      coalesce(title,'')||' '||coalesce(subtitle,'') full_title, substr(coalesce(body,''),1,1000) body,
      md5('passage: '||coalesce(body,'')) passage_key from articles""",
)
def article_text(log):
    raw = log.article_documents
    whole = features.article_text(raw, None)
    published = scalar.epoch_seconds(F.col("published_time"), raw.schema["published_time"].dataType)
    return whole.select(
        "article_id", published.alias("published_time"), "category_str", "full_title",
        scalar.text_head(F.col("body"), 1000).alias("body"),
        F.md5(scalar.with_prefix(F.col("body"))).alias("passage_key"),
    )


@query(
    "train_impressions",
    "select impression_id, user_id, n_inview, n_clicked::bigint n_clicked from imp_train where n_clicked>0",
)
def train_impressions(log):
    return features.clicked_only(log.behaviors("train")).select(
        "impression_id", "user_id",
        big(F.size("article_ids_inview"), "n_inview"), big(F.size("article_ids_clicked"), "n_clicked"),
    )


@query(
    "valid_rows",
    """select impression_id, user_id, (n_inview-n_clicked)::bigint n_candidates from imp_train
    where device_type is not null and n_inview>n_clicked""",
)
def valid_rows(log):
    """Users without a device carry a text id; candidates are the unclicked articles."""
    rows = log.behaviors("train")
    text_id = F.when(F.col("device_type").isNull(), F.concat(F.lit("guest-"), F.col("user_id"))).otherwise(
        F.col("user_id").cast("string"))
    pool = arrays.not_clicked(F.col("article_ids_inview"), F.col("article_ids_clicked"))
    dirty = rows.withColumn("user_id", text_id).withColumn("article_ids_inview", pool)
    return features.valid_rows(dirty).select(
        "impression_id", "user_id", big(F.size("article_ids_inview"), "n_candidates")
    )


@query("epoch_seconds", "select event_id, round(epoch_us(ts)/1000000.0,6) epoch_s from events")
def epoch_seconds(log):
    events = log.click_events()
    t = scalar.epoch_seconds(F.col("ts"), events.schema["ts"].dataType)
    return events.select("event_id", r6(t, "epoch_s"))


@query("category_codes", "select category_str, code from cat_code")
def category_codes(log):
    return encode.category_codes(log.article_documents)


@query("category_dictionary", "select category_str, cat_id from cat_dict")
def category_dictionary(log):
    return encode.category_dictionary(log.article_documents)


@query("article_index", "select article_id, idx from art_idx")
def article_index(log):
    return encode.article_index(log.article_ids())


@query("user_index", "select user_id, idx from user_idx")
def user_index(log):
    return encode.user_index(*[log.behaviors(s) for s in clicklog.SPLITS])


@query(
    "encode_users",
    "select e.event_id, e.user_id, coalesce(u.idx,0) idx from ev e left join user_idx u using (user_id)",
)
def encode_users(log):
    events = log.click_events()
    index = encode.user_index(log.split_users())
    return encode.encode_column(events.select("event_id", "user_id"), "user_id", index, "idx").select(
        "event_id", "user_id", "idx"
    )


@query(
    "encode_inview",
    """select impression_id, string_agg(coalesce(idx,0)::varchar, ',' order by pos) inv_ids
    from bl_train left join art_idx using (article_id) group by impression_id""",
    unknown_articles=True,
)
def encode_inview(log):
    rows = log.behaviors("train").select("impression_id", "article_ids_inview")
    index = encode.article_index(log.article_ids())
    out = encode.encode_lists(rows, {"article_ids_inview": "inv_ids"}, index)
    return out.select(
        "impression_id", F.array_join(F.col("inv_ids").cast("array<string>"), ",").alias("inv_ids")
    )


@query(
    "encode_repeated_ids",
    """select impression_id%3 impression_id, string_agg(coalesce(idx,0)::varchar, ',' order by pos) inv_ids
    from bl_train left join art_idx using (article_id) group by bl_train.impression_id""",
)
def encode_repeated_ids(log):
    """Impressions share three ids; every row keeps its own list."""
    rows = log.behaviors("train").select(
        (F.col("impression_id") % 3).alias("impression_id"), "article_ids_inview"
    )
    index = encode.article_index(log.article_ids())
    out = encode.encode_lists(rows, {"article_ids_inview": "inv_ids"}, index)
    return out.select(
        "impression_id", F.array_join(F.col("inv_ids").cast("array<string>"), ",").alias("inv_ids")
    )


@query("history_log_time", "select event_id, user_id, round(log_time,6)+0.0 log_time from hist_validation")
def history_log_time(log):
    return history.clean_items(log.history_items("validation")).select(
        "event_id", "user_id", r6("log_time", "log_time")
    )


@query(
    "quality_flags",
    """select event_id, (log_time>4.0 and scroll>0.2)::bigint high,
      ((log_time<1.3 or scroll<0.1) and not (log_time>4.0 and scroll>0.2))::bigint low from hist_train""",
)
def quality_flags(log):
    items = history.clean_items(log.history_items("train"))
    t, s = F.col("log_time"), F.col("scroll")
    return items.select(
        "event_id", big(quality.is_high(t, s), "high"), big(quality.is_low(t, s), "low")
    )


@query(
    "quality_buckets",
    """select event_id, trunc(least(greatest(log_time/6.0,0),1)*19)::bigint time_bucket,
      trunc(least(greatest(scroll,0),1)*10)::bigint scroll_bucket from hist_train""",
)
def quality_buckets(log):
    items = history.clean_items(log.history_items("train"))
    return items.select(
        "event_id",
        big(quality.time_bucket(F.col("log_time")), "time_bucket"),
        big(quality.scroll_bucket(F.col("scroll")), "scroll_bucket"),
    )


@query(
    "sinusoidal",
    """select impression_id, j pos, round(case when j<8 then sin(x*exp(-j*ln(10000)/8))
      else cos(x*exp(-(j-8)*ln(10000)/8)) end,6)+0.0 enc
    from (select impression_id, (imp_t%86400)/86400.0 x from imp_train), range(16) r(j)""",
)
def sinusoidal(log):
    rows = log.behaviors("train")
    t = scalar.epoch_seconds(F.col("impression_time"), rows.schema["impression_time"].dataType)
    return rows.select(
        "impression_id", F.posexplode(arrays.sinusoidal(scalar.time_of_day(t))).alias("pos", "enc")
    ).select("impression_id", big("pos", "pos"), r6("enc", "enc"))


@query(
    "dedupe_latest",
    """select user_id, article_id, event_id, round(value,6) as "value" from (select *, row_number() over
      (partition by user_id, article_id order by ts desc, event_id desc) rn from ev) where rn=1""",
)
def dedupe_latest(log):
    """Last write wins for a repeated (user, article)."""
    rows = log.click_events().select("user_id", "article_id", "event_id", "ts", "value")
    last = latest_by(rows, ["user_id", "article_id"], ["ts", "event_id"])
    return last.select("user_id", "article_id", "event_id", r6("value", "value"))


@query(
    "last_row_wins",
    """select user_id, article_id, event_id, round(value,6) as "value" from (select *, row_number() over
      (partition by user_id, article_id order by event_id desc) rn from ev) where rn=1""",
)
def last_row_wins(log):
    """Of rows with equal ids the last one in the file stays (here they lie by event id)."""
    article = F.get_json_object("props", "$.k").cast("bigint")
    rows = readers.with_scan_order(log.table("events")).withColumn("article_id", article)
    narrow = rows.select("user_id", "article_id", "event_id", "value", *readers.SCAN_ORDER)
    return readers.last_rows(narrow, ["user_id", "article_id"]).select(
        "user_id", "article_id", "event_id", r6("value", "value")
    )
