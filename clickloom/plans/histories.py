"""Queries: history cuts, padding, cold start, offsets, candidates, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import arrays, scalar
from clickloom.operators import candidates, history, sampling
from clickloom.operators.ordering import position_by_slice, running_total_of_ids
from clickloom.operators.scoring import impression_features as impression_feature_rows
from clickloom.plans import clicklog
from clickloom.plans.oracle import sample_sql
from clickloom.plans.registry import big, query, r6

LEN = 30


def cut(log, split, policy="tail", n=LEN):
    return history.cut_history(log.history_items(split), policy, n, clicklog.STORED)


def lists(log, split, policy="tail", n=LEN):
    return history.history_lists(log.history_items(split), policy, n, clicklog.STORED)


def exploded(df, *fields):
    return df.select("user_id", F.posexplode("hist").alias("pos", "x")).select(
        "user_id", big("pos", "pos"), *fields
    )


@query("history_head", "select user_id, pos, article_id from first50_test")
def history_head(log):
    return exploded(lists(log, "test", "head", 50), "x.article_id")


@query(
    "history_tail",
    "select user_id, pos, article_id, round(scroll,6) scroll, round(clean_time,6)+0.0 read_time, "
    "round(t,6) ts from recent30_validation",
)
def history_tail(log):
    """Last 30 in stored order, all fields from the same items."""
    return exploded(
        lists(log, "validation", "tail"),
        "x.article_id", r6("x.scroll", "scroll"), r6("x.read_time", "read_time"), r6("x.ts", "ts"),
    )


@query(
    "history_last30",
    "select user_id, pos, article_id, round(scroll,6) scroll, round(log_time,6)+0.0 log_time from recent30_train",
)
def history_last30(log):
    return exploded(
        lists(log, "train", "recent"),
        "x.article_id", r6("x.scroll", "scroll"), r6("x.log_time", "log_time"),
    )


@query(
    "history_stats",
    """select count(*) n_users, sum(n)::bigint n_items, max(n) longest, max(m) max_article_id
    from (select user_id, count(*) n, max(article_id) m from hist_test group by user_id)""",
)
def history_stats(log):
    per_user = log.history_items("test").groupBy("user_id").agg(
        F.count("article_id").alias("n"), F.max("article_id").alias("m")
    )
    return per_user.agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_items"),
        F.max("n").alias("longest"), F.max("m").alias("max_article_id"),
    )


@query(
    "history_offsets",
    """select user_id, n n_items, (sum(n) over (order by user_id)-n)::bigint start_offset
    from (select user_id, count(*) n from hist_train group by user_id)""",
)
def history_offsets(log):
    sizes = history.history_sizes(log.history_items("train"))
    return running_total_of_ids(sizes, "user_id", "n_items", "start_offset", inclusive=False)


@query(
    "history_explode",
    """select user_id, row_number() over (partition by user_id order by t,event_id)-1 pos, article_id,
      round(scroll_percentage,6) scroll_percentage, round(read_time,6) read_time from hist_test""",
)
def history_explode(log):
    """Long histories with their stored position, over all reads."""
    numbered = position_by_slice(
        log.history_items("test"), ["user_id"], clicklog.STORED, F.date_trunc("hour", "impression_time")
    )
    return numbered.select(
        "user_id", "pos", "article_id", r6("scroll_percentage", "scroll_percentage"), r6("read_time", "read_time")
    )


def _uneven_lists(log):
    """Last 30 reads as four lists; every third user's scrolls lack one, the next one's two."""
    fields = ["article_id", "scroll_percentage", "read_time", "impression_time"]
    raw = history.history_lists(log.history_items("validation"), "recent", LEN, clicklog.STORED, fields)
    wide = raw.select("user_id", *[
        history.field("hist", f).alias(c) for f, c in zip(fields, history.LIST_COLUMNS, strict=True)
    ])
    scroll = history.LIST_COLUMNS[1]
    kept = F.greatest(F.size(scroll) - (F.col("user_id") % 3).cast("int"), F.lit(0))
    return wide.withColumn(scroll, F.slice(scroll, F.lit(1), kept))


@query(
    "history_explode_lists",
    """select user_id, pos::bigint pos, article_id, case when pos<n-user_id%3 then round(scroll_percentage,6) end scroll_percentage,
      round(read_time,6)+0.0 read_time, round(t,6) ts
    from (select *, count(*) over (partition by user_id) n from recent30_validation)""",
)
def history_explode_lists(log):
    """Parallel lists of unequal lengths to items, aligned by the ids."""
    items = history.explode_history(_uneven_lists(log))
    ts = scalar.epoch_seconds(F.col("impression_time"), items.schema["impression_time"].dataType)
    return items.select(
        "user_id", big("pos", "pos"), "article_id", r6("scroll_percentage", "scroll_percentage"),
        r6("read_time", "read_time"), r6(ts, "ts"),
    )


@query(
    "misaligned_histories",
    """select count(*) n_rows, count(*) filter (user_id%3>0) n_misaligned
    from (select distinct user_id from recent30_validation)""",
)
def misaligned_histories(log):
    return history.misaligned_histories(_uneven_lists(log))


def _pad(log, side):
    fields = ["article_id", "scroll", "log_time"]
    wide = history.padded(lists(log, "train", "recent"), LEN, side, fields)
    return wide.select("user_id", F.posexplode(F.arrays_zip(*fields)).alias("pos", "x")).select(
        "user_id", big("pos", "pos"), "x.article_id", r6("x.scroll", "scroll"), r6("x.log_time", "log_time")
    )


def _padded_sql(shift):
    return f"""select u.user_id, u.i pos, coalesce(h.article_id,0) article_id, round(coalesce(h.scroll,0),6) scroll,
      round(coalesce(h.log_time,0),6)+0.0 log_time
    from (select user_id, n, i from (select user_id, count(*) n from recent30_train group by user_id), range(30) r(i)) u
    left join recent30_train h on h.user_id=u.user_id and h.pos={shift}"""


@query("history_pad_left", _padded_sql("u.i-(30-u.n)"))
def history_pad_left(log):
    return _pad(log, "left")


@query("history_pad_right", _padded_sql("u.i"))
def history_pad_right(log):
    return _pad(log, "right")


@query(
    "cold_start",
    """select i.impression_id, i.user_id, cast(30 as bigint) width, coalesce(h.n,0) n_real,
      round(coalesce(h.s,0),4) sum_scroll from imp_validation i left join
      (select user_id, count(*) filter (article_id<>0) n, sum(scroll) s from recent30_validation group by user_id) h
      using (user_id)""",
    cold_users=True,
)
def cold_start(log):
    """Fixed-length lists per impression, all zeros for a user without history."""
    rows = log.behaviors("validation").select("impression_id", "user_id")
    out = history.with_padded_history(
        rows, lists(log, "validation", "tail"), LEN, "right", ["article_id", "scroll"]
    )
    total = F.aggregate("scroll", F.lit(0.0), lambda acc, x: acc + x)
    return out.select(
        "impression_id", "user_id", big(F.size("article_id"), "width"),
        big(F.size(arrays.real_ids(F.col("article_id"))), "n_real"),
        F.round(total, 4).alias("sum_scroll"),
    )


@query(
    "impression_history",
    """select i.impression_id, i.user_id, coalesce(h.n,0) n_items, coalesce(h.ids,'') hist_ids
    from imp_test i left join (select user_id, count(*) n, string_agg(article_id::varchar,',' order by pos) ids
      from first50_test group by user_id) h using (user_id)""",
    cold_users=True,
)
def impression_history(log):
    rows = log.behaviors("test", clicks=False).select("impression_id", "user_id")
    out = history.with_history(rows, lists(log, "test", "head", 50))
    ids = F.col("hist")["article_id"].cast("array<string>")
    return out.select(
        "impression_id", "user_id", big(F.size("hist"), "n_items"), F.array_join(ids, ",").alias("hist_ids")
    )


@query(
    "impression_features",
    """select i.impression_id, round(ln(1+coalesce(h.n,0)),6) log_hist_len, round((imp_t%86400)/86400.0,6) day_time,
      round(coalesce(age,0)/100.0,6) norm_age from imp_validation i left join
      (select user_id, count(*) n from recent30_validation group by user_id) h using (user_id)""",
)
def impression_features(log):
    rows = log.behaviors("validation")
    out = impression_feature_rows(rows, lists(log, "validation"))
    return out.select(
        "impression_id", r6("log_hist_len", "log_hist_len"), r6("day_time", "day_time"), r6("norm_age", "norm_age")
    )


@query(
    "history_recency",
    """select i.impression_id, h.pos, h.article_id, round(ln(1+greatest((i.imp_t-h.t)/3600.0,0)),6)+0.0 recency
    from imp_validation i join recent30_validation h using (user_id)""",
)
def history_recency(log):
    rows = log.behaviors("validation")
    timed = impression_feature_rows(rows, lists(log, "validation"))
    zipped = F.arrays_zip(F.col("hist")["article_id"].alias("article_id"), arrays.recency_list(F.col("hist")["ts"], F.col("imp_ts")).alias("recency"))
    return timed.select("impression_id", F.posexplode(zipped).alias("pos", "x")).select(
        "impression_id", big("pos", "pos"), F.col("x.article_id").alias("article_id"), r6("x.recency", "recency")
    )


@query("labelled_candidates", "select impression_id, user_id, pos, article_id, clicked::bigint as label from bl_validation")
def labelled_candidates(log):
    rows = candidates.full_candidates(log.behaviors("validation"))
    return candidates.explode_candidates(rows, ["impression_id", "user_id"]).select(
        "impression_id", "user_id", big("pos", "pos"), "article_id", big("label", "label")
    )


@query(
    "negative_pool",
    """select impression_id, row_number() over (partition by impression_id order by pos)-1 pos, article_id
    from bl_train where clicked=0""",
)
def negative_pool(log):
    return candidates.negative_pool(log.behaviors("train")).select(
        "impression_id", big("pos", "pos"), "article_id"
    )


def _samples(log, policy, mode="random"):
    rows = sampling.sample_candidates(log.behaviors("train"), policy, mode=mode)
    return candidates.explode_candidates(rows, ["impression_id", "positive"]).select(
        "impression_id", "positive", big("pos", "pos"), big("article_id", "article_id"),
        big("label", "label"), big("valid", "valid"),
    )


@query("neg_sample_per_click", sample_sql("per_click", "bl_train"))
def neg_sample_per_click(log):
    return _samples(log, "per_click")


@query("neg_sample_padded", sample_sql("padded", "bl_train"))
def neg_sample_padded(log):
    return _samples(log, "padded")


@query("neg_sample_padded_validation", sample_sql("padded_first", "bl_train"))
def neg_sample_padded_validation(log):
    return _samples(log, "padded", "first")


@query("neg_sample_cycled", sample_sql("cycled", "bl_train"))
def neg_sample_cycled(log):
    return _samples(log, "cycled")


@query(
    "shuffled_samples",
    """select impression_id, positive, md5('42|'||impression_id||'|'||positive) shuffle_key,
      row_number() over (order by md5('42|'||impression_id||'|'||positive))-1 place
    from (select impression_id, article_id positive from bl_train where clicked=1)""",
)
def shuffled_samples(log):
    """The shuffled order made visible: each sample's place, numbered over ranges of keys."""
    from clickloom.operators.ordering import dense_index

    rows = sampling.sample_candidates(log.behaviors("train"), "per_click")
    shuffled = sampling.shuffle_samples(rows.select("impression_id", "positive"), ["impression_id", "positive"])
    return shuffled.join(dense_index(shuffled, "shuffle_key", 0, "place"), "shuffle_key").select(
        "impression_id", "positive", "shuffle_key", "place"
    )
