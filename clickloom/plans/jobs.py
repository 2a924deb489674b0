"""Queries: text embedding jobs and the streaming preprocess job."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import encode, features, text
from clickloom.plans.registry import big, query, r6
from clickloom.session import working_path
from clickloom.sources import sinks
from clickloom.streaming import behaviors as stream

DIM = 256


def _weights_sql(source, ids):
    """Hashed-term weights of the texts of `source` (`*ids`, t), as rows of ids, bucket, x."""
    names = ", ".join(ids)
    return f"""(select {names}, bucket, round(w/nullif(sqrt(sum(w*w) over (partition by {names})),0),6)+0.0 x from (
      select {names}, bucket, n*ln(((select count(*) from {source})+1.0::double)/(count(*) over (partition by bucket)+1)) w
      from (select {names}, ('0x'||substr(md5(word),1,8))::bigint % {DIM} bucket, count(*) n
        from (select {names}, unnest(regexp_split_to_array(lower(coalesce(t,'')), '[^\\p{{L}}\\p{{N}}]+')) word from {source})
        where word<>'' group by all)))"""


_BODIES = "(select article_id, body t from articles)"
_TITLES = """(select article_id, case when coalesce(subtitle,'')='' then coalesce(title,'')
  else coalesce(title,'')||' '||subtitle end t from articles)"""
_DESCRIBED = """(select category_str, cat_id, case when category_str='UNK' then
  'General news content with no specific category.' else category_str end t from cat_dict)"""


@query("text_embedding", f"select article_id, bucket, coalesce(x,0) x from {_weights_sql(_BODIES, ['article_id'])}")
def text_embedding(log):
    """Whole bodies of all articles, in long form."""
    rows = features.article_text(log.article_documents, None).select("article_id", "body")
    return text.term_weights(rows, ["article_id"], "body", DIM).select("article_id", "bucket", r6("value", "x"))


def _categories(log):
    return encode.category_dictionary(log.article_documents)


def _category_weights(log):
    described = text.category_descriptions(_categories(log))
    return text.term_weights(described, ["category_str", "cat_id"], "description", DIM)


@query(
    "category_embedding",
    f"select category_str, cat_id, bucket, coalesce(x,0) x from {_weights_sql(_DESCRIBED, ['category_str', 'cat_id'])}",
)
def category_embedding(log):
    return _category_weights(log).select("category_str", "cat_id", "bucket", r6("value", "x"))


@query(
    "article_embedding_table",
    f"""select article_id, 'title' part, bucket, coalesce(x,0) x from {_weights_sql(_TITLES, ['article_id'])}
    union all select article_id, 'body', bucket, coalesce(x,0) from {_weights_sql(_BODIES, ['article_id'])}
    union all select article_id, 'category', bucket, coalesce(x,0) from articles a
      join {_weights_sql(_DESCRIBED, ['category_str', 'cat_id'])} c on c.category_str=coalesce(a.category_str,'UNK')""",
)
def article_embedding_table(log):
    """Title, body and category vectors of every article, in long form."""
    rows = features.article_text(log.article_documents, None)
    named = rows.select("article_id", "category_str")
    parts = {
        "title": text.term_weights(rows, ["article_id"], "full_title", DIM),
        "body": text.term_weights(rows, ["article_id"], "body", DIM),
        "category": named.join(_category_weights(log), "category_str"),
    }
    out = None
    for part, weights in parts.items():
        own = weights.select("article_id", F.lit(part).alias("part"), "bucket", r6("value", "x"))
        out = own if out is None else out.unionByName(own)
    return out


@query(
    "stream_behaviors",
    """select b.impression_id, b.pos, round(b.imp_t,6) imp_ts, u.idx user_idx, b.article_id,
      coalesce(a.idx,0) id_encoded, b.clicked::bigint as label
    from bl_train b left join user_idx u using (user_id) left join art_idx a on a.article_id=b.article_id""",
    unknown_articles=True,
)
def stream_behaviors(log):
    """Impressions arrive as files, are encoded by a streaming job, and land as Parquet."""
    folder = working_path(log.spark, "stream")
    arriving = log.behaviors("train")
    sinks.write_table(arriving, f"{folder}/in")
    articles = encode.article_index(log.article_ids())
    users = encode.user_index(log.split_users())
    source = stream.read_behavior_stream(log.spark, f"{folder}/in", arriving.schema, files_per_trigger=4)
    stream.run_to_completion(
        stream.encode_behaviors_long(source, articles, users), f"{folder}/out", f"{folder}/progress"
    )
    return log.spark.read.parquet(f"{folder}/out").select(
        "impression_id", big("pos", "pos"), r6("imp_ts", "imp_ts"), big("user_idx", "user_idx"),
        "article_id", big("id_encoded", "id_encoded"), big("label", "label"),
    )
