"""Queries: vectors, profiles, scorers, candidate features, category joins."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from clickloom.functions import vectors
from clickloom.operators import candidates, encode, features, history, listwise, profiles, ranker, sampling, scoring
from clickloom.operators.joins import lookup
from clickloom.plans.histories import cut, lists
from clickloom.plans.registry import big, query, r6
from clickloom.session import stage
from clickloom.sources import readers, sinks


def plain_vectors(log):
    return profiles.article_vectors(log.embeddings(), "article_id", "vector")


def unit_vectors(log):
    return profiles.article_vectors(
        log.embeddings(), "article_id", "vector", eps=1e-4, normalize=True
    )


def impressions(log, split):
    return candidates.full_candidates(log.behaviors(split))


KEEP = ("impression_id", "user_id")


def similarity(log, split, rows=None, keep=KEEP):
    vecs = unit_vectors(log)
    mean = profiles.mean_profiles(cut(log, split), vecs)
    rows = impressions(log, split) if rows is None else rows
    return scoring.score_candidates(rows, mean, vecs, keep)


def uniform(log, split):
    vecs = plain_vectors(log)
    mean = profiles.mean_profiles(cut(log, split, "head", 50), vecs, mask_unknown=False)
    return scoring.score_candidates(impressions(log, split), mean, vecs, KEEP)


def quality_profiles(log, split):
    reads = history.clean_items(cut(log, split, "recent"))
    return profiles.quality_profiles(reads, plain_vectors(log))


def quality_scores(log, split):
    return scoring.score_candidates(
        impressions(log, split), quality_profiles(log, split), plain_vectors(log), KEEP, scale_by_width=True
    )


def all_models(log, split):
    """The three scorers over the same impressions, in one pass: one table of profiles, and
    one stored vector and its length per article."""
    stored = log.embeddings()
    eps = F.lit(1e-4)
    known = stored.select("article_id", "vector", (vectors.l2_norm(vectors.as_doubles(F.col("vector"))) + eps).alias("norm"))
    joint = profiles.joint_profiles(
        history.list_items(lists(log, split, "recent")), cut(log, split, "head", 50), known, "norm"
    )
    scorers = {
        "similarity": scoring.Scorer(joint, profile="similarity", divide_by="norm"),
        "uniform": scoring.Scorer(joint, profile="uniform"),
        "quality": scoring.Scorer(joint, profile="quality", scale_by_width=True),
    }
    return scoring.score_models(impressions(log, split), scorers, known, KEEP)


def _scores(df):
    return df.select("impression_id", big("pos", "pos"), "article_id", big("label", "label"), r6("score", "score"))


def _scores_sql(view):
    return f"select impression_id, pos, article_id, label::bigint as label, round(score,6)+0.0 score from {view}"


@query("similarity_scores", _scores_sql("sim_validation"))
def similarity_scores(log):
    return _scores(similarity(log, "validation"))


@query("score_mean_first50", _scores_sql("uni_validation"))
def score_mean_first50(log):
    return _scores(uniform(log, "validation"))


@query("quality_profile_score", _scores_sql("qual_validation"))
def quality_profile_score(log):
    return _scores(quality_scores(log, "validation"))


def _normalized(log, eps):
    out = profiles.article_vectors(
        log.table("embeddings"), "vec_id", "embedding", eps=eps, normalize=True
    )
    return out.select("article_id", F.posexplode("vector").alias("pos", "x")).select(
        "article_id", big("pos", "pos"), r6("x", "x")
    )


def _normalized_sql(norm):
    return f"""select article_id, pos::bigint pos, round(x/n,6)+0.0 x from (
      select vec_id article_id, unnest(v) x, generate_subscripts(v,1)-1 pos, {norm} n
      from (select vec_id, cast(embedding as double[]) v from embeddings))"""


@query("l2_normalize", _normalized_sql("sqrt(list_dot_product(v,v))"))
def l2_normalize(log):
    return _normalized(log, None)


@query("l2_normalize_eps", _normalized_sql("sqrt(list_dot_product(v,v))+1e-4"))
def l2_normalize_eps(log):
    return _normalized(log, 1e-4)


@query(
    "vector_width",
    "select len(embedding)::bigint width, count(*) n_vectors from embeddings group by 1",
)
def vector_width(log):
    return readers.vector_widths(log.table("embeddings"), "embedding")


@query(
    "user_mean_vector",
    "select user_id, (unnest(generate_series(1,len(p)))-1)::bigint pos, round(unnest(p),6)+0.0 x from sim_user_train",
)
def user_mean_vector(log):
    out = profiles.mean_profiles(cut(log, "train"), unit_vectors(log))
    return out.select("user_id", F.posexplode("profile").alias("pos", "x")).select(
        "user_id", big("pos", "pos"), r6("x", "x")
    )


def category_means(log):
    """(category_str, category_vector): mean vector of a category's articles."""
    text = features.article_text(log.article_documents).select("article_id", "category_str")
    vecs = text.join(plain_vectors(log), "article_id")
    mean = vector_to_array(Summarizer.mean(array_to_vector("vector")))
    return vecs.groupBy("category_str").agg(mean.alias("category_vector"))


_CATEGORY_MEANS = """(select category_str, list(m order by d) cv from (
  select coalesce(a.category_str,'UNK') category_str, v.d, avg(v.x) m
  from articles a join vecl v using (article_id) group by 1,2) group by 1)"""


@query(
    "category_join",
    f"""select a.article_id, coalesce(a.category_str,'UNK') category_str, round(cv[1],6)+0.0 first_x,
      round(list_sum(cv),6)+0.0 sum_x from articles a
      left join {_CATEGORY_MEANS} c on c.category_str=coalesce(a.category_str,'UNK')""",
)
def category_join(log):
    text = features.article_text(log.article_documents).select("article_id", "category_str")
    joined = lookup(text, category_means(log), "category_str")
    total = F.aggregate("category_vector", F.lit(0.0), lambda acc, x: acc + x)
    return joined.select(
        "article_id", "category_str", r6(F.get("category_vector", F.lit(0)), "first_x"), r6(total, "sum_x")
    )


@query(
    "embedding_table",
    f"""select idx, article_id, 64::bigint width, coalesce(round(v[1],5)+0.0,0.0) title_x, coalesce(round(v[64],5)+0.0,0.0) body_x,
      coalesce(round(cv[1],5)+0.0,0.0) category_x from art_idx left join vec using (article_id) join articles using (article_id)
      left join {_CATEGORY_MEANS} c on c.category_str=coalesce(articles.category_str,'UNK')
    union all select 0, -1, 64, 0.0, 0.0, 0.0""",
)
def embedding_table(log):
    """All articles and the zero pad row; an article without a vector gets zeros too.

    The body vector here is the title vector reversed.
    """
    width = readers.check_vector_width(log.embeddings(), "vector")
    zero = F.array_repeat(F.lit(0.0).cast("float"), width)
    text = features.article_text(log.article_documents).select("article_id", "category_str")
    embedded = (
        text.join(plain_vectors(log), "article_id", "left")
        .join(category_means(log), "category_str", "left")
        .select(
            "article_id", F.coalesce("vector", zero).alias("title_vector"),
            F.reverse(F.coalesce("vector", zero)).alias("body_vector"),
            F.coalesce("category_vector", zero).alias("category_vector"),
        )
    )
    out = sinks.embedding_table(embedded, encode.article_index(log.article_ids()), width)
    first = F.lit(0)

    def digit(name, to):
        return (F.round(F.get(name, first).cast("double"), 5) + F.lit(0.0)).alias(to)

    return out.select(
        "idx", "article_id", big(F.size("title_vector"), "width"),
        digit("title_vector", "title_x"), digit("body_vector", "body_x"), digit("category_vector", "category_x"),
    )


def article_numbers(log):
    return features.article_features(log.raw_articles, encode.category_codes(log.article_documents))


def feature_rows(log, split, rows, keep, feats=None):
    """`feats`: the `article_numbers`, stored, where several splits need them."""
    feats = article_numbers(log) if feats is None else feats
    vecs = unit_vectors(log)
    per_user = lists(log, split)
    mean = profiles.mean_profiles(history.list_items(per_user), vecs)
    return scoring.candidate_features(rows, per_user, mean, feats, vecs, keep)


_FEATURES = """select b.impression_id, b.pos, b.article_id, b.clicked::bigint as label,
  (f.article_id is null)::bigint is_unknown, coalesce(f.cat_encoded,0)::bigint cat_encoded,
  round(coalesce(norm_views,0),5) norm_views, round(coalesce(norm_inviews,0),5) norm_inviews,
  round(coalesce(sentiment_score,0),5) sentiment_score, round(coalesce(norm_read_time,0),4) norm_read_time,
  round(case when f.article_id is null then 0 else ln(1+abs(b.imp_t-f.published_time)/3600.0) end,6) freshness,
  round(s.score,6)+0.0 similarity,
  round(ln(1+coalesce(h.n,0)),6) log_hist_len, round((b.imp_t%86400)/86400.0,6) day_time,
  round(case when b.user_id%5=0 then 20+b.user_id%60 else 0 end/100.0,6) norm_age,
  round(coalesce(h.ms,0),6) mean_scroll, round(coalesce(h.xs,0),6) max_scroll,
  round(coalesce(h.mt,0),6) mean_time, round(coalesce(h.xt,0),6) max_time,
  round(coalesce(r.m,0),6) mean_recency, round(coalesce(r.x,0),6) max_recency
from bl_validation b
left join feats f on f.article_id=b.article_id
join sim_validation s on s.impression_id=b.impression_id and s.pos=b.pos
left join (select user_id, count(*) n, avg(scroll) ms, max(scroll) xs, avg(clean_time) mt, max(clean_time) xt
  from recent30_validation group by 1) h on h.user_id=b.user_id
left join (select impression_id, avg(v) m, max(v) x from (
  select i.impression_id, ln(1+greatest((i.imp_t-q.t)/3600.0,0)) v
  from imp_validation i join recent30_validation q using (user_id)) group by 1) r on r.impression_id=b.impression_id"""


@query("candidate_features", _FEATURES)
def candidate_features(log):
    out = feature_rows(log, "validation", impressions(log, "validation"), ["impression_id"])

    def digits(name):
        return 4 if name == "norm_read_time" else 5 if name in ("norm_views", "norm_inviews", "sentiment_score") else 6

    return out.select(
        "impression_id", big("pos", "pos"), "article_id", big("label", "label"),
        big("is_unknown", "is_unknown"), big("cat_encoded", "cat_encoded"),
        *[(F.round(c, digits(c)) + F.lit(0.0)).alias(c) for c in scoring.NUMERIC_FEATURES],
    )


# Weights of the stand-in external model.
_LINEAR = {"similarity": 2.0, "freshness": -0.25, "norm_views": 0.5, "log_hist_len": 0.125}


def _make_linear():
    import numpy as np

    weights = np.array(list(_LINEAR.values()))

    def predict(batch):
        return batch.astype("float64") @ weights

    return predict


@query(
    "external_model_scores",
    f"""select impression_id, pos, article_id, round(2.0*similarity-0.25*freshness+0.5*norm_views+0.125*log_hist_len,4)+0.0 score
    from ({_FEATURES.replace("round(s.score,6)+0.0 similarity", "s.score similarity")
        .replace("round(coalesce(norm_views,0),5) norm_views", "coalesce(norm_views,0) norm_views")
        .replace("/3600.0) end,6) freshness", "/3600.0) end,12) freshness")
        .replace("round(ln(1+coalesce(h.n,0)),6)", "ln(1+coalesce(h.n,0))")})""",
)
def external_model_scores(log):
    """Batch scoring of all candidates by a plugged-in model (here a linear one)."""
    rows = feature_rows(log, "validation", impressions(log, "validation"), ["impression_id"])
    scored = scoring.score_with(rows, _make_linear, list(_LINEAR))
    return scored.select(
        "impression_id", big("pos", "pos"), "article_id",
        (F.round("score", 4) + F.lit(0.0)).alias("score"),
    )


@query("learned_ranker")
def learned_ranker(log):
    """Fit on sampled training candidates, score full validation lists."""
    feats = stage(article_numbers(log), "articles")
    samples = sampling.sample_candidates(log.behaviors("train"), "cycled")
    train = feature_rows(log, "train", samples, ["impression_id"], feats)
    model = ranker.fit_ranker(train)
    rows = feature_rows(log, "validation", impressions(log, "validation"), ["impression_id"], feats)
    return ranker.score_ranker(model, rows).select(
        "impression_id", big("pos", "pos"), "article_id", big("label", "label"), r6("score", "score")
    )


# Weights, means and scales at which `listwise_totals` takes the loss and its gradient.
_AT = {"similarity": (1.5, 0.25, 0.5), "freshness": (-0.4, 4.0, 2.0), "norm_views": (0.3, 2.0, 1.0), "log_hist_len": (0.2, 3.0, 1.0)}


@query(
    "listwise_totals",
    f"""select * from (with c as (select impression_id, pos, label, {", ".join(f"({c}-{m})/{s} as x{j}" for j, (c, (_, m, s)) in enumerate(_AT.items()))}
        from ({_FEATURES})),
      s as (select *, {"+".join(f"{w}*x{j}" for j, (w, _, _) in enumerate(_AT.values()))} score from c),
      p as (select *, exp(score-max(score) over g)/sum(exp(score)) over g*exp(max(score) over g) share,
        label/sum(label) over g target, row_number() over (partition by impression_id order by pos) rn,
        ln(sum(exp(score)) over g) lse, sum(label) over g hits from s window g as (partition by impression_id)),
      h as (select * from p where hits>0)
    select 0 as "at", count(*) filter (rn=1)::double as value from h
    union all select 1, round(sum(lse) filter (rn=1)-sum(target*score),3) from h
    {" ".join(f"union all select {2 + j}, round(sum((share-target)*x{j}),3)+0.0 from h" for j in range(len(_AT)))})""",
)
def listwise_totals(log):
    """Number of lists, list-wise loss and its gradient over all validation lists."""
    rows = feature_rows(log, "validation", impressions(log, "validation"), ["impression_id"])
    lists = listwise.training_lists(rows, list(_AT))
    weights, means, scales = zip(*_AT.values(), strict=True)
    totals = listwise.list_totals(lists, np.array(weights), means, scales)
    return totals.where(F.col("at") < 2 + len(_AT)).select("at", (F.round("value", 3) + F.lit(0.0)).alias("value"))


@query(
    "listwise_ranker",
    """select impression_id, pos, article_id, clicked::bigint as label, 1::bigint finite, 1::bigint fitted
    from bl_validation""",
)
def listwise_ranker(log):
    """Fit on sampled training lists, score full validation lists: is every score a number, and
    did the gradient of the training loss vanish?"""
    feats = stage(article_numbers(log), "articles")
    samples = sampling.sample_candidates(log.behaviors("train"), "per_click")
    train = feature_rows(log, "train", samples, ["impression_id", "positive"], feats)
    model = listwise.fit_listwise(train, keys=["impression_id", "positive"])
    rows = feature_rows(log, "validation", impressions(log, "validation"), ["impression_id"], feats)
    finite = ~F.isnan("score") & (F.abs("score") < float("inf"))
    return listwise.score_listwise(model, rows).select(
        "impression_id", big("pos", "pos"), "article_id", big("label", "label"),
        big(F.coalesce(finite, F.lit(False)), "finite"), F.lit(int(model.gradient_norm < 1e-6)).cast("bigint").alias("fitted"),
    )
