"""Queries: ranks, submission lines, metrics, losses, model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import candidates, metrics, ranking, sampling
from clickloom.plans.registry import big, query, r6
from clickloom.plans.scores import all_models, similarity
from clickloom.session import stage
from clickloom.sources import sinks


def fixed_scores(log, split="validation"):
    """A fixed score with many ties: ((37 * article + 11 * impression) mod 100) / 25 - 2."""
    rows = candidates.full_candidates(log.behaviors(split))
    flat = candidates.explode_candidates(rows, ["impression_id", "user_id"])
    score = ((F.col("article_id") * 37 + F.col("impression_id") * 11) % 100) / F.lit(25.0) - F.lit(2.0)
    return flat.withColumn("score", score)


@query(
    "candidate_ranks",
    """select impression_id, pos, article_id, row_number() over (partition by impression_id order by score desc,pos) as "rank"
    from fixed_test""",
)
def candidate_ranks(log):
    return ranking.rank_candidates(fixed_scores(log, "test")).select(
        "impression_id", big("pos", "pos"), "article_id", big("rank", "rank")
    )


@query(
    "submission_lines",
    """select impression_id, impression_id||' ['||string_agg(rk::varchar, ',' order by pos)||']' line from (
      select *, row_number() over (partition by impression_id order by score desc,pos) rk from fixed_test)
    group by impression_id""",
)
def submission_lines(log):
    return sinks.submission_lines(ranking.rank_candidates(fixed_scores(log, "test")))


@query(
    "top3",
    """select impression_id, article_id, rk::bigint as "rank" from (
      select *, row_number() over (partition by impression_id order by score desc,pos) rk from sim_validation)
    where rk<=3""",
)
def top3(log):
    return ranking.top_candidates(similarity(log, "validation"), 3).select(
        "impression_id", "article_id", big("rank", "rank")
    )


@query(
    "clicked_ranks",
    """select impression_id, article_id, pos, rk::bigint as "rank", n n_candidates, round(rk/n,6) rank_share,
      (rk<=5)::bigint hit from (select *, count(*) over (partition by impression_id) n,
        row_number() over (partition by impression_id order by score desc,pos) rk from fixed_validation)
    where label=1""",
)
def clicked_ranks(log):
    out = ranking.clicked_ranks(ranking.rank_candidates(fixed_scores(log)))
    return out.select(
        "impression_id", "article_id", big("pos", "pos"), big("rank", "rank"),
        big("n_candidates", "n_candidates"), r6("rank_share", "rank_share"), big("hit", "hit"),
    )


_MODEL_VIEWS = {"similarity": "sim_validation", "uniform": "uni_validation", "quality": "qual_validation"}
_STACKED = " union all ".join(
    f"select '{m}' model, impression_id, pos, article_id, label, score from {v}" for m, v in _MODEL_VIEWS.items()
)


@query(
    "model_comparison",
    f"""select model, impression_id, string_agg(article_id::varchar, ',' order by rk) filter (rk<=3) top_articles,
      (min(rk) filter (label=1))::bigint best_clicked_rank, count(*) filter (label=1 and rk<=5) hits, count(*) n_candidates
    from (select *, row_number() over (partition by model, impression_id order by score desc,pos) rk from ({_STACKED}))
    group by model, impression_id""",
)
def model_comparison(log):
    return ranking.compare_models(all_models(log, "validation")).select(
        "model", "impression_id", "top_articles", big("best_clicked_rank", "best_clicked_rank"),
        "hits", "n_candidates",
    )


@query("mrr", "select round(avg(rr),6) mrr, count(*) n_impressions from fixed_validation_per")
def mrr(log):
    return metrics.impression_metrics(fixed_scores(log)).agg(
        r6(F.avg("rr"), "mrr"), F.count(F.lit(1)).alias("n_impressions")
    )


@query(
    "ndcg",
    "select impression_id, round(ndcg5,6)+0.0 ndcg_5, round(ndcg10,6)+0.0 ndcg_10 from fixed_validation_per",
)
def ndcg(log):
    return metrics.impression_metrics(fixed_scores(log)).select(
        "impression_id", r6("ndcg5", "ndcg_5"), r6("ndcg10", "ndcg_10")
    )


@query(
    "auc_impression",
    "select impression_id, n n_candidates, n_pos::bigint n_pos, round(auc,6) auc from fixed_validation_per",
)
def auc_impression(log):
    return metrics.impression_metrics(fixed_scores(log)).select(
        "impression_id", F.col("n").alias("n_candidates"), "n_pos", r6("auc", "auc")
    )


@query(
    "auc_batched",
    """select count(*) n_batches, round(sum(auc*n)/sum(n),6) auc from (
      select batch_id, count(*) n, (sum(ar) filter (label=1)-sum(label)*(sum(label)+1)/2.0)
        /nullif(sum(label)*(count(*)-sum(label)),0) auc
      from (select *, rank() over (partition by batch_id order by score)
          +(count(*) over (partition by batch_id, score)-1)/2.0 ar
        from (select f.*, (dense_rank() over (order by impression_id)-1)//32 batch_id from fixed_validation f))
      group by batch_id) where auc is not null""",
)
def auc_batched(log):
    """Batches of 32 impressions."""
    return metrics.auc_batched(metrics.assign_batches(fixed_scores(log), 32)).select(
        "n_batches", r6("auc", "auc")
    )


@query(
    "auc_global",
    """select sum(label)::bigint n_pos, sum(1-label)::bigint n_neg,
      round((sum(ar) filter (label=1)-sum(label)*(sum(label)+1)/2.0)/(sum(label)*sum(1-label)),6) auc
    from (select *, rank() over (order by score)+(count(*) over (partition by score)-1)/2.0 ar from fixed_validation)""",
)
def auc_global(log):
    return metrics.auc_global(fixed_scores(log)).select("n_pos", "n_neg", r6("auc", "auc"))


_NAN = """(select impression_id, pos, article_id, label, case when pos%5=0 then -1e300 else score end score
  from fixed_validation)"""


@query(
    "auc_global_nan",
    f"""select sum(label)::bigint n_pos, sum(1-label)::bigint n_neg,
      round((sum(ar) filter (label=1)-sum(label)*(sum(label)+1)/2.0)/(sum(label)*sum(1-label)),6) auc
    from (select *, rank() over (order by score)+(count(*) over (partition by score)-1)/2.0 ar from {_NAN})""",
)
def auc_global_nan(log):
    """Every fifth score is NaN or null, which counts as the lowest."""
    missing = F.when(F.col("pos") % 10 == 0, F.lit(float("nan")))
    score = F.when(F.col("pos") % 5 == 0, missing).otherwise(F.col("score"))
    return metrics.auc_global(fixed_scores(log).withColumn("score", score)).select(
        "n_pos", "n_neg", r6("auc", "auc")
    )


@query("bce_loss", "select round(sum(bce_sum)/(sum(n)+1e-4),6) bce_loss from fixed_train_per")
def bce_loss(log):
    per = metrics.impression_metrics(fixed_scores(log, "train"))
    return per.agg(r6(F.sum("bce_sum") / (F.sum("n") + F.lit(metrics.EPS)), "bce_loss"))


@query("listnet_loss", "select round(avg(listnet),6) listnet_loss from fixed_train_per")
def listnet_loss(log):
    return metrics.impression_metrics(fixed_scores(log, "train")).agg(
        r6(F.avg("listnet"), "listnet_loss")
    )


_REPORT = """select {head} count(*) n_impressions, round(avg(auc),6) auc,
  round(sum(auc*n)/sum(n) filter (auc is not null),6) auc_weighted, round(avg(rr),6) mrr,
  round(avg(ndcg5),6) ndcg_5, round(avg(ndcg10),6) ndcg_10, round(sum(bce_sum)/(sum(n)+1e-4),6) bce_loss,
  round(avg(listnet),6) listnet_loss, round(sum(bce_sum)/(sum(n)+1e-4)+0.5*avg(listnet),6) loss
from {view}"""
_REPORT_COLUMNS = ("auc", "auc_weighted", "mrr", "ndcg_5", "ndcg_10", "bce_loss", "listnet_loss", "loss")
_BY_MODEL = " union all ".join(
    _REPORT.format(head=f"'{m}' model, 'full' candidates,", view=f"{v}_per") for m, v in _MODEL_VIEWS.items()
)


def report(log):
    """One row per model; the candidate policy is part of the row, as it moves the numbers."""
    rows = all_models(log, "validation").withColumn("candidates", F.lit("full"))
    return metrics.evaluate(rows, ["model", "candidates"])


@query("evaluate", _REPORT.format(head="'similarity' model, 'full' candidates,", view="sim_validation_per"))
def evaluate(log):
    rows = ranking.stack_models({"similarity": similarity(log, "validation")})
    out = metrics.evaluate(rows.withColumn("candidates", F.lit("full")), ["model", "candidates"])
    return out.select("model", "candidates", "n_impressions", *[r6(c, c) for c in _REPORT_COLUMNS])


_BATCHED = """select 'similarity' model, (select count(*) from sim_validation_per) n_impressions,
  (select round(sum(auc*n)/sum(n),6) from (
    select batch_id, count(*) n, (sum(ar) filter (label=1)-sum(label)*(sum(label)+1)/2.0)
      /nullif(sum(label)*(count(*)-sum(label)),0) auc
    from (select *, rank() over (partition by batch_id order by score)
        +(count(*) over (partition by batch_id, score)-1)/2.0 ar
      from (select f.*, (dense_rank() over (order by impression_id)-1)//32 batch_id from sim_validation f))
    group by batch_id) where auc is not null) auc,
  (select round(avg(rr),6) from sim_validation_per) mrr"""


@query("evaluate_batched", _BATCHED)
def evaluate_batched(log):
    """The report with the batch-flattened area, batches of 32 impressions."""
    rows = similarity(log, "validation").withColumn("model", F.lit("similarity"))
    out = metrics.evaluate_batched(rows, 32, ["model"])
    return out.select("model", "n_impressions", r6("auc", "auc"), r6("mrr", "mrr"))


@query("evaluate_models", _BY_MODEL)
def evaluate_models(log):
    return report(log).select("model", "candidates", "n_impressions", *[r6(c, c) for c in _REPORT_COLUMNS])


_POLICY_VIEWS = {"full": "sim_validation", "padded": "simpad", "cycled": "simcyc"}
_BY_POLICY = " union all ".join(
    _REPORT.format(head=f"'similarity' model, '{p}' candidates,", view=f"{v}_per") for p, v in _POLICY_VIEWS.items()
)


@query("evaluate_policies", _BY_POLICY)
def evaluate_policies(log):
    """One scorer on the three validation candidate sets, whose numbers do not compare."""
    shown = log.behaviors("validation")
    sets = {
        "full": candidates.full_candidates(shown),
        "padded": sampling.sample_candidates(shown, "padded", mode="first"),
        "cycled": sampling.sample_candidates(shown, "cycled"),
    }
    rows = None
    for policy, lists in sets.items():
        part = lists.select("impression_id", "user_id", "candidates", F.lit(policy).alias("policy"))
        rows = part if rows is None else rows.unionByName(part)
    scored = similarity(log, "validation", rows, ("impression_id", "user_id", "policy"))
    named = scored.withColumnRenamed("policy", "candidates").withColumn("model", F.lit("similarity"))
    out = metrics.evaluate(named, ["model", "candidates"])
    return out.select("model", "candidates", "n_impressions", *[r6(c, c) for c in _REPORT_COLUMNS])


_BEST = " union all ".join(
    f"""select '{m}' model, round(sum(auc*n)/sum(n),6) auc from (
      select batch_id, count(*) n, (sum(ar) filter (label=1)-sum(label)*(sum(label)+1)/2.0)
        /nullif(sum(label)*(count(*)-sum(label)),0) auc
      from (select *, rank() over (partition by batch_id order by score)
          +(count(*) over (partition by batch_id, score)-1)/2.0 ar
        from (select f.*, (dense_rank() over (order by impression_id)-1)//32 batch_id from {v} f))
      group by batch_id) where auc is not null""" for m, v in _MODEL_VIEWS.items()
)


@query("best_model", f"select model, auc from ({_BEST}) order by auc desc, model desc limit 1")
def best_model(log):
    """The model of the greatest batch-flattened area, batches of 32 impressions."""
    columns = ["model", "impression_id", "pos", "label", "valid", "score"]
    scored = stage(all_models(log, "validation").select(*columns), "scored")
    areas = metrics.mean_batch_auc(scored, 32, ["model"])
    return metrics.best_model(areas).select("model", r6("auc", "auc"))
