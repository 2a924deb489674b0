"""Ranking metrics and losses over scored candidates (impression, pos, score, label).

Definitions: reciprocal rank of the best clicked candidate, 0 without a click;
NDCG@k with DCG / (IDCG + 1e-4); tie-aware ROC area from rank sums, null when only
one class is present; logistic and list-wise losses with 1e-4 and empty-list rules.
A null or NaN score ranks last; it has no loss, and does not count in the mean loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.operators.ordering import dense_index, running_total
from clickloom.operators.ranking import score_order

# Fixed values of the definitions.
EPS = 1e-4
LOSS_WEIGHTS = {"bce_loss": 1.0, "listnet_loss": 0.5}


def binary_label(scored: DataFrame) -> DataFrame:
    """Keep rows with a real label (>= 0) and make it 0 or 1."""
    return scored.where(F.col("label") >= 0).withColumn("label", (F.col("label") > 0).cast("int"))


def valid_only(scored: DataFrame) -> DataFrame:
    """Leave out padded candidates."""
    return scored.where("valid") if "valid" in scored.columns else scored


def real_score(score: Column) -> Column:
    """The score, null where it is not a number."""
    return F.when(~F.isnan(score), score)


def bce_term(score: Column, label: Column) -> Column:
    """Logistic loss of a raw score, in the form that does not overflow."""
    return F.greatest(score, F.lit(0.0)) - score * label + F.log1p(F.exp(-F.abs(score)))


def _ideal_dcg(n_pos: Column, k: int) -> Column:
    """Σ 1/log2(r+1) over the first min(n_pos, k) ranks, read from a table of k sums."""
    sums, total = [F.lit(0.0)], F.lit(0.0)
    for r in range(1, k + 1):
        total = total + F.lit(1.0) / F.log2(F.lit(r + 1.0))
        sums.append(total)
    return F.get(F.array(*sums), F.least(n_pos, F.lit(k)).cast("int"))


def _auc(pos_rank_sum: Column, n_pos: Column, n: Column) -> Column:
    """ROC area from the summed average ranks (1 = lowest score) of the positives."""
    n_neg = n - n_pos
    area = (pos_rank_sum - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg)
    return F.when((n_pos > 0) & (n_neg > 0), area)


def _with_average_rank(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Average rank from the bottom, ties sharing one value; all from one sort."""
    by_score = W.partitionBy(*keys).orderBy(score_order())
    tied = by_score.rangeBetween(W.currentRow, W.currentRow)
    up_to = by_score.rangeBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*keys)
    n = F.count(F.lit(1))
    lower = n.over(whole) - n.over(up_to)
    return scored.withColumn("_avg_rank", lower + (n.over(tied) + 1) / 2.0)


def impression_metrics(
    scored: DataFrame, keys: Sequence[str] = ("impression_id",), ks: Sequence[int] = (5, 10)
) -> DataFrame:
    """One row per impression: counts, rr, ndcg@k, auc, loss sums. One exchange."""
    data = binary_label(valid_only(scored)).withColumn("score", real_score(F.col("score")))
    order = W.partitionBy(*keys).orderBy(score_order(), F.asc("pos"))
    ranked = _with_average_rank(
        data.withColumn("_rank", F.row_number().over(order)), keys
    ).withColumn("_top", F.max("score").over(W.partitionBy(*keys)))
    hit = F.col("label") == 1
    gain = F.lit(1.0) / F.log2(F.col("_rank") + F.lit(1.0))
    shifted = F.col("score") - F.col("_top")
    grouped = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("label").alias("n_pos"),
        F.min(F.when(hit, F.col("_rank"))).alias("_best"),
        *[F.sum(F.when(hit & (F.col("_rank") <= k), gain).otherwise(F.lit(0.0))).alias(f"_dcg{k}") for k in ks],
        F.sum(F.when(hit, F.col("_avg_rank")).otherwise(F.lit(0.0))).alias("_rank_sum"),
        F.count("score").alias("n_scored"),
        F.coalesce(F.sum(bce_term(F.col("score"), F.col("label"))), F.lit(0.0)).alias("bce_sum"),
        F.coalesce(F.log(F.sum(F.exp(shifted))), F.lit(0.0)).alias("_lse"),
        F.count(F.when(hit, F.col("score"))).alias("_hits"),
        F.sum(F.when(hit & shifted.isNotNull(), shifted).otherwise(F.lit(0.0))).alias("_pos_shifted"),
    )
    n_pos = F.col("n_pos")
    return grouped.select(
        *keys,
        "n",
        "n_pos",
        F.coalesce(F.lit(1.0) / F.col("_best"), F.lit(0.0)).alias("rr"),
        *[(F.col(f"_dcg{k}") / (_ideal_dcg(n_pos, k) + F.lit(EPS))).alias(f"ndcg{k}") for k in ks],
        _auc(F.col("_rank_sum"), n_pos, F.col("n")).alias("auc"),
        "n_scored",
        "bce_sum",
        F.when(F.col("_hits") > 0, F.col("_lse") - F.col("_pos_shifted") / F.col("_hits"))
        .otherwise(F.lit(0.0))
        .alias("listnet"),
    )


def evaluate(
    scored: DataFrame, by: Sequence[str] = (), suffix: str = "", loss_weights: dict | None = None
) -> DataFrame:
    """One row (per value of `by`): auc, mrr, ndcg_5, ndcg_10 and losses.

    auc is the mean over impressions with both classes; auc_weighted weighs them by
    their number of candidates.
    """
    weights = LOSS_WEIGHTS if loss_weights is None else loss_weights
    per = impression_metrics(scored, [*by, "impression_id"])
    weight = F.when(F.col("auc").isNotNull(), F.col("n"))
    out = per.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_impressions"),
        F.avg("auc").alias("auc"),
        (F.sum(F.col("auc") * F.col("n")) / F.sum(weight)).alias("auc_weighted"),
        F.avg("rr").alias("mrr"),
        F.avg("ndcg5").alias("ndcg_5"),
        F.avg("ndcg10").alias("ndcg_10"),
        (F.sum("bce_sum") / (F.sum("n_scored") + F.lit(EPS))).alias("bce_loss"),
        F.avg("listnet").alias("listnet_loss"),
    )
    loss = F.lit(0.0)
    for name, w in weights.items():
        loss = loss + F.lit(float(w)) * F.col(name)
    out = out.withColumn("loss", loss)
    return out.select(
        *by, *[F.col(c).alias(c + suffix) for c in out.columns if c not in by]
    ) if suffix else out


def evaluate_batched(scored: DataFrame, batch_size: int, by: Sequence[str] = ()) -> DataFrame:
    """`evaluate` with the area of flattened batches, weighted by candidates, as `auc`."""
    report = evaluate(scored, by).drop("auc")
    auc = mean_batch_auc(scored, batch_size, by)
    if by:
        return report.join(auc, [*by], "left")
    one = F.lit(1).alias("_one")
    return report.select("*", one).join(auc.select("*", one), "_one").drop("_one")


def mean_batch_auc(scored: DataFrame, batch_size: int, by: Sequence[str] = ()) -> DataFrame:
    """Per value of `by`: the mean area of flattened batches, weighted by candidates."""
    areas = batch_auc(assign_batches(scored, batch_size), by).where(F.col("auc").isNotNull())
    return areas.groupBy(*by).agg((F.sum(F.col("auc") * F.col("n")) / F.sum("n")).alias("auc"))


def assign_batches(scored: DataFrame, batch_size: int) -> DataFrame:
    """Number impressions by id and cut them into batches of `batch_size`."""
    index = dense_index(scored, "impression_id", 0, "_seq")
    batches = index.select(
        "impression_id", F.floor(F.col("_seq") / F.lit(batch_size)).cast("bigint").alias("batch_id")
    )
    return scored.join(batches, "impression_id")


def batch_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC area of each flattened batch (per value of `by`), null for one-class batches."""
    keys = [*by, "batch_id"]
    data = _with_average_rank(binary_label(valid_only(scored)), keys)
    return (
        data.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("label").alias("n_pos"),
            F.sum(F.when(F.col("label") == 1, F.col("_avg_rank")).otherwise(F.lit(0.0))).alias("_s"),
        )
        .select(*keys, "n", "n_pos", _auc(F.col("_s"), F.col("n_pos"), F.col("n")).alias("auc"))
    )


def auc_batched(scored: DataFrame) -> DataFrame:
    """Mean of the batch areas weighted by candidates; one-class batches skipped."""
    used = batch_auc(scored).where(F.col("auc").isNotNull())
    return used.agg(
        F.count(F.lit(1)).alias("n_batches"),
        (F.sum(F.col("auc") * F.col("n")) / F.sum("n")).alias("auc"),
    )


def auc_global(scored: DataFrame) -> DataFrame:
    """Exact ROC area over all candidates.

    Rows are first folded into one row per distinct score on the map side, so a score
    shared by a third of all rows costs one row; a null or NaN score is the lowest.
    Negatives below a score come from a
    range-partitioned running sum, never from one global window.
    """
    lowest = F.coalesce(real_score(F.col("score").cast("double")), F.lit(float("-inf")))
    data = binary_label(valid_only(scored)).withColumn("score", lowest)
    folded = data.groupBy("score").agg(
        F.sum("label").alias("pos_n"), F.sum(F.lit(1) - F.col("label")).alias("neg_n")
    )
    below = running_total(folded, ["score"], "neg_n", "neg_below", inclusive=False)
    wins = F.sum(F.col("pos_n") * (F.col("neg_below") + F.col("neg_n") / 2.0))
    return below.agg(
        F.sum("pos_n").alias("n_pos"), F.sum("neg_n").alias("n_neg"), wins.alias("_wins")
    ).select(
        "n_pos", "n_neg",
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
               F.col("_wins") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"),
    )


def best_model(report: DataFrame, metric: str = "auc") -> DataFrame:
    """The model with the highest metric; equal values go to the later name."""
    best = F.max_by(F.struct("model", metric), F.struct(metric, "model")).alias("_best")
    return report.agg(best).select("_best.*")
