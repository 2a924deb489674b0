"""Learned ranker: logistic regression on candidate features (Spark ML)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.scoring import NUMERIC_FEATURES
from clickloom.session import cut_lineage


def fit_ranker(
    features: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    max_iter: int = 500,
    reg: float = 1e-3,
    tol: float = 1e-7,
) -> PipelineModel:
    """Fit on sampled candidates (label 0/1); its loss is the logistic one of the metrics.

    The features are checkpointed first: fitting passes over them many times, and must
    not rebuild their joins on each pass, nor after an executor is lost. The fit ends by
    `tol`; `max_iter` is a bound that is not meant to be reached (see `convergence`).
    """
    columns = [F.col(c).cast("double").alias(c) for c in (*numeric, "label")]
    rows = cut_lineage(features.select(*columns, "cat_encoded"))
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(numeric), outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True),
            OneHotEncoder(inputCols=["cat_encoded"], outputCols=["_cat"], handleInvalid="keep"),
            VectorAssembler(inputCols=["_scaled", "_cat"], outputCol="features"),
            LogisticRegression(
                maxIter=max_iter, regParam=reg, tol=tol, labelCol="label", featuresCol="features"
            ),
        ]
    )
    return pipeline.fit(rows)


def convergence(model: PipelineModel) -> dict:
    """Iterations of a fit made in this session, and whether it ended before its bound."""
    fitted = model.stages[-1]
    iterations = fitted.summary.totalIterations
    return {"iterations": iterations, "converged": iterations < fitted.getMaxIter()}


def score_ranker(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add `score`: the margin of class 1 before the logistic function."""
    scored = model.transform(features)
    margin = vector_to_array("rawPrediction")[1]
    return scored.select(*features.columns, margin.alias("score"))
