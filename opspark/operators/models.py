"""Model fits and batch scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from opspark.functions.columns import as_number


def _ready(df: DataFrame, cols: Sequence[str], label: str | None) -> DataFrame:
    keep = [as_number(df, c).alias(c) for c in cols]
    if label:
        keep.append(as_number(df, label).alias(label))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in cols and c != label]
    return df.select(*keep, *extra)


def _fit(df, cols, label, estimator):
    stages = [VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="skip"), estimator]
    return Pipeline(stages=stages).fit(_ready(df, cols, label))


def fit_forest(df, cols, label="target", regression=False, trees=100, max_depth=10, min_leaf=2,
               subset="sqrt", seed=42) -> PipelineModel:
    """Random forest for classes or numbers."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor

    kind = RandomForestRegressor if regression else RandomForestClassifier
    return _fit(df, cols, label, kind(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=max_depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy=subset, seed=seed))


def fit_boosted(df, cols, label="target", regression=False, rounds=100, max_depth=6, step=0.1,
                subsample=0.8, seed=42) -> PipelineModel:
    """Gradient-boosted trees; classes must be 0 and 1."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor

    kind = GBTRegressor if regression else GBTClassifier
    return _fit(df, cols, label, kind(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=max_depth, stepSize=step,
        subsamplingRate=subsample, seed=seed))


def fit_logistic(df, cols, label="target", max_iter=200) -> PipelineModel:
    """Logistic regression."""
    from pyspark.ml.classification import LogisticRegression

    return _fit(df, cols, label, LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter))


def index_labels(df: DataFrame, col: str, out: str = "target") -> DataFrame:
    """String labels as numbers in alphabetical order."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="skip").fit(df)
    return model.transform(df)


def fit_grid(df, cols, label="target", regression=False, depths=(5, 10), trees=(50, 100), folds=5,
             fold_col=None, seed=42, parallelism=4):
    """Grid search over forest sizes by cross-validation; best by accuracy, or by mean squared error."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    kind = RandomForestRegressor if regression else RandomForestClassifier
    est = kind(labelCol=label, featuresCol="features", seed=seed)
    judge = (RegressionEvaluator(labelCol=label, metricName="mse") if regression
             else MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"))
    grid = ParamGridBuilder().addGrid(est.maxDepth, list(depths)).addGrid(est.numTrees, list(trees)).build()
    flow = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="skip"), est])
    options = {"foldCol": fold_col} if fold_col else {}
    search = CrossValidator(estimator=flow, estimatorParamMaps=grid, evaluator=judge, numFolds=folds,
                            parallelism=parallelism, seed=seed, **options)
    return search.fit(_ready(df, cols, label))


def grid_scores(model) -> list[tuple[str, float, float]]:
    """(settings, mean score, deviation) per grid point."""
    out = []
    for params, mean, std in zip(model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics):
        name = ",".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda x: x[0].name))
        out.append((name, float(mean), float(std)))
    return out


def score_table(model: PipelineModel, df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Predictions, with the class probabilities where the model gives them."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(_ready(df, cols, None))
    fields = [F.col(c) for c in keep] + [F.col("prediction")]
    if "probability" in out.columns:
        fields.append(vector_to_array("probability").alias("probabilities"))
    return out.select(*fields)


def agreement(left: DataFrame, right: DataFrame, key: str, tolerance: float = 1e-5) -> DataFrame:
    """Largest gap between two prediction tables and whether it is within the tolerance."""
    b = right.select(F.col(key).alias("_k"), F.col("prediction").alias("_p"))
    gap = F.abs(F.col("prediction") - F.col("_p"))
    both = left.join(b, F.col(key) == F.col("_k"), "full")
    return both.agg(
        F.count("*").alias("rows"), F.max(gap).alias("largest_gap"),
        (F.count_if(gap.isNull()) == 0).alias("complete"),
    ).withColumn("agrees", F.col("complete") & (F.col("largest_gap") <= tolerance))
