"""Random-forest training, scoring, evaluation and versions."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import CATEGORIES, CONDITIONS, FEATURES, FOREST_DEPTH, FOREST_TREES, LABEL
from ..functions.times import version_stamp
from ..session import materialize

VECTOR = "predictors"
DEFAULT_BINS = 32
ROWS_PER_TASK = 10_000
MOST_TASKS = 256


def feature_stages(on_invalid: str = "error") -> list:
    """Category codes and the feature vector. ``on_invalid``: error, keep or skip."""
    indexer = StringIndexer(
        inputCols=CATEGORIES,
        outputCols=[f"{c}_indexed" for c in CATEGORIES],
        handleInvalid=on_invalid,
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol=VECTOR, handleInvalid=on_invalid)
    return [indexer, assembler]


def bins_needed(df: DataFrame) -> int:
    """Split bins: at least the number of values of the largest category."""
    sizes = df.agg(*[F.count_distinct(c).alias(c) for c in CATEGORIES]).first()
    return max(DEFAULT_BINS, max(sizes) + 1)


def train(
    df: DataFrame,
    label: str = LABEL,
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    seed: int = 42,
    on_invalid: str = "error",
    bootstrap: bool = True,
) -> PipelineModel:
    """Fit codes, vector and forest as one pipeline model.

    Without ``bootstrap`` every tree sees every row once.
    """
    forest = RandomForestRegressor(
        labelCol=label,
        featuresCol=VECTOR,
        predictionCol="prediction",
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins_needed(df),
        featureSubsetStrategy="all",
        seed=seed,
        bootstrap=bootstrap,
        maxMemoryInMB=1024,
        cacheNodeIds=True,
    )
    return Pipeline(stages=[*feature_stages(on_invalid), forest]).fit(_spread(df))


def _spread(df: DataFrame) -> DataFrame:
    """Partitions by a hash of the row, as many as the rows need, each sorted.

    Forests are sampled per partition, so partitions follow from the rows alone: the same
    rows and seed give the same model on any cluster. None is tiny, as every tree level is a pass.
    """
    parts = max(1, min(MOST_TASKS, df.count() // ROWS_PER_TASK))
    return df.repartition(parts, *df.columns).sortWithinPartitions(*df.columns)


def rmse(label: str = LABEL, prediction: str = "prediction") -> Column:
    """Root mean squared error as an aggregate."""
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))


def prediction_range(prediction: str = "prediction") -> list[Column]:
    """Smallest and largest prediction as aggregates of one pass."""
    return [F.min(prediction).alias("min_pred"), F.max(prediction).alias("max_pred")]


def evaluate(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: min_pred, max_pred, rmse."""
    return predictions.agg(*prediction_range(), rmse(label).alias("rmse"))


def row_fold(columns: list[str], folds: int) -> Column:
    """Number of the fold of a row: it follows from the values alone."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % folds


def holdout(df: DataFrame, folds: int = 5, label: str = LABEL, by: list[str] = CONDITIONS, **settings) -> DataFrame:
    """One row per fold: fold, n, min_pred, max_pred, rmse of a model that has not seen the fold.

    Each fold's model is fitted on all others; all predictions go into one aggregate. A row
    of a category that only its own fold has is scored with ``keep_invalid``.
    """
    table = materialize(df.withColumn("fold", row_fold(by, folds)))
    found = None
    for fold in range(folds):
        fitted = train(table.filter(F.col("fold") != fold).drop("fold"), label, **settings)
        scored = keep_invalid(fitted).transform(table.filter(F.col("fold") == fold))
        scored = scored.select("fold", label, "prediction")
        found = scored if found is None else found.unionByName(scored)
    return found.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *prediction_range(), rmse(label).alias("rmse"))


def holdout_report(rows: DataFrame, version: str) -> DataFrame:
    """Hold-out errors as rows of a model report, after those of :func:`report`."""
    return rows.select(
        F.lit(version).alias("version"), (F.lit(100) + F.col("fold")).cast("int").alias("position"),
        F.concat(F.lit("holdout rmse "), F.col("fold")).alias("metric"), F.col("rmse").alias("value"),
    )


def importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """One row per feature in feature order: position, feature, importance."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(i, name, float(v)) for i, (name, v) in enumerate(zip(FEATURES, values))]
    return spark.createDataFrame(rows, "position int, feature string, importance double")


def known_categories(model: PipelineModel) -> Column:
    """Whether every category value of a row was seen in training."""
    known = F.lit(True)
    for column, labels in zip(CATEGORIES, model.stages[0].labelsArray):
        known = known & F.coalesce(F.col(column).isin(list(labels)), F.lit(False))
    return known


def keep_invalid(model: PipelineModel) -> PipelineModel:
    """The model with unseen categories as one further code and missing numbers as not a number.

    At every split on such a value a row takes the branch of the categories or numbers that
    are not listed there.
    """
    kept = [stage.copy().setHandleInvalid("keep") for stage in model.stages[:2]]
    return PipelineModel([*kept, *model.stages[2:]])


def report(model: PipelineModel, predictions: DataFrame, version: str) -> DataFrame:
    """Model report as (version, metric, value) rows: range, error and importances."""
    spark = predictions.sparkSession
    row = evaluate(predictions)
    metrics = row.select(F.posexplode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in row.columns
    ])).alias("position", "m")).select("position", "m.*")
    weights = importances(model, spark).select(
        (F.col("position") + 3).alias("position"),
        F.concat(F.lit("importance "), F.col("feature")).alias("metric"),
        F.col("importance").alias("value"),
    )
    return metrics.unionByName(weights).select(
        F.lit(version).alias("version"), "position", "metric", "value"
    )


def append_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def save_model(model: PipelineModel, folder: str, version: str | None = None) -> str:
    """Save under a version name; returns the version."""
    version = version or version_stamp()
    model.write().overwrite().save(f"{folder}/{version}/model")
    return version


def load_model(folder: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{version}/model")
