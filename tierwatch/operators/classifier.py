"""Split, train and score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tierwatch.constants import (
    EVALUATION_THRESHOLD, FEATURE_COLUMNS, LEARNING_RATE, N_TREES, SPLIT_SEED, TARGET_COLUMN,
    TRAIN_SHARE, TREE_DEPTH,
)
from tierwatch.operators.evaluation import confusion, with_quality
from tierwatch.session import working_dir

_SPLIT_CELLS = 10_000
#: Training rows of a task, about. Every level of every tree is a job over all tasks, so tasks of few rows cost more than their rows.
ROWS_PER_TASK = 500_000
_RAW, _PROBABILITY, _VECTOR = "_raw_prediction", "_probability", "_features"


def hash_split(df: DataFrame, key: str, train_share: float = TRAIN_SHARE,
               seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``split`` (train or test), decided by a digest of seed and key.

    The side of a row depends on nothing but its key, so it is the same in every run,
    on every partitioning and after a lost executor.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    cell = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % _SPLIT_CELLS
    return df.withColumn("split", F.when(cell < round(train_share * _SPLIT_CELLS), "train").otherwise("test"))


def few_tasks(rows: DataFrame) -> DataFrame:
    """The same rows in as many tasks as there are cores, or as their number asks for; not one for every file."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))
    return rows.coalesce(tasks)


def train(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = TARGET_COLUMN,
          n_trees: int = N_TREES, depth: int = TREE_DEPTH, rate: float = LEARNING_RATE,
          seed: int = SPLIT_SEED) -> PipelineModel:
    """Gradient-boosted trees on the feature columns.

    Only the inputs and the label are read. Tree building keeps its own cached copy of
    them and cuts lineage in the checkpoint folder every ten trees.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(working_dir(spark))
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in features],
                     F.col(label).cast("double").alias(label))
    trees = GBTClassifier(
        featuresCol=_VECTOR, labelCol=label, predictionCol="prediction",
        maxIter=n_trees, maxDepth=depth, stepSize=rate, seed=seed,
    ).setRawPredictionCol(_RAW).setProbabilityCol(_PROBABILITY)
    assembler = VectorAssembler(inputCols=list(features), outputCol=_VECTOR, handleInvalid="keep")
    return Pipeline(stages=[assembler, trees]).fit(few_tasks(rows))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All columns plus ``predicted_violation`` and the two class probabilities."""
    scored = model.transform(df)
    chances = vector_to_array(_PROBABILITY)
    return (scored.withColumns({
        "predict_proba_0": chances[0],
        "predict_proba_1": chances[1],
        "predicted_violation": F.col("prediction").cast("int"),
    }).drop(_RAW, _PROBABILITY, _VECTOR, "prediction"))


def evaluate(scored: DataFrame, label: str = TARGET_COLUMN,
             threshold: float = EVALUATION_THRESHOLD) -> DataFrame:
    """Confusion counts and quality of scored rows; one row, not collected."""
    return with_quality(confusion(scored, "predict_proba_1", label, threshold))


def area_under_roc(scored: DataFrame, label: str = TARGET_COLUMN) -> float:
    rows = scored.select(F.col("predict_proba_1").alias("rawPrediction"), F.col(label).cast("double").alias("label"))
    return BinaryClassificationEvaluator().evaluate(rows)
