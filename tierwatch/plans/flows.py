"""End-to-end flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tierwatch.constants import FEATURE_COLUMNS, N_TREES, TARGET_COLUMN, TREE_DEPTH
from tierwatch.operators import classifier, enrichment, evaluation, triage
from tierwatch.operators.enrichment import Completer
from tierwatch.operators.registry import ModelRegistry
from tierwatch.session import scratch_path
from tierwatch.sources.schemas import REJECT_REASON
from tierwatch.sources.sinks import write_table


class Retrained(NamedTuple):
    metrics: Mapping[str, float]
    predictions: DataFrame
    distribution: DataFrame


def retrain(features: DataFrame, registry: ModelRegistry, name: str, version: str, key: str = "email_id",
            columns: Sequence[str] = FEATURE_COLUMNS, target: str = TARGET_COLUMN,
            n_trees: int = N_TREES, depth: int = TREE_DEPTH, comment: str = "",
            predictions_path: str | None = None) -> Retrained:
    """Split, train, evaluate on the held-out side, register, score every row, decide.

    ``features`` should be a stored table: training reads it many times. The predictions
    are stored once, in the shared folder if no path is given, and keep the side of the
    split, so that quality can also be reported for rows the model has not seen.
    """
    sided = classifier.hash_split(features, key)
    model = classifier.train(sided.filter("split = 'train'"), columns, target, n_trees, depth)

    path = predictions_path or scratch_path(features.sparkSession, "predictions")
    write_table(triage.decide(classifier.score(model, sided)), path)
    scored = features.sparkSession.read.parquet(path)
    held_out = scored.filter("split = 'test'")
    row = classifier.evaluate(held_out, target).first().asDict()
    sizes = {r["split"]: r["count"] for r in scored.groupBy("split").count().collect()}
    metrics = {
        "accuracy": row["accuracy"], "precision": row["precision"], "recall": row["recall"],
        "f1_score": row["f1"], "training_samples": float(sizes.get("train", 0)),
        "test_samples": float(sizes.get("test", 0)),
    }
    sample = sided.filter("split = 'train'").orderBy(key).select(*columns).limit(100)
    registry.log(model, name, version, columns, metrics, sample, comment)
    return Retrained(metrics, scored, evaluation.group_distribution(scored, "ml_decision", target))


class Reviewed(NamedTuple):
    tiered: DataFrame
    rejected: DataFrame


def review(predictions: DataFrame, messages: DataFrame, completer: Completer, store: str,
           key: str = "email_id", tasks: int | None = None) -> Reviewed:
    """Send the uncertain bucket to a completer and build the tiered view.

    Answers are stored before use. What has a usable answer leaves before the join with
    the texts; what has none, or one that cannot be parsed, is asked again by the next run.
    """
    pending = enrichment.unanswered(predictions, key, store)
    prompts = enrichment.uncertain(pending, messages, key).withColumn("prompt", enrichment.review_prompt())
    enrichment.ask(prompts, key, "prompt", completer, store, tasks)
    answers = enrichment.latest_answers(predictions.sparkSession, store, key)
    parsed = enrichment.parse_analysis(answers)
    rejected = parsed.rejected.select(key, "answer", F.lit("no usable answer").alias(REJECT_REASON)).unionByName(
        prompts.filter(F.col("prompt").isNull()).select(
            key, F.lit(None).cast("string").alias("answer"), F.lit("a part of the prompt is missing").alias(REJECT_REASON)))
    return Reviewed(triage.tiered_view(predictions, messages, parsed.accepted, key), rejected)
