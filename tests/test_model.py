import pytest
from pyspark.sql import functions as F

from tierwatch.constants import FEATURE_COLUMNS
from tierwatch.operators import classifier
from tierwatch.operators.registry import FeatureRegistry, FeatureView, ModelRegistry
from tierwatch.plans import flows


@pytest.fixture(scope="module")
def rows(spark):
    """A rule with noise over the six inputs."""
    x = [F.rand(seed=i).alias(c) for i, c in enumerate(FEATURE_COLUMNS[:-1])]
    df = spark.range(400).select(F.col("id").alias("email_id"), *x, (F.col("id") % 2).cast("int").alias("cross_barrier_flag"))
    risky = F.col("mnpi_risk_score") - F.col("baseline_similarity") + 0.2 * F.col("cross_barrier_flag") > 0.2
    df = df.withColumn("is_violation", risky.cast("int")).cache()
    df.count()
    return df


def test_split_is_stable(spark, rows):
    a = classifier.hash_split(rows, "email_id").select("email_id", "split")
    b = classifier.hash_split(rows.repartition(7), "email_id").select("email_id", "split")
    assert a.exceptAll(b).count() == 0
    share = a.filter("split = 'train'").count() / 400
    assert 0.7 < share < 0.9
    other = classifier.hash_split(rows, "email_id", seed=7).select("email_id", "split")
    assert a.exceptAll(other).count() > 0


def test_retrain_flow_and_registry(spark, rows, folder):
    features = FeatureRegistry(folder)
    view = FeatureView("semantic", "message", ["email_id"], "ts", description="scores",
                       column_descriptions={"mnpi_risk_score": "similarity to tips"})
    stored = rows.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    with pytest.raises(ValueError):
        features.register(view, rows, "V1")
    features.register(view, stored, "V1")
    features.register(view, stored, "V1")  # overwrite
    features.register(view, stored.limit(10), "V2")
    with pytest.raises(Exception):
        features.register(view, stored, "V2", overwrite=False)
    assert features.load(spark, "semantic", "V1").count() == 400 and features.load(spark, "semantic", "V2").count() == 10
    assert [(r["name"], r["version"], r["refresh_freq"]) for r in features.list(spark).collect()] == [
        ("semantic", "V1", "1 day"), ("semantic", "V2", "1 day")]
    described = {(r["version"], r["column"]): r["description"] for r in features.columns(spark).collect()}
    assert described["V1", "mnpi_risk_score"] == "similarity to tips" and described["V1", "ts"] == ""

    models = ModelRegistry(folder)
    assert models.list(spark).count() == 0 and models.delete(spark, "clf") is False
    result = flows.retrain(features.load(spark, "semantic", "V1"), models, "clf", "V1", n_trees=10, depth=3, comment="first")
    scored = result.predictions
    assert scored.count() == 400 and scored.filter("predict_proba_1 < 0 or predict_proba_1 > 1").count() == 0
    assert scored.filter(F.abs(F.col("predict_proba_0") + F.col("predict_proba_1") - 1) > 1e-9).count() == 0
    assert scored.filter((F.col("predicted_violation") == 1) != (F.col("predict_proba_1") > 0.5)).count() == 0
    assert result.metrics["training_samples"] + result.metrics["test_samples"] == 400
    assert result.metrics["accuracy"] > 0.8 and classifier.area_under_roc(scored.filter("split = 'test'")) > 0.9
    assert sum(r["n"] for r in result.distribution.collect()) == 400

    again = classifier.score(models.load("clf", "V1"), stored)
    differing = again.join(scored.select("email_id", F.col("predict_proba_1").alias("p")), "email_id").filter("abs(p - predict_proba_1) > 1e-12")
    assert differing.count() == 0
    listed = models.list(spark).first()
    assert (listed["name"], listed["version"], listed["comment"], listed["features"]) == ("clf", "V1", "first", ",".join(FEATURE_COLUMNS))
    assert {r["metric"]: r["value"] for r in models.metrics(spark).collect()} == pytest.approx(result.metrics)
    assert models.delete(spark, "clf") is True and models.list(spark).count() == 0


def test_missing_features_are_kept_in_scoring(spark, rows):
    model = classifier.train(rows, n_trees=2, depth=2)
    holes = rows.limit(3).withColumn("mnpi_risk_score", F.lit(None).cast("double"))
    assert classifier.score(model, holes).filter("predict_proba_1 is not null").count() == 3


def test_from_csv_to_measured_quality(spark, folder):
    """The whole flow as a user would run it."""
    from datetime import datetime, timedelta

    from tierwatch.operators import evaluation, features as feature_ops
    from tierwatch.sources import files, schemas, sinks

    bodies = {"INSIDER_TRADING": "merger tip before announcement", "CLEAN": "meeting schedule and report", "PERSONAL_TRADING": "bought shares"}
    labels = sorted(bodies)

    def message(i):
        # Every fourth text says nothing about its label.
        label = labels[i % 4] if i % 4 < 3 else labels[(i // 4) % 2]
        body = bodies[label] if i % 4 < 3 else "lunch today"
        return (f"m{i:03d}", "a", "b", None, "note", f"{body}\nsecond line", datetime(2024, 1, 1) + timedelta(hours=i),
                "Legal", "Trading", label)

    rows = [message(i) for i in range(160)]
    sinks.export_csv(spark.createDataFrame(rows, schemas.MESSAGES), folder + "/csv", ["sent_at", "email_id"])
    messages, rejected = files.read_messages(spark, folder + "/csv")
    assert rejected.count() == 0

    store = FeatureRegistry(folder)
    table = feature_ops.feature_view_columns(feature_ops.message_features(messages))
    store.register(FeatureView("semantic", "message", ["email_id"], "ts"), table, "V1")
    result = flows.retrain(store.load(spark, "semantic", "V1"), ModelRegistry(folder), "clf", "V1", n_trees=3, depth=2)
    assert result.metrics["accuracy"] > 0.7

    answer = '{"is_violation": true, "confidence": 0.9, "category": "PERSONAL_TRADING", "reasoning": "r"}'
    reviewed = flows.review(result.predictions, messages, lambda prompts: [answer] * len(prompts), folder + "/answers")
    measured = evaluation.hybrid_measured(reviewed.tiered).first()
    assert measured["total"] == 160 and measured["recall"] == 1.0
    asked = reviewed.tiered.filter("pipeline_action = 'LLM_ANALYSIS'")
    assert asked.count() > 0 and asked.filter("analysis is null").count() == 0


def recount(rows, at_least):
    tp = sum(r.is_violation == 1 for r in rows if at_least(r))
    fp, fn = sum(map(at_least, rows)) - tp, sum(r.is_violation == 1 for r in rows) - tp
    precision, recall = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0
    return {"tp": tp, "fp": fp, "fn": fn, "tn": len(rows) - tp - fp - fn, "precision": precision, "recall": recall,
            "f1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0,
            "accuracy": (len(rows) - fp - fn) / len(rows)}


def test_model_queries_against_a_recount_of_the_predictions(spark):
    from conftest import SF
    from tierwatch.plans import suite_data

    distribution = suite_data.train_score(spark, SF).collect()
    trained = suite_data._retrained(spark, SF)
    assert trained is suite_data._retrained(spark, SF)  # one training for all
    predictions = trained[1].predictions.collect()
    for r in distribution:
        mine = [p for p in predictions if p.ml_decision == r.ml_decision]
        bad = sum(p.is_violation for p in mine)
        assert (r.n, r.violations, r.pct) == (len(mine), bad, pytest.approx(100 * len(mine) / len(predictions), abs=0.06))
    assert sum(r.n for r in distribution) == len(predictions)
    # A model that says the same of all rows has one decision only, and knows nothing of what it was shown.
    assert len(distribution) > 1 and len({p.predict_proba_1 for p in predictions}) > 1
    seen = [p for p in predictions if p.split == "train"]
    shown = recount(seen, lambda p: p.predict_proba_1 >= 0.5)
    assert shown["f1"] > 0.7

    test = [p for p in predictions if p.split == "test"]
    wanted = recount(test, lambda p: p.predict_proba_1 >= 0.5)
    found = suite_data.held_out_quality(spark, SF).first().asDict()
    assert {k: found[k] for k in wanted} == pytest.approx(wanted) and found["total"] == len(test)
    metrics = {r.metric: r.value for r in suite_data.model_metrics(spark, SF).collect()}
    assert metrics == pytest.approx({"accuracy": wanted["accuracy"], "precision": wanted["precision"], "recall": wanted["recall"],
                                     "f1_score": wanted["f1"], "training_samples": len(seen), "test_samples": len(test)})


def test_thresholds_against_plain_counts(spark):
    import random

    from tierwatch.operators import thresholds

    choose = random.Random(3)
    rows = [(choose.choice([0.1, 0.2, 0.5, 0.8, 1.0, choose.random()]), choose.random() < 0.3) for _ in range(300)] + [(0.5, True)] * 200
    df = spark.createDataFrame([(s, int(t)) for s, t in rows] + [(None, 1), (float("nan"), 1), (0.3, None)], "score double, is_violation int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # several ranges, however few rows
    try:
        curve = thresholds.threshold_curve(df.repartition(3), "score")
        got = {r.threshold: r for r in curve.collect()}
        summary = thresholds.curve_summary(curve).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert set(got) == {s for s, _ in rows}
    for at, r in got.items():
        tp, fp = sum(s >= at and t for s, t in rows), sum(s >= at and not t for s, t in rows)
        bad = sum(t for _, t in rows)
        assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, bad - tp, len(rows) - bad - fp)
        assert (r.precision, r.recall) == pytest.approx((tp / (tp + fp), tp / bad))
    good, poor = [s for s, t in rows if t], [s for s, t in rows if not t]
    wins = sum((a > b) + (a == b) / 2 for a in good for b in poor)
    assert summary.area_under_roc == pytest.approx(wins / len(good) / len(poor))
    best = max(got.values(), key=lambda r: (round(r.f1, 12), r.threshold))
    assert (summary.best_threshold, summary.best_f1) == (best.threshold, pytest.approx(best.f1))
    steps, before, area = sorted(got.values(), key=lambda r: -r.threshold), 0.0, 0.0
    for r in steps:
        area, before = area + (r.recall - before) * r.precision, r.recall
    assert summary.average_precision == pytest.approx(area)
    bins = {r.bin: r for r in thresholds.calibration(df, "score").collect()}
    assert sum(r.n for r in bins.values()) == len(rows) and bins[9].n == sum(s >= 0.9 for s, _ in rows)
    empty = thresholds.threshold_curve(df.limit(0), "score")
    assert empty.count() == 0 and thresholds.curve_summary(empty).first().total is None


def test_training_does_not_run_a_task_for_every_small_file(spark, monkeypatch):
    rows = spark.range(1000).repartition(100)
    few = classifier.few_tasks(rows)
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism < 100
    assert sorted(r["id"] for r in few.collect()) == list(range(1000))
    monkeypatch.setattr(classifier, "ROWS_PER_TASK", 30)
    assert classifier.few_tasks(rows).rdd.getNumPartitions() == 34
    assert classifier.few_tasks(rows.filter("id < 0")).count() == 0
