import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierwatch.constants import CONCEPTS, SUSPICIOUS_PHRASES
from tierwatch.operators import enrichment, evaluation, features, keywords, profiling, triage
from tierwatch.operators.asof import as_of_lookup
from tierwatch.plans import flows
from tierwatch.sources import schemas

NOW = datetime(2024, 1, 2)
MESSAGES = [
    ("1", "s", "r", None, "Report", "quarterly report meeting", NOW, "Research", "Trading", "CLEAN"),
    ("2", "s", "r", None, "Tip", "buy now before announcement", NOW, "Trading", "Research", "INSIDER_TRADING"),
    ("3", "s", "r", None, None, "no subject", NOW, "Legal", None, "CLEAN"),
    ("4", "s", "r", None, "Hello", None, NOW, None, "Trading", None),
    ("5", "s", "r", None, "Fees", "multiple client portfolio details", NOW, "Legal", "Legal", "CONFIDENTIALITY_BREACH"),
]


@pytest.fixture
def messages(spark):
    return spark.createDataFrame(MESSAGES, schemas.MESSAGES)


def test_keyword_flag_and_its_errors(messages):
    flagged = keywords.keyword_flag(messages, "body")
    assert {r["email_id"]: r["baseline_prediction"] for r in flagged.collect()} == {
        "1": "CLEAN", "2": "FLAGGED", "3": "CLEAN", "4": "CLEAN", "5": "FLAGGED"}
    assert len(SUSPICIOUS_PHRASES) == 18
    # A missing label counts as a violation here.
    missed = keywords.missed_violations(flagged, "email_id", "compliance_label", "body")
    assert [r["email_id"] for r in missed.collect()] == ["4"]
    assert keywords.false_alarms(flagged, "email_id", "compliance_label", "body").count() == 0
    counts = evaluation.confusion_counts(flagged, keywords.is_flagged(), keywords.differs_from_clean("compliance_label"))
    assert tuple(counts.first()) == (5, 2, 0, 1, 2)


def test_message_features(messages):
    found = {r["email_id"]: r for r in features.message_features(messages).collect()}
    assert [found[i]["cross_barrier_flag"] for i in "12345"] == [1, 1, 0, 0, 0]
    assert [found[i]["is_violation"] for i in "12345"] == [0, 1, 0, 1, 1]
    assert found["3"]["mnpi_risk_score"] is None and found["4"]["mnpi_risk_score"] is None
    assert found["1"]["baseline_similarity"] > found["1"]["mnpi_risk_score"]
    assert found["5"]["confidentiality_risk_score"] > found["5"]["baseline_similarity"]


def test_features_do_not_depend_on_partitioning(messages):
    one = features.message_features(messages.coalesce(1)).drop("body").collect()
    many = features.message_features(messages.repartition(5)).drop("body").collect()
    assert sorted(one, key=lambda r: r["email_id"]) == sorted(many, key=lambda r: r["email_id"])


def test_features_are_computed_once_and_without_a_shuffle(messages):
    plan = features.message_features(messages).filter("mnpi_risk_score > 0.1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and "Exchange" not in text


def test_relative_scores_and_separation(messages):
    found = features.relative_scores(features.message_features(messages))
    row = found.filter("email_id = '1'").first()
    assert row["mnpi_relative"] == row["mnpi_risk_score"] - row["baseline_similarity"]
    by_label = features.label_separation(found).collect()
    assert [(r["compliance_label"], r["n"]) for r in by_label][0] == ("CLEAN", 2)
    assert len(by_label) == 4


def test_top_risk_leaves_out_missing_labels_and_breaks_ties_by_key(spark):
    rows = [("b", 0.5, "X", "t"), ("a", 0.5, "X", "t"), ("c", 0.9, "CLEAN", "t"), ("d", 0.9, None, "t"), ("e", None, "X", "t")]
    df = spark.createDataFrame(rows, "id string, s double, compliance_label string, body string")
    assert [r["id"] for r in features.top_risk(df, ["s"], "id", 5).collect()] == ["a", "b", "e"]


def test_distribution_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "ml_decision string, is_violation int")
    assert evaluation.group_distribution(empty, "ml_decision").count() == 0
    funnel = evaluation.funnel_quality(empty)
    row = evaluation.hybrid_projection(funnel).first()
    assert row["ml_precision"] == row["ml_recall"] == row["hybrid_precision"] == row["review_share"] == 0.0
    assert evaluation.with_quality(evaluation.confusion(empty.withColumn("p", F.lit(0.1)), "p")).first()["f1"] == 0.0


def test_shares_and_rates(spark):
    rows = [("A", 1)] * 1 + [("A", 0)] * 1 + [("B", 0)] * 1
    found = evaluation.group_distribution(spark.createDataFrame(rows, "g string, is_violation int"), "g").collect()
    assert [tuple(r) for r in found] == [("A", 2, 1, 66.7, 50.0), ("B", 1, 0, 33.3, 0.0)]
    assert tuple(evaluation.violation_rate(spark.createDataFrame(rows, "g string, is_violation int")).first()) == (3, 1, 33.3)


def test_threshold_is_positive_and_null_scores_count_in_total_only(spark):
    df = spark.createDataFrame([(0.5, 1), (0.49, 1), (0.5, 0), (0.1, 0), (None, 1)], "p double, is_violation int")
    assert tuple(evaluation.confusion(df, "p").first()) == (5, 1, 1, 1, 1)


def test_projection_cuts_to_whole_messages(spark):
    rows = [("HIGH_RISK", 1)] * 4 + [("HIGH_RISK", 0)] + [("NEEDS_REVIEW", 1)] * 3 + [("NEEDS_REVIEW", 0)] * 19 + [("LOW_RISK", 1)] * 3
    df = spark.createDataFrame(rows, "ml_decision string, is_violation int")
    row = evaluation.hybrid_projection(evaluation.funnel_quality(df)).first()
    assert (row["review_caught"], row["hybrid_caught"], row["hybrid_false_positives"]) == (2, 6, 2)
    assert row["hybrid_precision"] == 6 / 8 and row["hybrid_recall"] == 6 / 10 and row["review_share"] == 22 / 30
    assert row["missed_violations"] == 3


def test_pair_stats_are_independent_and_case_sensitive(spark):
    df = spark.createDataFrame([("p", "VIOLATION not CLEAN"), ("p", "clean"), ("p", None)], "prompt string, completion string")
    assert tuple(evaluation.pair_stats(df).first()) == (3, 1, 1)


def test_profile_and_key_check(messages):
    doubled = messages.union(messages.filter("email_id = '1'"))
    row = profiling.profile_messages(doubled, "subject", ["subject", "body"]).first()
    assert (row["n"], row["unique_subjects"], row["null_subject"], row["null_body"]) == (6, 4, 1, 1)
    assert [tuple(r) for r in profiling.unique_key_violations(doubled, ["email_id"]).collect()] == [("1", 2)]


def test_as_of_against_brute_force(spark):
    """Half of all rows belong to one key; features repeat at equal times."""
    rng = random.Random(5)
    start = datetime(2024, 3, 1)

    def moment():
        return start + timedelta(minutes=rng.randrange(0, 60 * 24 * 3, 7))

    spine = [(i, rng.choice([1, 1, 1, 2, 3, 4]), moment()) for i in range(300)]
    known = [(rng.choice([1, 1, 1, 2, 3]), moment(), rng.choice([None, 0.5, 1.5, 2.5])) for _ in range(120)]
    left = spark.createDataFrame(spine, "id int, k int, ts timestamp_ntz")
    right = spark.createDataFrame(known, "k int, ts timestamp_ntz, v double")
    expected = {}
    for i, k, ts in spine:
        past = [(t, -1.0 if v is None else v) for kk, t, v in known if kk == k and t <= ts]
        best = max(past, default=None)
        expected[i] = None if best is None or best[1] == -1.0 else best[1]
    for seconds in (3600, 600, 10**9):
        found = as_of_lookup(left, right, "k", "ts", ["v"], slot_seconds=seconds)
        assert {r["id"]: r["asof_v"] for r in found.collect()} == expected


def test_as_of_does_not_match_missing_keys_or_times(spark):
    left = spark.createDataFrame([(1, None, datetime(2024, 1, 1)), (2, 7, None)], "id int, k int, ts timestamp_ntz")
    right = spark.createDataFrame([(None, datetime(2023, 1, 1), 1.0), (7, datetime(2023, 1, 1), 2.0)], "k int, ts timestamp_ntz, v double")
    assert {r["id"]: r["asof_v"] for r in as_of_lookup(left, right, "k", "ts", ["v"]).collect()} == {1: None, 2: None}


def test_prompt_cuts_the_body_and_keeps_nulls(spark):
    rows = [("1", 0.5, "Legal", "Trading", "s", "x" * 1501), ("2", 0.456, "Legal", "Trading", None, "b")]
    df = spark.createDataFrame(rows, "id string, violation_probability double, sender_dept string, recipient_dept string, subject string, body string")
    a, b = df.select(enrichment.review_prompt().alias("p")).collect()
    assert "x" * 1501 in a["p"] and "probability 0.5)" in a["p"]
    short = df.select(enrichment.review_prompt(body_chars=1500).alias("p")).first()["p"]
    assert "x" * 1500 in short and "x" * 1501 not in short
    assert b["p"] is None


def good(**changes):
    return json.dumps({"is_violation": True, "confidence": 0.5, "category": "CLEAN", "reasoning": "r"} | changes)


def test_parse_analysis_rejects_what_breaks_the_schema(spark):
    without = json.loads(good())
    del without["reasoning"]
    answers = [good(), "not json", json.dumps(without), good(is_violation="yes"), good(confidence=1.2),
               good(category="OTHER"), None, good(confidence=1.0), "[]"]
    df = spark.createDataFrame(list(enumerate(answers)), "id int, answer string")
    accepted, rejected = enrichment.parse_analysis(df)
    assert sorted(r["id"] for r in accepted.collect()) == [0, 7]
    assert sorted(r["id"] for r in rejected.collect()) == [1, 2, 3, 4, 5, 6, 8]
    written, _ = enrichment.parse_structured(
        spark.createDataFrame([('{"subject":"a","body":"b"}',), ('{"subject":"a"}',)], "answer string"),
        "answer", schemas.WRITTEN_MESSAGE, "message")
    assert [tuple(r["message"]) for r in written.collect()] == [("a", "b")]


def decided(messages):
    p = {"1": 0.1, "2": 0.9, "3": 0.5, "4": None, "5": 0.69}
    score = F.create_map(*[x for k, v in p.items() for x in (F.lit(k), F.lit(v).cast("double"))])[F.col("email_id")]
    return triage.decide(features.message_features(messages).withColumn("predict_proba_1", score))


def test_review_asks_once_per_message(spark, messages, tmp_path):
    log, store = tmp_path / "asked", str(tmp_path / "answers")
    log.mkdir()

    yes, no = (good(is_violation=x, category="CONFIDENTIALITY_BREACH") for x in (True, False))

    def completer(prompts):
        import uuid
        (log / uuid.uuid4().hex).write_text("\n".join(str(len(p)) for p in prompts))
        return [yes if "portfolio" in p else no for p in prompts]

    predictions = decided(messages)
    for _ in range(2):
        result = flows.review(predictions, messages, completer, store, tasks=2)
    rows = {r["email_id"]: r for r in result.tiered.collect()}
    asked = [n for f in log.iterdir() for n in f.read_text().splitlines() if n]
    assert len(asked) == 1  # 3 and 4 have a null prompt: no call
    assert {i: r["pipeline_action"] for i, r in rows.items()} == {
        "1": "AUTO_CLEAR", "2": "AUTO_ESCALATE", "3": "LLM_ANALYSIS", "4": "LLM_ANALYSIS", "5": "LLM_ANALYSIS"}
    assert rows["5"]["analysis"]["is_violation"] is True and rows["3"]["analysis"] is None
    assert sorted(r["email_id"] for r in result.rejected.collect()) == ["3", "4"]
    measured = evaluation.hybrid_measured(result.tiered).first()
    assert (measured["tp"], measured["fp"], measured["fn"], measured["tn"]) == (2, 0, 1, 2)


def test_a_failed_answer_is_asked_again(spark, tmp_path):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    calls, store = tmp_path / "calls", str(tmp_path / "answers")
    calls.mkdir()

    yes = good()

    def failing(prompts):
        return [None if p == "p1" else "no json" if p == "p2" else yes for p in prompts]

    def working(prompts):
        for p in prompts:
            (calls / p).write_text("")
        return [yes for _ in prompts]

    prompts = lambda todo: todo.withColumn("prompt", F.concat(F.lit("p"), F.col("id").cast("string")))
    first = enrichment.complete_missing(keys, "id", prompts, failing, store)
    assert enrichment.parse_analysis(first).accepted.count() == 1
    second = enrichment.complete_missing(keys, "id", prompts, working, store)
    assert enrichment.parse_analysis(second).accepted.count() == 3 and second.count() == 3
    assert sorted(f.name for f in calls.iterdir()) == ["p1", "p2"]


def test_a_completer_that_dies_leaves_what_it_has_answered(spark, tmp_path):
    """It dies after half of the rows; the next run asks for the other half only."""
    keys = spark.range(40).coalesce(1)
    calls, store, yes = tmp_path / "calls", str(tmp_path / "answers"), good()
    calls.mkdir()

    def completer(limit):
        def answer(prompts):
            if len(list(calls.iterdir())) >= limit:
                raise RuntimeError("out of service")
            for p in prompts:
                (calls / p).write_text((calls / p).read_text() + "x" if (calls / p).exists() else "x")
            return [yes for _ in prompts]
        return answer

    def run(limit):
        return enrichment.complete_missing(keys, "id", lambda todo: todo.withColumn("prompt", F.concat(F.lit("p"), "id")), completer(limit),
                                           store, call_rows=5)

    with pytest.raises(Exception, match="out of service"):
        run(20)
    assert enrichment.latest_answers(spark, store, "id").count() == 20
    assert run(1000).count() == 40
    assert {f.read_text() for f in calls.iterdir()} == {"x"} and len(list(calls.iterdir())) == 40
    assert {(r.attempts, r.reason) for r in enrichment.attempt_report(spark, store, "id").collect()} == {(1, None)}
    run(0)  # nothing is left to ask


def test_attempts_are_limited_and_reported(spark, tmp_path):
    keys, store = spark.createDataFrame([(1,), (2,), (3,)], "id int"), str(tmp_path / "answers")
    asked, yes = tmp_path / "asked", good()

    def completer(prompts):
        with asked.open("a") as log:
            log.writelines(f"{p}\n" for p in prompts)
        return [None if p == "p1" else "no json" if p == "p2" else yes for p in prompts]

    for _ in range(4):
        enrichment.complete_missing(keys, "id", lambda todo: todo.withColumn("prompt", F.concat(F.lit("p"), "id")), completer, store, max_attempts=2)
    assert sorted(asked.read_text().split()) == ["p1", "p1", "p2", "p2", "p3"]
    assert {tuple(r) for r in enrichment.attempt_report(spark, store, "id").collect()} == {
        (1, 2, "no answer"), (2, 2, "unusable answer"), (3, 1, None)}


def test_a_wrong_answer_count_is_an_error(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, prompt string").coalesce(1)
    with pytest.raises(Exception):
        enrichment.complete(df, "id", "prompt", lambda prompts: ["only one"]).collect()
    with pytest.raises(Exception):
        enrichment.complete(df, "id", "prompt", lambda prompts: ["x"] * (len(prompts) + 1)).collect()


def test_uncertain_filters_before_the_join(messages):
    gate = enrichment.uncertain(decided(messages), messages)
    assert sorted(r["email_id"] for r in gate.collect()) == ["3", "4", "5"]
    report = enrichment.analysis_report(gate.withColumn("analysis", F.lit("x"))).orderBy("email_id").collect()
    assert [r["communication"] for r in report] == [None, None, "Legal -> Legal"]
    assert CONCEPTS.keys() <= set(features.message_features(messages).columns)


def test_profiles_of_batches_merge_to_those_of_all_rows(spark, tmp_path):
    from tierwatch.operators.profile_store import ProfileStore

    rows = [(i, None if i % 10 == 0 else f"t{i % 400}", float(i) if i % 4 else None, "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, subject string, value double, n string").repartition(5)
    store = ProfileStore(str(tmp_path / "profiles"))
    for batch in range(4):
        store.add(df.filter(f"id % 4 = {batch}"), batch, ["subject", "n"], ["value"])
    store.add(df.filter("id % 4 = 1"), 1, ["subject", "n"], ["value"])  # the batch again changes nothing
    found = {r["column"]: r for r in store.merged(spark).collect()}
    assert {c: (r["n"], r["n_null"]) for c, r in found.items()} == {"subject": (2000, 200), "value": (2000, 500), "n": (2000, 0)}
    assert found["n"]["n_distinct"] == 1 and abs(found["subject"]["n_distinct"] - 360) <= 12 and abs(found["value"]["n_distinct"] - 1500) <= 48
    assert found["subject"]["uniqueness"] == pytest.approx(found["subject"]["n_distinct"] / 1800)
    values = sorted(v for _, _, v, _ in rows if v is not None)
    for rank, got in zip((0.1, 0.5, 0.9), found["value"]["quantiles"]):
        assert abs(sum(v <= got for v in values) / len(values) - rank) <= 0.01
    assert found["subject"]["quantiles"] is None
    one = {r["column"]: r for r in store.merged(spark, batches=[0]).collect()}
    assert one["value"]["n"] == 500 and one["value"]["n_null"] == 500 and one["value"]["quantiles"] is None and one["value"]["n_distinct"] == 0
