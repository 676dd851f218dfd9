"""Registered queries: keyword baseline, features, decisions, evaluation, enrichment."""

from __future__ import annotations

import json

from pyspark.sql import functions as F, types as T

from tierwatch.operators import classifier, enrichment, evaluation, features, keywords
from tierwatch.functions.decisions import cross_group_flag, violation_target
from tierwatch.plans import standins as s
from tierwatch.plans.registered import query
from tierwatch.session import scratch_path

_FLAGGED = f"""flagged AS (
  SELECT *, CASE WHEN regexp_matches(lower(body), '{"|".join(s.PHRASES)}') THEN 'FLAGGED' ELSE 'CLEAN' END
         AS baseline_prediction FROM labelled)"""
_QUALITY = f"""
  {s.sql_ratio("tp", "tp + fp")} AS precision, {s.sql_ratio("tp", "tp + fn")} AS recall,
  {s.sql_ratio("2.0 * tp", "2 * tp + fp + fn")} AS f1, {s.sql_ratio("tp + tn", "tp + fp + fn + tn")} AS accuracy"""
_ROUNDED = "round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, round(accuracy, 9) AS accuracy"

_K_SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def _round(df, *columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _quality(df):
    return _round(df, "precision", "recall", "f1", "accuracy")


@query(f"""
SELECT doc_id AS email_id, CASE WHEN regexp_matches(lower(text), '{"|".join(s.PHRASES)}') THEN 'FLAGGED' ELSE 'CLEAN' END
       AS baseline_prediction FROM documents""")
def keyword_flag(spark, sf_dir):
    messages = s.as_messages(s.table(spark, sf_dir, "documents"))
    return keywords.keyword_flag(messages, "body", s.PHRASES).select("email_id", "baseline_prediction")


@query(f"""
WITH {s.SQL_LABELLED}, {_FLAGGED},
counts AS (SELECT count(*) AS total,
  count(*) FILTER (baseline_prediction = 'FLAGGED' AND is_violation = 1) AS tp,
  count(*) FILTER (baseline_prediction = 'FLAGGED' AND is_violation = 0) AS fp,
  count(*) FILTER (baseline_prediction <> 'FLAGGED' AND is_violation = 1) AS fn,
  count(*) FILTER (baseline_prediction <> 'FLAGGED' AND is_violation = 0) AS tn FROM flagged),
quality AS (SELECT *, {_QUALITY} FROM counts)
SELECT total, tp, fp, fn, tn, {_ROUNDED} FROM quality""")
def keyword_metrics(spark, sf_dir):
    flagged = keywords.keyword_flag(s.labelled(spark, sf_dir), "body", s.PHRASES)
    return _quality(evaluation.with_quality(evaluation.confusion_counts(
        flagged, keywords.is_flagged(), keywords.differs_from_clean("compliance_label"))))


@query(f"""
WITH {s.SQL_LABELLED}, {_FLAGGED}
SELECT email_id, compliance_label, subject, substr(body, 1, 400) AS body FROM flagged
WHERE baseline_prediction = 'FLAGGED' AND compliance_label = 'CLEAN' ORDER BY email_id LIMIT 2""")
def false_alarms(spark, sf_dir):
    flagged = keywords.keyword_flag(s.labelled(spark, sf_dir), "body", s.PHRASES)
    return keywords.false_alarms(flagged, "email_id", "compliance_label", "body").select(
        "email_id", "compliance_label", "subject", "body")


@query(f"""
WITH {s.SQL_LABELLED}, {_FLAGGED}
SELECT email_id, compliance_label, subject, substr(body, 1, 400) AS body FROM flagged
WHERE baseline_prediction <> 'FLAGGED' AND compliance_label <> 'CLEAN' ORDER BY email_id LIMIT 3""")
def missed_violations(spark, sf_dir):
    flagged = keywords.keyword_flag(s.labelled(spark, sf_dir), "body", s.PHRASES)
    return keywords.missed_violations(flagged, "email_id", "compliance_label", "body").select(
        "email_id", "compliance_label", "subject", "body")


@query("""
SELECT a.conv_id, a.turn, a.role AS sender, b.role AS recipient,
       CASE WHEN (a.role = 'user' AND b.role = 'assistant') OR (a.role = 'assistant' AND b.role = 'user')
            THEN 1 ELSE 0 END AS cross_group_flag
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def cross_group_flags(spark, sf_dir):
    # Joined on both columns: a very long conversation still spreads over tasks.
    turns = s.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    answers = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("recipient"))
    pairs = turns.withColumnRenamed("role", "sender").join(answers, ["conv_id", "turn"])
    return pairs.withColumn("cross_group_flag", cross_group_flag(
        F.col("sender"), F.col("recipient"), ("user", "assistant")))


@query(f"""
WITH {s.SQL_FEATURES}
SELECT email_id, {", ".join(f"round({c}, 6) AS {c}" for c in s.CONCEPTS)}, cross_barrier_flag, is_violation FROM features""")
def concept_features(spark, sf_dir):
    found = s.message_features(spark, sf_dir)
    return _round(found.select("email_id", *s.FEATURES, "is_violation"), *s.CONCEPTS, digits=6)


@query(f"""
WITH {s.SQL_FEATURES}
SELECT email_id, round(mnpi_risk_score - baseline_similarity, 6) AS mnpi_relative,
       round(confidentiality_risk_score - baseline_similarity, 6) AS confidentiality_relative,
       round(personal_trading_risk_score - baseline_similarity, 6) AS personal_trading_relative,
       round(info_barrier_risk_score - baseline_similarity, 6) AS info_barrier_relative FROM features""")
def relative_scores(spark, sf_dir):
    names = ["mnpi_relative", "confidentiality_relative", "personal_trading_relative", "info_barrier_relative"]
    found = features.relative_scores(s.message_features(spark, sf_dir))
    return _round(found.select("email_id", *names), *names, digits=6)


@query(f"""
WITH {s.SQL_FEATURES}
SELECT compliance_label, count(*) AS n, {", ".join(f"round(avg({c}), 3) AS avg_{c}" for c in list(s.CONCEPTS)[1:])}
FROM features GROUP BY 1 ORDER BY n DESC""")
def label_separation(spark, sf_dir):
    return features.label_separation(s.message_features(spark, sf_dir))


_RISK_SUM = "mnpi_risk_score + confidentiality_risk_score + info_barrier_risk_score"


@query(f"""
WITH {s.SQL_FEATURES}
SELECT email_id, compliance_label, subject, substr(body, 1, 200) AS body_preview, round({_RISK_SUM}, 6) AS risk_total
FROM features WHERE compliance_label <> 'CLEAN' ORDER BY {_RISK_SUM} DESC, email_id LIMIT 3""")
def top_risk(spark, sf_dir):
    top = features.top_risk_messages(s.labelled(spark, sf_dir), _RISK_SUM.split(" + "), "email_id",
                                     concepts=s.CONCEPTS, pair=s.PAIR)
    return _round(top.select("email_id", "compliance_label", "subject", "body_preview", "risk_total"),
                  "risk_total", digits=6)


@query("""
SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id::VARCHAR), 1, 8))::BIGINT % 10000 < 8000
                    THEN 'train' ELSE 'test' END AS split FROM labels""")
def hash_split(spark, sf_dir):
    return classifier.hash_split(s.table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "split")


@query(f"""
WITH {s.SQL_PREDICTIONS}
SELECT email_id, round(violation_probability, 6) AS violation_probability, ml_decision FROM predictions""")
def three_way_decision(spark, sf_dir):
    return _round(s.predictions(spark, sf_dir).select("email_id", "violation_probability", "ml_decision"),
                  "violation_probability", digits=6)


def _distribution(source: str, group: str) -> str:
    return f"""
SELECT {group}, count(*) AS n, sum(is_violation)::BIGINT AS violations,
       round((count(*) * 100.0)::DOUBLE / sum(count(*)) OVER (), 1)::DOUBLE AS pct,
       round((sum(is_violation) * 100.0)::DOUBLE / count(*), 1)::DOUBLE AS violation_rate
FROM {source} GROUP BY 1"""


@query(f"WITH {s.SQL_PREDICTIONS} {_distribution('predictions', 'ml_decision')}")
def decision_distribution(spark, sf_dir):
    """Flagship: texts to similarities to probability to three-way decision to shares."""
    return evaluation.group_distribution(s.predictions(spark, sf_dir), "ml_decision")


@query(f"""
WITH {s.SQL_PREDICTIONS},
counts AS (SELECT count(*) AS total,
  count(*) FILTER (violation_probability >= 0.5 AND is_violation = 1) AS tp,
  count(*) FILTER (violation_probability >= 0.5 AND is_violation = 0) AS fp,
  count(*) FILTER (violation_probability < 0.5 AND is_violation = 1) AS fn,
  count(*) FILTER (violation_probability < 0.5 AND is_violation = 0) AS tn FROM predictions),
quality AS (SELECT *, {_QUALITY} FROM counts)
SELECT total, tp, fp, fn, tn, {_ROUNDED} FROM quality""")
def confusion_at_half(spark, sf_dir):
    return _quality(evaluation.with_quality(
        evaluation.confusion(s.predictions(spark, sf_dir), "violation_probability")))


@query(f"""
WITH {s.SQL_LABELLED}
SELECT count(*) AS n, count(*) FILTER (is_violation = 1) AS violations,
       round(count(*) FILTER (is_violation = 1) * 100.0::DOUBLE / count(*), 1)::DOUBLE AS pct FROM labelled""")
def violation_rate(spark, sf_dir):
    labelled = s.labelled(spark, sf_dir).withColumn("is_violation", violation_target(F.col("compliance_label")))
    return evaluation.violation_rate(labelled)


@query(f"""
WITH {s.SQL_PREDICTIONS}
SELECT email_id, compliance_label AS actual_label, ml_decision, round(violation_probability, 6) AS violation_probability,
       sender_dept, recipient_dept, subject, md5(body) AS body_digest
FROM predictions WHERE ml_decision = 'NEEDS_REVIEW'""")
def uncertain_messages(spark, sf_dir):
    gate = s.gate(spark, sf_dir, s.stored_predictions(spark, sf_dir))
    return _round(gate.withColumn("body_digest", F.md5("body")).drop("body"), "violation_probability", digits=6)


_TEST_TEMPLATE = "Chance {probability}. From {sender_dept} to {recipient_dept}.\nSubject: {subject}\nBody: {body}\nJSON."


@query(f"""
WITH {s.SQL_PREDICTIONS}
SELECT email_id, md5('Chance ' || round(violation_probability, 2)::VARCHAR || '. From ' || sender_dept || ' to ' || recipient_dept
       || '.' || chr(10) || 'Subject: ' || subject || chr(10) || 'Body: ' || body || chr(10) || 'JSON.')
       AS prompt_digest
FROM predictions WHERE ml_decision = 'NEEDS_REVIEW'""")
def render_prompt(spark, sf_dir):
    gate = s.gate(spark, sf_dir, s.stored_predictions(spark, sf_dir))
    return gate.select("email_id", F.md5(enrichment.review_prompt(_TEST_TEMPLATE)).alias("prompt_digest"))


@query(f"""
WITH {s.SQL_ANALYSIS}
SELECT email_id, a_is_violation AS is_violation, a_confidence AS confidence, a_category AS category,
       a_reasoning AS reasoning FROM analysis""")
def structured_answers(spark, sf_dir):
    found = s.analysis(spark, sf_dir, s.stored_predictions(spark, sf_dir))
    return found.select("email_id", "analysis.*")


def _count_completer(prompts):
    """A stand-in for a model: the answer depends on the prompt only."""
    return [json.dumps({"is_violation": len(p) % 2 == 0, "confidence": (len(p) % 100) / 100,
                        "category": "CLEAN" if len(p) % 2 else "PERSONAL_TRADING", "reasoning": str(len(p))})
            for p in prompts]


@query(f"""
WITH {s.SQL_PREDICTIONS}, prompts AS (
  SELECT email_id, length('Chance ' || round(violation_probability, 2)::VARCHAR || '. From ' || sender_dept || ' to '
         || recipient_dept || '.' || chr(10) || 'Subject: ' || subject || chr(10) || 'Body: ' || body
         || chr(10) || 'JSON.') AS n FROM predictions WHERE ml_decision = 'NEEDS_REVIEW')
SELECT email_id, n % 2 = 0 AS is_violation, (n % 100)::DOUBLE / 100 AS confidence,
       CASE WHEN n % 2 = 1 THEN 'CLEAN' ELSE 'PERSONAL_TRADING' END AS category, n::VARCHAR AS reasoning FROM prompts""")
def completed_answers(spark, sf_dir):
    """The completer plug-in: asked once, stored; the second call finds nothing left to ask."""
    uncertain = s.stored_predictions(spark, sf_dir).filter("ml_decision = 'NEEDS_REVIEW'")

    def prompts(todo):
        return s.gate(spark, sf_dir, todo).withColumn("prompt", enrichment.review_prompt(_TEST_TEMPLATE))

    store = scratch_path(spark, "answers")
    for _ in range(2):
        answers = enrichment.complete_missing(uncertain, "email_id", prompts, _count_completer, store)
    return enrichment.parse_analysis(answers).accepted.select("email_id", "analysis.*")


@query("""
WITH parsed AS (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_type, count(*) FILTER (k < 50) AS accepted, count(*) FILTER (k IS NULL OR k >= 50) AS rejected
FROM parsed GROUP BY 1""")
def answer_rejects(spark, sf_dir):
    events = s.table(spark, sf_dir, "events").select("event_type", "props")
    accepted, rejected = enrichment.parse_structured(
        events, "props", _K_SCHEMA, "parsed", F.col("parsed")["k"] < 50)
    both = accepted.select("event_type", F.lit(1).alias("ok")).unionByName(
        rejected.select("event_type", F.lit(0).alias("ok")))
    return both.groupBy("event_type").agg(
        F.count_if(F.col("ok") == 1).alias("accepted"), F.count_if(F.col("ok") == 0).alias("rejected"))


@query("""
SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS sum_k,
       max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k FROM events GROUP BY 1""")
def json_path(spark, sf_dir):
    k = F.from_json("props", _K_SCHEMA)["k"]
    return s.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(k).alias("sum_k"), F.max(k).alias("max_k"))


@query(f"""
WITH {s.SQL_ANALYSIS}
SELECT email_id, compliance_label AS actual_label, sender_dept || ' -> ' || recipient_dept AS communication, subject,
       substr(body, 1, 300) AS body_preview, a_category AS category FROM analysis""")
def analysis_report(spark, sf_dir):
    stored = s.stored_predictions(spark, sf_dir)
    found = s.gate(spark, sf_dir, stored).join(s.analysis(spark, sf_dir, stored), "email_id")
    return enrichment.analysis_report(found).withColumn("category", F.col("analysis.category")).drop("analysis")


@query(f"""
WITH {s.SQL_TIERED}
SELECT email_id, subject, sender_dept, recipient_dept, ml_decision, round(violation_probability, 6) AS violation_probability,
       pipeline_action, a_is_violation AS reviewed_violation, a_confidence AS reviewed_confidence,
       a_category AS reviewed_category, actual_label, is_violation FROM tiered""")
def tiered_triage(spark, sf_dir):
    found = s.tiered(spark, sf_dir).withColumns({
        "reviewed_violation": F.col("analysis.is_violation"),
        "reviewed_confidence": F.col("analysis.confidence"),
        "reviewed_category": F.col("analysis.category")})
    return _round(found.drop("analysis"), "violation_probability", digits=6)


@query(f"WITH {s.SQL_TIERED} {_distribution('tiered', 'pipeline_action')}")
def route_distribution(spark, sf_dir):
    return evaluation.group_distribution(s.tiered(spark, sf_dir), "pipeline_action")


_FUNNEL = f"""
funnel AS (SELECT count(*) AS total, count(*) FILTER (is_violation = 1) AS total_violations,
  count(*) FILTER (ml_decision = 'HIGH_RISK') AS high_risk_count,
  count(*) FILTER (ml_decision = 'NEEDS_REVIEW') AS needs_review_count,
  count(*) FILTER (ml_decision = 'HIGH_RISK' AND is_violation = 1) AS high_risk_violations,
  count(*) FILTER (ml_decision = 'NEEDS_REVIEW' AND is_violation = 1) AS needs_review_violations,
  count(*) FILTER (ml_decision = 'LOW_RISK' AND is_violation = 1) AS missed_violations FROM tiered),
quality AS (SELECT *, {s.sql_ratio("high_risk_violations", "high_risk_count")} AS ml_precision,
  {s.sql_ratio("high_risk_violations", "total_violations")} AS ml_recall FROM funnel)"""


@query(f"""
WITH {s.SQL_TIERED}, {_FUNNEL}
SELECT * EXCLUDE (ml_precision, ml_recall), round(ml_precision, 9) AS ml_precision, round(ml_recall, 9) AS ml_recall
FROM quality""")
def funnel_quality(spark, sf_dir):
    return _round(evaluation.funnel_quality(s.tiered(spark, sf_dir)), "ml_precision", "ml_recall")


@query(f"""
WITH {s.SQL_TIERED}, {_FUNNEL},
caught AS (SELECT *, floor(needs_review_violations * 0.9::DOUBLE)::BIGINT AS review_caught,
  high_risk_violations + floor(needs_review_violations * 0.9::DOUBLE)::BIGINT AS hybrid_caught,
  high_risk_count - high_risk_violations
    + floor((needs_review_count - needs_review_violations) * 0.1::DOUBLE)::BIGINT AS hybrid_false_positives FROM quality)
SELECT review_caught, hybrid_caught, hybrid_false_positives,
  round({s.sql_ratio("hybrid_caught", "hybrid_caught + hybrid_false_positives")}, 9) AS hybrid_precision,
  round({s.sql_ratio("hybrid_caught", "total_violations")}, 9) AS hybrid_recall,
  round({s.sql_ratio("hybrid_caught", "total_violations")} - ml_recall, 9) AS recall_gain,
  round({s.sql_ratio("needs_review_count", "total")}, 9) AS review_share FROM caught""")
def hybrid_projection(spark, sf_dir):
    found = evaluation.hybrid_projection(evaluation.funnel_quality(s.tiered(spark, sf_dir)))
    ratios = ["hybrid_precision", "hybrid_recall", "recall_gain", "review_share"]
    return _round(found.select("review_caught", "hybrid_caught", "hybrid_false_positives", *ratios), *ratios)


@query(f"""
WITH {s.SQL_TIERED},
final AS (SELECT is_violation, ml_decision = 'HIGH_RISK'
          OR (ml_decision = 'NEEDS_REVIEW' AND coalesce(a_is_violation, FALSE)) AS hit FROM tiered),
counts AS (SELECT count(*) AS total, count(*) FILTER (hit AND is_violation = 1) AS tp,
  count(*) FILTER (hit AND is_violation = 0) AS fp, count(*) FILTER (NOT hit AND is_violation = 1) AS fn,
  count(*) FILTER (NOT hit AND is_violation = 0) AS tn FROM final),
quality AS (SELECT *, {_QUALITY} FROM counts)
SELECT total, tp, fp, fn, tn, {_ROUNDED} FROM quality""")
def hybrid_measured(spark, sf_dir):
    return _quality(evaluation.hybrid_measured(s.tiered(spark, sf_dir)))
