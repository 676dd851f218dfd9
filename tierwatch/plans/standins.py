"""The given tables in the shape of the message table, in Spark and in SQL.

The concepts, phrases and weights here fit the words of the given tables; the operators
take them as arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwatch.constants import FLAG_COLUMN
from tierwatch.functions.decisions import logistic_score
from tierwatch.operators import enrichment, features, triage
from tierwatch.session import batch_texts, materialize

PHRASES = ("trash", "scum", "idiot", "moron", "hate", "license")
CONCEPTS = {
    "baseline_similarity": "the and that with this from",
    "mnpi_risk_score": "scum idiot trash moron",
    "confidentiality_risk_score": "les des une que",
    "personal_trading_risk_score": "der die und das",
    "info_barrier_risk_score": "hate license copyright email",
}
PAIR = ("en", "fr")
WEIGHTS = (-1.0, 30.0, -2.0, -1.0, 4.0, 0.3)
BIAS = -1.3
FEATURES = (*CONCEPTS, FLAG_COLUMN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    batch_texts(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a message without a label."""
    return as_messages(table(spark, sf_dir, "documents"))


def as_messages(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("email_id"), F.col("source").alias("subject"), F.col("text").alias("body"),
        F.col("lang").alias("sender_dept"), _sent_at("doc_id").alias("sent_at"))


def _sent_at(key: str):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.col(key) * F.expr("INTERVAL '1' MINUTE")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents as messages with departments and a label."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("email_id"),
        F.when(F.col("quality") == 1, "en").otherwise("fr").alias("recipient_dept"),
        F.when(F.col("toxic") == 0, "CLEAN").when(F.col("quality") == 0, "INSIDER_TRADING")
        .otherwise("CONFIDENTIALITY_BREACH").alias("compliance_label"))
    return as_messages(docs).join(labels, "email_id")


def message_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.message_features(labelled(spark, sf_dir), CONCEPTS, PAIR)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with a fixed-weight probability and the three-way decision."""
    scored = message_features(spark, sf_dir).withColumn(
        "predict_proba_1", F.round(logistic_score(FEATURES, WEIGHTS, BIAS), 9))
    return triage.decide(scored)


def stored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prediction table, written once without the texts."""
    return materialize(predictions(spark, sf_dir).drop("subject", "body"), "predictions")


def gate(spark: SparkSession, sf_dir: str, stored: DataFrame) -> DataFrame:
    """The uncertain bucket with its texts."""
    return enrichment.uncertain(stored, labelled(spark, sf_dir))


def analysis(spark: SparkSession, sf_dir: str, stored: DataFrame) -> DataFrame:
    """Key and parsed answer of the uncertain bucket, from the native completer.

    Answers are a stored table, as with any completer; parsing reads them many times.
    """
    answer = enrichment.phrase_answer(F.col("body"), F.col("violation_probability"), PHRASES)
    answers = materialize(gate(spark, sf_dir, stored).select("email_id", answer.alias("answer")), "answers")
    return enrichment.parse_analysis(answers).accepted


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_predictions(spark, sf_dir)
    return triage.tiered_view(stored, labelled(spark, sf_dir), analysis(spark, sf_dir, stored))


# SQL twins of the above, as common table expressions.

SQL_DOCUMENTS = """
docs AS (
  SELECT doc_id AS email_id, source AS subject, text AS body, lang AS sender_dept,
         TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 MINUTE AS sent_at
  FROM documents)"""

SQL_LABELLED = SQL_DOCUMENTS + """,
labelled AS (
  SELECT d.*, CASE WHEN l.quality = 1 THEN 'en' ELSE 'fr' END AS recipient_dept,
         CASE WHEN l.toxic = 0 THEN 'CLEAN' WHEN l.quality = 0 THEN 'INSIDER_TRADING'
              ELSE 'CONFIDENTIALITY_BREACH' END AS compliance_label,
         CAST(l.toxic AS INTEGER) AS is_violation
  FROM docs d JOIN labels l ON d.email_id = l.doc_id)"""

SEPARATOR = r"[^\p{L}\p{N}]+"
CELL = "('0x' || substr(md5(w), 1, 8))::BIGINT % 768"


def sql_cells(source: str, text: str, into: str = "cells") -> str:
    """Hashed word counts (email_id, b, c) of a text expression."""
    return f"""
{into} AS (
  SELECT email_id, {CELL} AS b, count(*)::DOUBLE AS c
  FROM (SELECT email_id, unnest(string_split_regex(lower({text}), '{SEPARATOR}')) AS w FROM {source}) t
  WHERE w <> '' GROUP BY 1, 2)"""


def _sql_concepts() -> str:
    words = ", ".join(f"('{name}', '{w}')" for name, phrase in CONCEPTS.items() for w in phrase.split())
    return f"""
concept_cells AS (
  SELECT name, {CELL} AS b, count(*)::DOUBLE AS c FROM (VALUES {words}) v(name, w) GROUP BY 1, 2),
concept_norms AS (SELECT name, sqrt(sum(c * c)) AS n FROM concept_cells GROUP BY 1)"""


def _sql_features(source: str, flag: str) -> str:
    scores = ",\n         ".join(
        f"coalesce(max(CASE WHEN s.name = '{n}' THEN s.cos END), 0.0) AS {n}" for n in CONCEPTS)
    return f"""
norms AS (SELECT email_id, sqrt(sum(c * c)) AS n FROM cells GROUP BY 1),
cosines AS (
  SELECT x.email_id, k.name, sum(x.c * k.c) / (max(n.n) * max(kn.n)) AS cos
  FROM cells x JOIN concept_cells k USING (b) JOIN norms n ON n.email_id = x.email_id
  JOIN concept_norms kn ON kn.name = k.name GROUP BY 1, 2),
scores AS (
  SELECT m.email_id,
         {scores}
  FROM {source} m LEFT JOIN cosines s ON s.email_id = m.email_id GROUP BY 1),
features AS (
  SELECT m.*, {", ".join("f." + n for n in CONCEPTS)}, {flag}
  FROM {source} m JOIN scores f USING (email_id))"""


_CROSSES = " OR ".join(f"(m.sender_dept = '{a}' AND m.recipient_dept = '{b}')" for a, b in (PAIR, PAIR[::-1]))
SQL_FEATURES = (SQL_LABELLED + "," + sql_cells("labelled", "subject || ' ' || body") + "," + _sql_concepts() + ","
                + _sql_features("labelled", f"CASE WHEN {_CROSSES} THEN 1 ELSE 0 END AS cross_barrier_flag"))
SQL_ALL_FEATURES = (SQL_DOCUMENTS + "," + sql_cells("docs", "subject || ' ' || body") + "," + _sql_concepts() + ","
                    + _sql_features("docs", "0 AS cross_barrier_flag"))

_LINEAR = " + ".join(f"({w}::DOUBLE) * {c}" for c, w in zip(FEATURES, WEIGHTS))
SQL_PREDICTIONS = SQL_FEATURES + f""",
scored AS (SELECT *, round(1.0 / (1.0 + exp(-({BIAS}::DOUBLE + {_LINEAR}))), 9) AS violation_probability FROM features),
predictions AS (
  SELECT *, CASE WHEN violation_probability >= 0.7 THEN 'HIGH_RISK'
                 WHEN violation_probability <= 0.3 THEN 'LOW_RISK' ELSE 'NEEDS_REVIEW' END AS ml_decision
  FROM scored)"""

SQL_HIT = "regexp_matches(lower(body), '" + "|".join(PHRASES) + "')"
SQL_ANALYSIS = SQL_PREDICTIONS + f""",
analysis AS (
  SELECT *, {SQL_HIT} AS a_is_violation, round(violation_probability, 3) AS a_confidence,
         CASE WHEN {SQL_HIT} THEN 'INSIDER_TRADING' ELSE 'CLEAN' END AS a_category,
         CASE WHEN {SQL_HIT} THEN 'a listed phrase occurs' ELSE 'no listed phrase occurs' END AS a_reasoning
  FROM predictions WHERE ml_decision = 'NEEDS_REVIEW')"""
SQL_TIERED = SQL_ANALYSIS + """,
tiered AS (
  SELECT p.email_id, p.subject, p.sender_dept, p.recipient_dept, p.ml_decision, p.violation_probability,
         CASE p.ml_decision WHEN 'HIGH_RISK' THEN 'AUTO_ESCALATE' WHEN 'NEEDS_REVIEW' THEN 'LLM_ANALYSIS'
              ELSE 'AUTO_CLEAR' END AS pipeline_action,
         a.a_is_violation, a.a_confidence, a.a_category, p.compliance_label AS actual_label, p.is_violation
  FROM predictions p LEFT JOIN analysis a USING (email_id))"""


def sql_ratio(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0), 0.0)"
