"""Registered queries: ingest, inventory, profiling, lookup, streams, training."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tierwatch.constants import CATEGORIES
from tierwatch.functions.text import first_token, iso_to_timestamp, timestamp_to_iso
from tierwatch.operators import classifier, enrichment, evaluation, features, profiling, thresholds, triage
from tierwatch.operators.asof import as_of_lookup
from tierwatch.operators.profile_store import DISTINCT_ERROR, RANK_ERROR, ProfileStore
from tierwatch.operators.registry import FeatureRegistry, FeatureView, ModelRegistry
from tierwatch.operators.search_index import SearchIndex
from tierwatch.functions.decisions import logistic_score, route
from tierwatch.plans import standins as s
from tierwatch.plans.flows import Retrained, retrain
from tierwatch.plans.registered import query
from tierwatch.plans.suite_search import QUERY_TEXT, _bm25, _ranked
from tierwatch.session import scratch_path
from tierwatch.sources import catalog, contract, files, sinks
from tierwatch.streaming import refresh
from tierwatch.streaming.keyed_table import KeyedTable, follow

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


@query("""
SELECT lang, count(*) AS n, round((count(*) * 100.0)::DOUBLE / sum(count(*)) OVER (), 1)::DOUBLE AS pct
FROM documents GROUP BY 1""")
def label_distribution(spark, sf_dir):
    return evaluation.label_distribution(s.table(spark, sf_dir, "documents"), "lang")


@query("SELECT doc_id, lang, md5(text) AS text_digest FROM documents ORDER BY doc_id LIMIT 100")
def sample_rows(spark, sf_dir):
    found = profiling.sample_rows(s.table(spark, sf_dir, "documents"), "doc_id", 100)
    return found.select("doc_id", "lang", F.md5("text").alias("text_digest"))


@query("""
SELECT count(*) AS n, count(DISTINCT text) AS unique_subjects, count(*) - count(source) AS null_source,
       count(*) - count(lang) AS null_lang, round(count(DISTINCT text)::DOUBLE / count(*), 9) AS unique_ratio FROM documents""")
def profile_messages(spark, sf_dir):
    found = profiling.profile_messages(s.table(spark, sf_dir, "documents"), "text", ["source", "lang"])
    return found.withColumn("unique_ratio", F.round("unique_ratio", 9))


@query("""
SELECT 'n_chars' AS "column", count(*) AS n, count(*) - count(n_chars) AS n_null, TRUE AS distinct_is_close, TRUE AS quantiles_are_close FROM documents
UNION ALL SELECT 'text', count(*), count(*) - count(text), TRUE, NULL FROM documents
UNION ALL SELECT 'source', count(*), count(*) - count(source), TRUE, NULL FROM documents""")
def profile_batches(spark, sf_dir):
    """Profiles of four batches, merged from their sketches and held against exact figures: within four standard errors."""
    docs, store = s.table(spark, sf_dir, "documents"), ProfileStore(scratch_path(spark, "profiles"))
    for batch in range(4):
        store.add(docs.filter(F.pmod("doc_id", F.lit(4)) == batch), batch, ["text", "source"], ["n_chars"])
    found = store.merged(spark)
    near = found.filter(F.col("column") == "n_chars").first()["quantiles"]
    share = lambda flag: F.avg(flag.cast("double"))
    ranks = docs.agg(F.array(*(F.struct(share(F.col("n_chars") < q).alias("below"), share(F.col("n_chars") <= q).alias("upto")) for q in near)).alias("r"))
    slack = 2 * RANK_ERROR
    close = [(F.col("r")[i]["below"] <= p + slack) & (F.col("r")[i]["upto"] >= p - slack) for i, p in enumerate((0.1, 0.5, 0.9))]
    exact = docs.agg(*(F.count_distinct(c).alias(c) for c in ("n_chars", "text", "source")))
    truth = exact.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in ("n_chars", "text", "source")))))
    quantiles = ranks.select(F.lit("n_chars").alias("column"), (close[0] & close[1] & close[2]).alias("quantiles_are_close"))
    off = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * DISTINCT_ERROR * F.col("exact"))
    return found.join(truth, "column").join(quantiles, "column", "left").select(
        "column", "n", "n_null", off.alias("distinct_is_close"), "quantiles_are_close")


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1 HAVING count(*) > 1")
def unique_key_violations(spark, sf_dir):
    return profiling.unique_key_violations(s.table(spark, sf_dir, "conversations"), ["conv_id"])


@query(" UNION ALL ".join(
    f"SELECT 'given' AS table_schema, '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_inventory(spark, sf_dir):
    return catalog.count_tables({("given", t): s.table(spark, sf_dir, t) for t in TABLES})


_DOCUMENT_CONTRACT = T.StructType([
    T.StructField("doc_id", T.LongType(), False), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("text", T.StringType())])


@query("""
SELECT coalesce(nullif(concat_ws('; ', CASE WHEN length(lang) > 2 THEN 'lang is too long' END,
       CASE WHEN length(text) > 2000 THEN 'text is too long' END), ''), 'accepted') AS outcome, count(*) AS n,
       sum(length(text))::BIGINT AS chars FROM documents GROUP BY 1""")
def contract_check(spark, sf_dir):
    accepted, rejected = contract.conform(s.table(spark, sf_dir, "documents"), _DOCUMENT_CONTRACT,
                                          {"lang": 2, "text": 2000})
    both = accepted.select(F.lit("accepted").alias("outcome"), "text").unionByName(
        rejected.select(F.col("reject_reason").alias("outcome"), "text"))
    return both.groupBy("outcome").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query(f"""
WITH {s.SQL_LABELLED}
SELECT CAST(email_id AS VARCHAR) AS email_id, 's' || subject AS sender, sender_dept, recipient_dept, compliance_label, sent_at,
       nullif(CASE WHEN recipient_dept = 'en' THEN sender_dept ELSE '' END, '') AS cc, md5(body) AS body_digest
FROM labelled""")
def csv_round_trip(spark, sf_dir):
    """Ordered CSV export and typed import; texts hold quotes, commas and line breaks."""
    messages = s.labelled(spark, sf_dir).select(
        F.col("email_id").cast("string").alias("email_id"), F.concat(F.lit("s"), F.col("subject")).alias("sender"),
        F.col("subject").alias("recipient"), F.when(F.col("recipient_dept") == "en", F.col("sender_dept")).alias("cc"),
        "subject", "body", "sent_at", "sender_dept", "recipient_dept", "compliance_label")
    path = scratch_path(spark, "export")
    sinks.export_csv(messages, path, ["sent_at", "email_id"])
    loaded = files.read_messages(spark, path).accepted
    return loaded.select("email_id", "sender", "sender_dept", "recipient_dept", "compliance_label", "sent_at", "cc",
                         F.md5("body").alias("body_digest"))


@query(f"""
WITH {s.SQL_LABELLED}
SELECT count(*) AS total_examples, count(*) FILTER (compliance_label <> 'CLEAN') AS violation_examples,
       count(*) FILTER (compliance_label = 'CLEAN') AS clean_examples FROM labelled""")
def pair_stats(spark, sf_dir):
    """Prompt/completion lines read back from JSON and profiled."""
    label = F.col("compliance_label")
    pairs = s.labelled(spark, sf_dir).select(
        F.col("body").alias("prompt"),
        F.when(label == "CLEAN", label).otherwise(F.concat(F.lit("VIOLATION: "), label)).alias("completion"))
    path = scratch_path(spark, "pairs")
    pairs.write.json(path)
    return evaluation.pair_stats(files.read_pairs(spark, path).accepted)


@query(f"""
WITH {s.SQL_LABELLED}
SELECT email_id, md5('Review one message for compliance.' || chr(10) || 'Possible categories: {", ".join(CATEGORIES)}.' || chr(10)
       || 'From: ' || sender_dept || chr(10) || 'To: ' || recipient_dept || chr(10) || 'Subject: ' || subject || chr(10)
       || 'Body: ' || body || chr(10)
       || 'Answer with one JSON object: is_violation, confidence (0 to 1), category, reasoning.') AS prompt_digest,
       '{{"is_violation":' || (compliance_label <> 'CLEAN')::VARCHAR || ',"confidence":1.0,"category":"' || compliance_label
       || '","reasoning":"labelled as ' || compliance_label || '"}}' AS completion FROM labelled""")
def build_pairs(spark, sf_dir):
    """Training pairs: prompt of a message, JSON answer from its label."""
    return enrichment.build_pairs(s.labelled(spark, sf_dir)).select(
        "email_id", F.md5("prompt").alias("prompt_digest"), "completion")


@query("""
SELECT CASE WHEN doc_id % 5 = 0 THEN 'not JSON' WHEN doc_id % 5 = 1 THEN 'completion is missing' ELSE 'accepted' END AS outcome,
       count(*) AS n FROM documents GROUP BY 1""")
def pair_rejects(spark, sf_dir):
    """Pairs as JSON lines, some of them broken: both sides of the scan."""
    path, kind = scratch_path(spark, "pairs"), F.col("doc_id") % 5
    whole = F.to_json(F.struct(F.col("source").alias("prompt"), F.when(kind != 1, F.col("lang")).alias("completion")))
    s.table(spark, sf_dir, "documents").select(F.when(kind == 0, F.concat(F.lit("{"), "source")).otherwise(whole)).write.text(path)
    accepted, rejected = files.read_pairs(spark, path)
    return accepted.select(F.lit("accepted").alias("outcome")).unionByName(
        rejected.select(F.col("reject_reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, date_trunc('second', ts) AS again,
       string_split(event_type || ' by ' || user_id::VARCHAR, ' ')[1] AS word FROM events""")
def iso_times(spark, sf_dir):
    """ISO texts of times, read back, and the first word of a text."""
    events = s.table(spark, sf_dir, "events").withColumn("iso", timestamp_to_iso(F.col("ts")))
    named = F.concat("event_type", F.lit(" by "), F.col("user_id").cast("string"))
    return events.select("event_id", "iso", iso_to_timestamp(F.col("iso")).alias("again"), first_token(named).alias("word"))


@query("""
SELECT 2 * count(*) AS n, 2 * count(*) AS n_keys, 2 * sum(length(source))::BIGINT AS chars, 0::BIGINT AS n_without_time
FROM documents""")
def append_rows(spark, sf_dir):
    """Two appends with a generated key and a load time, seen through a view."""
    target = scratch_path(spark, "appended")
    schema = T.StructType([T.StructField("doc_id", T.LongType(), False), T.StructField("source", T.StringType())])
    for _ in range(2):
        sinks.append_conformed(s.table(spark, sf_dir, "documents").select("doc_id", "source"), target, schema, identity="row_id")
    sinks.create_view(spark.read.parquet(target), "appended_rows")
    return spark.table("appended_rows").agg(
        F.count("*").alias("n"), F.countDistinct("row_id").alias("n_keys"), F.sum(F.length("source")).alias("chars"),
        F.count_if(F.col("loaded_at").isNull()).alias("n_without_time"))


@query("SELECT count(*) AS rows_in, 0::BIGINT AS late, count(DISTINCT user_id || event_type || ts::VARCHAR) AS stored FROM events")
def stream_report(spark, sf_dir):
    """The report of a stream whose delay covers all: rows read and late, beside what is stored."""
    out, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "checkpoint")
    report = refresh.append_refresh(_event_stream(spark, sf_dir), lambda df: df.select("user_id", "event_type", "ts"), out,
                                    checkpoint, ["user_id", "event_type", "ts"], "ts", "60 days",
                                    spark.sparkContext.defaultParallelism)
    return spark.read.parquet(out).agg(F.lit(report.rows_in).cast("long").alias("rows_in"),
                                       F.lit(report.rows_dropped_late).cast("long").alias("late"), F.count("*").alias("stored"))


@query(f"WITH {s.SQL_DOCUMENTS}, {_bm25()} {_ranked('bm25', 20)}")
def index_bulk_then_stream(spark, sf_dir):
    """Half of the messages in bulk, the whole table by a stream after it: each counts once."""
    index = SearchIndex(scratch_path(spark, "search"), "messages", "email_id", "body", "subject", ["sender_dept"], buckets=8)
    index.refresh(s.documents(spark, sf_dir).filter("email_id % 2 = 0"), 0)
    refresh.refresh_index(_document_stream(spark, sf_dir), index, scratch_path(spark, "checkpoint"), "sent_at",
                          "365 days", spark.sparkContext.defaultParallelism)
    return index.lexical_search(spark, QUERY_TEXT, 20)


@query("""
WITH newest AS (SELECT user_id, ts, max(value) AS value FROM events GROUP BY 1, 2)
SELECT e.event_id, e.user_id, f.value AS asof_value FROM events e
ASOF LEFT JOIN newest f ON e.user_id = f.user_id AND e.ts >= f.ts""")
def as_of(spark, sf_dir):
    """Every event with the value that its user had last, of any type of event."""
    events = s.table(spark, sf_dir, "events")
    return as_of_lookup(events.select("event_id", "user_id", "ts"), events.select("user_id", "ts", "value"),
                        "user_id", "ts", ["value"]).drop("ts")


@query(f"""
WITH {s.SQL_FEATURES}
SELECT email_id, sent_at AS ts, {", ".join(f"round({c}, 6) AS {c}" for c in s.CONCEPTS)}, cross_barrier_flag, is_violation FROM features""")
def feature_view(spark, sf_dir):
    """Register a feature view version, then load it by name and version."""
    registry = FeatureRegistry(scratch_path(spark, "registry"))
    view = FeatureView("message_features", "message", ["email_id"], "ts",
                       description="semantic scores", column_descriptions={"mnpi_risk_score": "similarity to tips"})
    registry.register(view, features.feature_view_columns(s.message_features(spark, sf_dir)), "V1")
    loaded = registry.load(spark, "message_features", "V1")
    return loaded.withColumns({c: F.round(c, 6) for c in s.CONCEPTS})


#: Where the session's models of each data folder are: one training serves all queries about it.
_MODELS: dict[tuple[str, str], tuple[ModelRegistry, Retrained]] = {}


def _trained(spark, sf_dir):
    registry_root = scratch_path(spark, "registry")
    features_root = FeatureRegistry(registry_root)
    view = FeatureView("message_features", "message", ["email_id"], "ts")
    features_root.register(view, features.feature_view_columns(s.message_features(spark, sf_dir)), "V1")
    models = ModelRegistry(registry_root)
    result = retrain(features_root.load(spark, "message_features", "V1"), models, "classifier", "V1")
    _MODELS[spark.sparkContext.applicationId, sf_dir] = models, result
    return models, result


def _retrained(spark, sf_dir):
    return _MODELS.get((spark.sparkContext.applicationId, sf_dir)) or _trained(spark, sf_dir)


_SIDES = """WITH sided AS (
  SELECT doc_id, toxic, text, CASE WHEN ('0x' || substr(md5('42:' || doc_id::VARCHAR), 1, 8))::BIGINT % 10000 < 8000
                                   THEN 'train' ELSE 'test' END AS split FROM labels JOIN documents USING (doc_id))"""


@query()
def train_score(spark, sf_dir):
    """Train, register, score every row, decide: the distribution of decisions, whose trees SQL does not have."""
    return _trained(spark, sf_dir)[1].distribution


@query(_SIDES + """
SELECT split, count(*) AS n, count(*) AS n_scored, 0::BIGINT AS n_outside, 0::BIGINT AS n_other_class FROM sided GROUP BY 1""")
def scored_sides(spark, sf_dir):
    """Per side of the split: rows, probabilities, and classes that do not fit them."""
    chance = F.col("predict_proba_1")
    return _retrained(spark, sf_dir)[1].predictions.groupBy("split").agg(
        F.count("*").alias("n"), F.count("predict_proba_1").alias("n_scored"),
        F.count_if(~chance.between(0.0, 1.0)).alias("n_outside"),
        F.count_if((F.col("predicted_violation") == 1) != (chance > 0.5)).alias("n_other_class"))


@query()
def held_out_quality(spark, sf_dir):
    """Confusion and quality on the side of the split that the model has not seen."""
    return classifier.evaluate(_retrained(spark, sf_dir)[1].predictions.filter("split = 'test'"))


def _separable(spark, sf_dir):
    """A target that one of two features decides."""
    long = (F.length("text") > 1500).cast("int")
    return s.table(spark, sf_dir, "documents").select(
        "doc_id", (long * 2.0 - 1.0).alias("decides"), (F.col("doc_id") % 7).cast("double").alias("noise"), long.alias("target"))


@query(_SIDES.replace("labels JOIN documents USING (doc_id)", "documents").replace("toxic, ", "") + """,
counts AS (SELECT count(*) AS total, count(*) FILTER (length(text) > 1500) AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn,
                  count(*) FILTER (length(text) <= 1500) AS tn FROM sided WHERE split = 'test')
SELECT *, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, 1.0::DOUBLE AS accuracy FROM counts""")
def held_out_separable(spark, sf_dir):
    """Quality on the unseen side where the target can be learnt: no error is allowed."""
    rows = classifier.hash_split(_separable(spark, sf_dir), "doc_id")
    model = classifier.train(rows.filter("split = 'train'"), ["decides", "noise"], "target", n_trees=20)
    return classifier.evaluate(classifier.score(model, rows.filter("split = 'test'")), "target")


@query("""SELECT doc_id, CASE WHEN length(text) > 1500 THEN 1 ELSE 0 END AS predicted FROM documents""")
def train_separable(spark, sf_dir):
    """A target that one feature decides is learnt without an error."""
    rows = _separable(spark, sf_dir)
    model = classifier.train(rows, ["decides", "noise"], "target", n_trees=20)
    return classifier.score(model, rows).select("doc_id", F.col("predicted_violation").alias("predicted"))


@query("SELECT 'V1' AS version, count(*) AS n, 0::BIGINT AS n_different FROM documents JOIN labels USING (doc_id)")
def model_registry(spark, sf_dir):
    """The stored model scores as the trained one did; rows that differ, by version."""
    models, result = _retrained(spark, sf_dir)
    again = classifier.score(models.load("classifier", "V1"), result.predictions.select("email_id", *s.FEATURES))
    both = again.join(result.predictions.select("email_id", F.col("predict_proba_1").alias("first")), "email_id")
    return both.agg(F.lit("V1").alias("version"), F.count("*").alias("n"),
                    F.count_if(F.abs(F.col("predict_proba_1") - F.col("first")) > 1e-12).alias("n_different"))


@query()
def model_metrics(spark, sf_dir):
    """All metrics of the registered model versions."""
    return _retrained(spark, sf_dir)[0].metrics(spark)


_CURVE = f"""WITH {s.SQL_PREDICTIONS},
counted AS (
  SELECT round(violation_probability, 2) AS threshold, count(*) AS n, count(*) FILTER (is_violation = 1) AS p FROM predictions GROUP BY 1),
sums AS (
  SELECT threshold, n, p, sum(p) OVER down AS tp, sum(n - p) OVER down AS fp, sum(p) OVER () AS ps, sum(n - p) OVER () AS ns
  FROM counted WINDOW down AS (ORDER BY threshold DESC)),
curve AS (
  SELECT *, {s.sql_ratio("tp", "tp + fp")} AS precision, {s.sql_ratio("tp", "ps")} AS recall FROM sums),
scored_curve AS (SELECT *, {s.sql_ratio("2 * precision * recall", "precision + recall")} AS f1 FROM curve)"""


def _curve(spark, sf_dir):
    scored = s.predictions(spark, sf_dir).withColumn("score", F.round("violation_probability", 2))
    return scored, thresholds.threshold_curve(scored, "score")


@query(_CURVE + """
SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, (ps - tp)::BIGINT AS fn, (ns - fp)::BIGINT AS tn,
       round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM scored_curve""")
def threshold_curve(spark, sf_dir):
    """Quality at every threshold."""
    return _curve(spark, sf_dir)[1].select("threshold", "tp", "fp", "fn", "tn", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


@query(_CURVE + f"""
SELECT sum(n)::BIGINT AS total, sum(p)::BIGINT AS positives, round({s.sql_ratio("sum(p * precision)", "sum(p)")}, 9) AS average_precision,
       round({s.sql_ratio("sum((n - p) * (tp - p / 2.0::DOUBLE))", "sum(p)::DOUBLE * sum(n - p)")}, 9) AS area_under_roc,
       arg_max(threshold, round(f1, 12) * 1000 + threshold / 1000000) AS best_threshold, round(max(f1), 9) AS best_f1 FROM scored_curve""")
def curve_summary(spark, sf_dir):
    """Areas under the curves and the best threshold."""
    found = thresholds.curve_summary(_curve(spark, sf_dir)[1])
    return found.withColumns({c: F.round(c, 9) for c in ("average_precision", "area_under_roc", "best_f1")})


@query(f"""WITH {s.SQL_PREDICTIONS}
SELECT least(floor(violation_probability * 10), 9)::INTEGER AS bin, count(*) AS n, round(avg(violation_probability), 6) AS mean_score,
       round(avg(CASE WHEN is_violation = 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS violation_rate FROM predictions GROUP BY 1""")
def calibration(spark, sf_dir):
    """Mean score and violation rate of each tenth of the scores."""
    found = thresholds.calibration(s.predictions(spark, sf_dir), "violation_probability")
    return found.withColumns({c: F.round(c, 6) for c in ("mean_score", "violation_rate")})


def _table_stream(spark, sf_dir, name):
    """A table as a stream. The pattern finds it as one file and as a folder of files."""
    return refresh.parquet_stream(spark, f"{sf_dir}/{{{name}.parquet}}", s.table(spark, sf_dir, name).schema)


def _event_stream(spark, sf_dir):
    return _table_stream(spark, sf_dir, "events")


@query("SELECT user_id, event_type, count(DISTINCT ts)::BIGINT AS n FROM events GROUP BY 1, 2")
def stream_first_of_each(spark, sf_dir):
    """Events as a stream in which each comes twice, kept once, appended; the second run adds nothing."""
    out, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        twice = _event_stream(spark, sf_dir).withColumn("again", F.explode(F.array(F.lit(0), F.lit(1))))
        refresh.append_refresh(twice, lambda df: df.select("user_id", "event_type", "ts"),
                               out, checkpoint, ["user_id", "event_type", "ts"], "ts", "60 days",
                               spark.sparkContext.defaultParallelism)
    return spark.read.parquet(out).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


def _document_stream(spark, sf_dir):
    return s.as_messages(_table_stream(spark, sf_dir, "documents"))


def _stream_triage(df):
    scored = features.concept_features(df, F.concat("subject", F.lit(" "), "body"), s.CONCEPTS)
    scored = scored.withColumn("predict_proba_1", F.round(logistic_score(list(s.CONCEPTS), s.WEIGHTS[:-1], s.BIAS), 9))
    decided = triage.decide(scored)
    return decided.select("email_id", "sent_at", "violation_probability", "ml_decision",
                          route(F.col("ml_decision")).alias("pipeline_action"))


_STREAM_LINEAR = " + ".join(f"({w}::DOUBLE) * {c}" for c, w in zip(s.CONCEPTS, s.WEIGHTS))


@query(f"""
WITH {s.SQL_ALL_FEATURES},
scored AS (SELECT email_id, round(1.0 / (1.0 + exp(-({s.BIAS}::DOUBLE + {_STREAM_LINEAR}))), 9) AS p FROM features)
SELECT email_id, round(p, 6) AS violation_probability,
       CASE WHEN p >= 0.7 THEN 'HIGH_RISK' WHEN p <= 0.3 THEN 'LOW_RISK' ELSE 'NEEDS_REVIEW' END AS ml_decision,
       CASE WHEN p >= 0.7 THEN 'AUTO_ESCALATE' WHEN p <= 0.3 THEN 'AUTO_CLEAR' ELSE 'LLM_ANALYSIS' END AS pipeline_action
FROM scored""")
def stream_triage(spark, sf_dir):
    """Incoming messages: features, probability, decision and route, as a stream."""
    out, checkpoint = scratch_path(spark, "triage"), scratch_path(spark, "checkpoint")
    refresh.append_refresh(_document_stream(spark, sf_dir), _stream_triage, out, checkpoint, ["email_id"], "sent_at",
                           "365 days", spark.sparkContext.defaultParallelism)
    return spark.read.parquet(out).drop("sent_at").withColumn("violation_probability", F.round("violation_probability", 6))


@query(f"""
WITH {s.SQL_ALL_FEATURES}
SELECT email_id, {", ".join(f"round({c}, 6) AS {c}" for c in s.CONCEPTS)} FROM features""")
def stream_features(spark, sf_dir):
    """The feature table kept up to date from a stream."""
    def compute(df):
        found = features.concept_features(df, F.concat("subject", F.lit(" "), "body"), s.CONCEPTS)
        return found.select("email_id", "sent_at", *s.CONCEPTS)

    out, checkpoint = scratch_path(spark, "features"), scratch_path(spark, "checkpoint")
    refresh.append_refresh(_document_stream(spark, sf_dir), compute, out, checkpoint, ["email_id"], "sent_at",
                           "365 days", spark.sparkContext.defaultParallelism)
    return spark.read.parquet(out).drop("sent_at").withColumns({c: F.round(c, 6) for c in s.CONCEPTS})


@query(f"""
WITH {s.SQL_ALL_FEATURES}
SELECT email_id, {", ".join(f"round({c}, 6) AS {c}" for c in s.CONCEPTS)}, 1::BIGINT AS version FROM features""")
def stream_feature_changes(spark, sf_dir):
    """Each message comes twice, the second time with its body: the features are those of the later one."""
    def compute(df):
        found = features.concept_features(df, F.concat("subject", F.lit(" "), "body"), s.CONCEPTS)
        return found.select("email_id", "sent_at", "version", *s.CONCEPTS)

    twice = _document_stream(spark, sf_dir).withColumn("version", F.explode(F.array(*(F.lit(v).cast("long") for v in (1, 0)))))
    twice = twice.withColumns({"body": F.when(F.col("version") == 1, F.col("body")).otherwise(F.col("subject")),
                               "sent_at": F.col("sent_at") + F.make_dt_interval(mins=F.col("version").cast("int"))})
    table = KeyedTable(scratch_path(spark, "features"), ["email_id"], "sent_at", buckets=8)
    follow(twice, compute, table, scratch_path(spark, "checkpoint"))
    return table.rows(spark).drop("sent_at").withColumns({c: F.round(c, 6) for c in s.CONCEPTS})


@query(f"WITH {s.SQL_DOCUMENTS}, {_bm25()} {_ranked('bm25', 20)}")
def stream_index_search(spark, sf_dir):
    """A search over an index that a stream keeps up to date."""
    index = SearchIndex(scratch_path(spark, "search"), "messages", "email_id", "body", "subject", ["sender_dept"],
                        buckets=8)
    refresh.refresh_index(_document_stream(spark, sf_dir), index, scratch_path(spark, "checkpoint"), "sent_at",
                          "365 days", spark.sparkContext.defaultParallelism)
    return index.lexical_search(spark, QUERY_TEXT, 20)
