"""Structured enrichment of the uncertain bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierwatch.constants import (
    CATEGORIES, CLEAN, NEEDS_REVIEW, SEARCH_PREVIEW_CHARS, VIOLATION_CATEGORIES,
)
from tierwatch.functions.text import contains_any, fill_template, preview, route_label
from tierwatch.sources.schemas import ANALYSIS
from tierwatch.sources.task_files import append_file, qualified, read_files

# A completer gets some prompts and returns one answer per prompt.
Completer = Callable[[list[str]], Sequence[str]]

#: Prompts of one call, whose answers are stored together.
CALL_ROWS = 256

# What the categories stand for, in the words of this library.
CATEGORY_MEANINGS = (
    "Insider trading: trading on, or passing on, facts that the market does not know. "
    "Confidentiality breach: handing protected data to someone who must not have it. "
    "Personal trading: private deals that had to be approved first. "
    "Information barrier: contact between groups that must stay apart. Clean: none of these."
)
REVIEW_TEMPLATE = (
    "Review one message for compliance. The classifier is unsure (probability {probability}).\n"
    "Possible categories: {categories}.\n" + CATEGORY_MEANINGS + "\n"
    "From: {sender_dept}\nTo: {recipient_dept}\nSubject: {subject}\nBody: {body}\n"
    "Answer with one JSON object: is_violation, confidence (0 to 1), category, reasoning."
)


def uncertain(predictions: DataFrame, messages: DataFrame, key: str = "email_id",
              decision: str = NEEDS_REVIEW) -> DataFrame:
    """The rows of one bucket with their text.

    The bucket is filtered before the join, so that only its keys meet the message
    table, and before any completion, which no optimiser rule could do later.
    """
    gate = predictions.filter(F.col("ml_decision") == decision).select(
        key, "ml_decision", "violation_probability")
    texts = messages.select(key, F.col("compliance_label").alias("actual_label"),
                            "sender_dept", "recipient_dept", "subject", "body")
    return gate.join(texts, key)


def review_prompt(template: str = REVIEW_TEMPLATE, body_chars: int | None = None) -> Column:
    """The prompt of an uncertain row; null when one of its parts is null.

    The whole body goes in unless ``body_chars`` sets a limit, as a model with a short
    context may need.
    """
    return fill_template(template, {
        "probability": F.round("violation_probability", 2),
        "categories": F.lit(", ".join(CATEGORIES)),
        "sender_dept": F.col("sender_dept"),
        "recipient_dept": F.col("recipient_dept"),
        "subject": F.col("subject"),
        "body": F.col("body") if body_chars is None else preview(F.col("body"), body_chars),
    })


PAIR_TEMPLATE = (
    "Review one message for compliance.\nPossible categories: {categories}.\n"
    "From: {sender_dept}\nTo: {recipient_dept}\nSubject: {subject}\nBody: {body}\n"
    "Answer with one JSON object: is_violation, confidence (0 to 1), category, reasoning."
)


def build_pairs(messages: DataFrame, key: str = "email_id", label: str = "compliance_label", clean: str = CLEAN,
                template: str = PAIR_TEMPLATE) -> DataFrame:
    """``(key, prompt, completion)`` for training: the prompt of a message and the answer that its label gives.

    Messages without a label or with a missing part teach nothing and are left out.
    """
    columns = ("sender_dept", "recipient_dept", "subject", "body")
    values = {"categories": F.lit(", ".join(CATEGORIES)), **{c: F.col(c) for c in columns}}
    answer = F.to_json(F.struct(
        (F.col(label) != clean).alias("is_violation"), F.lit(1.0).alias("confidence"), F.col(label).alias("category"),
        F.concat(F.lit("labelled as "), F.col(label)).alias("reasoning")))
    pairs = messages.filter(F.col(label).isNotNull()).select(
        key, fill_template(template, values).alias("prompt"), answer.alias("completion"))
    return pairs.filter(F.col("prompt").isNotNull())


def phrase_answer(text: Column, probability: Column, phrases: Sequence[str],
                  category: str = VIOLATION_CATEGORIES[0]) -> Column:
    """Deterministic stand-in for a completion: a JSON answer from a phrase search."""
    hit = F.coalesce(contains_any(text, phrases), F.lit(False))
    return F.to_json(F.struct(
        hit.alias("is_violation"),
        F.round(probability, 3).alias("confidence"),
        F.when(hit, category).otherwise(CLEAN).alias("category"),
        F.when(hit, "a listed phrase occurs").otherwise("no listed phrase occurs").alias("reasoning"),
    ))


def complete(df: DataFrame, key: str, prompt: str, completer: Completer,
             into: str = "answer", tasks: int | None = None) -> DataFrame:
    """``(key, answer)`` from a caller-supplied completer, one call per Arrow batch.

    ``tasks`` spreads the rows by key, which bounds the calls in flight and evens out a
    bucket that sits in few partitions. A null prompt gives a null answer without a call.
    Store the result before using it: evaluating it again would ask again.
    """
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prompts = batch.column(1).to_pylist()
            asked = [i for i, p in enumerate(prompts) if p is not None]
            got = completer([prompts[i] for i in asked]) if asked else []
            answers: list[str | None] = [None] * len(prompts)
            for i, text in zip(asked, got, strict=True):
                answers[i] = text
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(answers, pa.string())], [key, into])

    narrow = df.select(key, prompt)
    if tasks:
        narrow = narrow.repartition(tasks, key)
    schema = T.StructType([narrow.schema[key], T.StructField(into, T.StringType())])
    return narrow.mapInArrow(answer, schema)


def _attempts(spark: SparkSession, store: str) -> DataFrame | None:
    try:
        return spark.read.parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest_answers(spark: SparkSession, store: str, key: str, answer: str = "answer") -> DataFrame:
    """``(key, answer)`` of the last attempt for each key of a store."""
    last = F.max_by(F.struct(answer), F.struct("attempt", F.col(answer).isNotNull(), answer))
    return spark.read.parquet(store).groupBy(key).agg(last.alias("_last")).select(key, f"_last.{answer}")


def _usable(answer: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: parse_analysis(rows, answer).accepted


def unanswered(df: DataFrame, key: str, store: str, answer: str = "answer",
               usable: Callable[[DataFrame], DataFrame] | None = None, max_attempts: int | None = None) -> DataFrame:
    """Rows whose key has no usable answer yet. Apply it before texts are joined in.

    ``usable`` keeps the stored rows that need not be asked again; by default those that
    ``parse_analysis`` accepts. A null answer is never usable. With ``max_attempts``, keys that were
    asked so often are given up; ``attempt_report`` names them.
    """
    stored = _attempts(df.sparkSession, store)
    if stored is None:
        return df
    done = (usable or _usable(answer))(stored.filter(F.col(answer).isNotNull())).select(key)
    if max_attempts is not None:
        asked = stored.groupBy(key).agg(F.countDistinct("attempt").alias("_attempts"))
        done = done.union(asked.filter(F.col("_attempts") >= max_attempts).select(key))
    return df.join(done.distinct(), key, "left_anti")


def attempt_report(spark: SparkSession, store: str, key: str, answer: str = "answer",
                   usable: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``(key, attempts, reason)``: how often each key was asked, and what is wrong with its last answer; null if a usable one is there."""
    stored = spark.read.parquet(store)
    good = (usable or _usable(answer))(stored.filter(F.col(answer).isNotNull())).select(key).distinct().withColumn("_good", F.lit(True))
    last = F.max_by(F.col(answer).isNull(), F.struct("attempt", F.col(answer).isNotNull()))
    counted = stored.groupBy(key).agg(F.countDistinct("attempt").alias("attempts"), last.alias("_none"))
    reason = F.when(F.col("_good"), F.lit(None)).when(F.col("_none"), "no answer").otherwise("unusable answer")
    return counted.join(good, key, "left").select(key, "attempts", reason.alias("reason"))


def ask(df: DataFrame, key: str, prompt: str, completer: Completer, store: str, tasks: int | None = None,
        call_rows: int = CALL_ROWS) -> int:
    """Append the answers for all rows with a prompt to a store, under the next attempt number; how many were asked.

    A task adds the answers of each call to the store before the next call, so a job that dies leaves what was
    answered until then. A task that is tried again does not ask for what its first try has stored.
    The store must be a folder that driver and executors share.
    """
    spark = df.sparkSession
    stored = _attempts(spark, store)
    last = stored.agg(F.max("attempt")).first()[0] if stored is not None else None
    folder = f"{store.rstrip('/')}/attempt={(last or 0) + 1}"
    narrow = df.filter(F.col(prompt).isNotNull()).select(key, prompt)
    if tasks:
        narrow = narrow.repartition(tasks, key)
    # The folder and its columns, also if there is nothing to ask.
    spark.createDataFrame([], T.StructType([narrow.schema[key], T.StructField("answer", T.StringType())])).coalesce(1).write.mode("append").parquet(folder)
    target = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = f"part-{TaskContext.get().partitionId()}-of-"
        before = {k for t in read_files(target, mine) for k in t.column(0).to_pylist()}
        for batch in batches:
            keys, prompts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            todo = [i for i, k in enumerate(keys) if k not in before]
            for a in range(0, len(todo), call_rows):
                some = todo[a:a + call_rows]
                answers = [text for _, text in zip(some, completer([prompts[i] for i in some]), strict=True)]
                append_file(target, mine, pa.table({key: batch.column(0).take(pa.array(some)), "answer": pa.array(answers, pa.string())}))
            yield pa.RecordBatch.from_arrays([pa.array([len(todo)])], names=["asked"])

    return narrow.mapInArrow(run, "asked long").agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]


def complete_missing(keys: DataFrame, key: str, prompts: Callable[[DataFrame], DataFrame], completer: Completer,
                     store: str, tasks: int | None = None, usable: Callable[[DataFrame], DataFrame] | None = None,
                     max_attempts: int | None = None, call_rows: int = CALL_ROWS) -> DataFrame:
    """Ask for the keys without a usable answer, append what comes back, return the latest answers.

    ``prompts`` adds the column ``prompt`` to rows of ``keys``; it is called for the missing
    keys only, so texts are joined for those. A null prompt is not asked for. A failed
    job keeps the answers it has got, and running again asks only for the rest.
    """
    todo = unanswered(keys, key, store, usable=usable, max_attempts=max_attempts)
    ask(prompts(todo), key, "prompt", completer, store, tasks, call_rows)
    return latest_answers(keys.sparkSession, store, key)


class Parsed(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def parse_structured(df: DataFrame, answer: str, schema: T.StructType, into: str,
                     valid: Column | None = None) -> Parsed:
    """Parse a JSON answer; every field of the schema is required and must have its type.

    ``valid`` is a further condition on the parsed column named ``into``. Rows that fail
    keep their answer on the rejected side. Give a stored answer column: a computed one
    would be worked out again for the condition and for the result.
    """
    parsed = df.withColumn(into, F.from_json(F.col(answer), schema))
    good = F.lit(True)
    for field in schema.fields:
        good = good & F.col(into)[field.name].isNotNull()
    if valid is not None:
        good = good & valid
    good = F.coalesce(good, F.lit(False))
    return Parsed(parsed.filter(good), parsed.filter(~good).drop(into))


def parse_analysis(df: DataFrame, answer: str = "answer", into: str = "analysis",
                   categories: Sequence[str] = CATEGORIES) -> Parsed:
    """Parse an analysis: known category and a confidence from 0 to 1."""
    fields = F.col(into)
    valid = fields["category"].isin(*categories) & fields["confidence"].between(0.0, 1.0)
    return parse_structured(df, answer, ANALYSIS, into, valid)


def analysis_report(analysed: DataFrame, key: str = "email_id",
                    chars: int = SEARCH_PREVIEW_CHARS) -> DataFrame:
    """Read-out of analysed rows: route, subject, cut body, label and answer."""
    return analysed.select(
        key, "actual_label",
        route_label(F.col("sender_dept"), F.col("recipient_dept")).alias("communication"),
        "subject", preview(F.col("body"), chars).alias("body_preview"), "analysis")
