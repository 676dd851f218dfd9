import math
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tierwatch.constants import CONCEPTS, EMBEDDING_DIM
from tierwatch.functions import decisions, ratios, text
from tierwatch.functions.embedding import HashedWords, embed, embed_literal, similarities, term_counts, unit_rows, word_counts
from tierwatch.functions.once import with_once
from tierwatch.functions.vectors import cosine, cosine_to, has_length
from tierwatch.operators.features import concept_features
from tierwatch.operators.vector_search import build_vectors


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_contains_any_is_a_plain_search(spark):
    rows = [(1, None), (2, "line one\nThis is CONFIDENTIAL"), (3, "multiple"), (4, "nothing"), (5, "a.b")]
    df = spark.createDataFrame(rows, "id int, t string")
    found = df.select("id", text.contains_any(F.col("t"), ["confidential", "tip"]).alias("hit")).orderBy("id")
    assert values(found, "hit") == [(None,), (True,), (True,), (False,), (False,)]
    # A phrase is text, not a pattern, on both ways of searching.
    for phrases in (["a.b", "x|y"], ["a.b"] + [f"word{i}" for i in range(100)]):
        hits = df.filter(text.contains_any(F.col("t"), phrases)).select("id")
        assert values(hits, "id") == [(5,)]
    with pytest.raises(ValueError):
        text.contains_any(F.col("t"), [])


def test_message_text_nulls(spark):
    df = spark.createDataFrame([("s", "body"), (None, "body"), ("s", None)], "s string, b string")
    strict = df.select(text.message_text(F.col("s"), F.col("b")).alias("t"))
    loose = df.select(text.message_text(F.col("s"), F.col("b"), skip_nulls=True).alias("t"))
    cut = df.select(text.message_text(F.col("s"), F.col("b"), 2).alias("t"))
    assert values(strict, "t") == [("s body",), (None,), (None,)]
    assert values(loose, "t") == [("s body",), ("body",), ("s",)]
    assert values(cut, "t")[0] == ("s bo",)


def test_template_and_small_text_helpers(spark):
    df = spark.createDataFrame([("Ann Lee", "it's {x}", None)], "name string, body string, gone string")
    row = df.select(
        text.fill_template("Hi {who}: {body}!", {"who": text.first_token(F.col("name")), "body": F.col("body")}).alias("a"),
        text.fill_template("Hi {who}", {"who": F.col("gone")}).alias("b"),
        text.route_label(F.lit("Research"), F.lit("Trading")).alias("c"),
        text.iso_to_timestamp(F.lit("2024-05-06T07:08:09")).alias("d"),
        text.iso_to_timestamp(F.lit("soon")).alias("e"),
        text.timestamp_to_iso(F.lit(datetime(2024, 5, 6, 7, 8, 9)).cast("timestamp_ntz")).alias("f"),
    ).first()
    assert tuple(row) == ("Hi Ann: it's {x}!", None, "Research -> Trading", datetime(2024, 5, 6, 7, 8, 9), None,
                          "2024-05-06T07:08:09")


def test_three_way_borders_and_null(spark):
    rows = [(0.3,), (0.2999999,), (0.30001,), (0.5,), (0.6999,), (0.7,), (None,)]
    df = spark.createDataFrame(rows, "p double").withColumn("d", decisions.three_way(F.col("p")))
    assert [r["d"] for r in df.collect()] == [
        "LOW_RISK", "LOW_RISK", "NEEDS_REVIEW", "NEEDS_REVIEW", "NEEDS_REVIEW", "HIGH_RISK", "NEEDS_REVIEW"]


def test_routes(spark):
    df = spark.createDataFrame([("HIGH_RISK",), ("NEEDS_REVIEW",), ("LOW_RISK",), (None,)], "d string")
    assert [r[0] for r in df.select(decisions.route(F.col("d"))).collect()] == [
        "AUTO_ESCALATE", "LLM_ANALYSIS", "AUTO_CLEAR", "AUTO_CLEAR"]


def test_cross_group_flag_and_target(spark):
    rows = [("Research", "Trading"), ("Trading", "Research"), ("Research", "Research"), (None, "Trading"), ("Legal", "Trading")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(decisions.cross_group_flag(F.col("a"), F.col("b"))).collect()] == [1, 1, 0, 0, 0]
    labels = spark.createDataFrame([("CLEAN",), ("INSIDER_TRADING",), (None,)], "l string")
    assert [r[0] for r in labels.select(decisions.violation_target(F.col("l"))).collect()] == [0, 1, 1]


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(ratios.safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.25, 0.0, 0.0]
    assert df.limit(1).select(ratios.percent(F.col("a"), F.col("b"))).first()[0] == 25.0


def test_logistic_score_checks_lengths(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "a double, b double")
    assert df.select(decisions.logistic_score(["a", "b"], [1, 2], -2)).first()[0] == pytest.approx(0.5)
    with pytest.raises(ValueError):
        decisions.logistic_score(["a"], [1, 2], 0)


def test_embedding_edge_texts(spark):
    rows = [(1, "Größe größe café"), (2, None), (3, ""), (4, "... !?"), (5, "one")]
    df = spark.createDataFrame(rows, "id int, t string")
    found = {r["id"]: r for r in df.select(
        "id", embed(F.col("t")).alias("v"), term_counts(F.col("t")).alias("terms"),
        word_counts(F.col("t"), ["größe", "absent"]).alias("c")).collect()}
    assert len(found[1]["v"]) == EMBEDDING_DIM and sum(found[1]["v"]) == 3.0
    assert found[2]["v"] is None and sum(found[3]["v"]) == 0 and sum(found[4]["v"]) == 0
    assert {(t["term"], t["tf"]) for t in found[1]["terms"]} == {("größe", 2), ("café", 1)}
    assert found[2]["terms"] == found[4]["terms"] == []
    assert tuple(found[1]["c"]) == (3, 2, 0) and tuple(found[2]["c"]) == (0, 0, 0) and tuple(found[5]["c"]) == (1, 0, 0)


def test_similarities_match_the_embedding(spark):
    df = spark.createDataFrame([(1, CONCEPTS["mnpi_risk_score"]), (2, "quarterly report"), (3, None), (4, "")], "id int, t string")
    rows = {r["id"]: r["s"] for r in df.select("id", similarities(F.col("t"), CONCEPTS).alias("s")).collect()}
    assert rows[1]["mnpi_risk_score"] == pytest.approx(1.0)
    a, b = (np.array(embed_literal(x)) for x in ("quarterly report", CONCEPTS["baseline_similarity"]))
    assert rows[2]["baseline_similarity"] == pytest.approx(a @ b / math.sqrt((a @ a) * (b @ b)))
    assert all(v is None for v in rows[3]) and all(v == 0.0 for v in rows[4])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=8))
def test_hashed_words_ignore_order_and_company(texts):
    """A vector depends on the words of its own text only, in any order."""
    model = HashedWords(32)
    together = model.encode(pa.array(texts))
    for line, t in zip(together, texts):
        alone = model.encode(pa.array([t]))[0]
        turned = model.encode(pa.array([" ".join(reversed(t.split(" ")))]))[0]
        assert (line == alone).all() and (line == turned).all()
    lengths = np.linalg.norm(unit_rows(together), axis=1)
    assert all(abs(x - 1) < 1e-12 or x == 0 for x in lengths)


def test_a_custom_embedder_is_called_once_per_row(spark):
    class Lengths:
        name, dim = "lengths", 2

        def encode(self, texts):
            return np.array([[float(len(t)), 1.0] for t in texts.to_pylist()])

    df = spark.createDataFrame([("abc",)], "t string")
    scored = with_once(df, similarities(F.col("t"), {"x": "abc", "y": ""}, Lengths()), "x", "y").filter("x > 0.5")
    row = scored.first()
    assert row["x"] == pytest.approx(1.0) and row["y"] == pytest.approx(1 / math.sqrt(10))
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_filters_after_a_costly_column_reach_the_scan(spark, tmp_path):
    """A cheap filter that is written after the call goes below it; one on its result does not repeat it."""
    rows = [(i, "merger tip" if i % 2 else None, "s", "x" if i < 3 else "y") for i in range(9)]
    spark.createDataFrame(rows, "email_id int, body string, subject string, dept string").write.parquet(str(tmp_path / "m"))
    messages = spark.read.parquet(str(tmp_path / "m"))
    named = {"mine": "merger tip"}
    for found in (concept_features(messages, F.col("body"), named).filter("dept = 'x' AND mine > 0.5"),
                  build_vectors(messages, "email_id", "subject", "body", ["dept"]).filter("dept = 'x' AND embedding IS NOT NULL")):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert text.count("ArrowEvalPython") == 1 and "EqualTo(dept,x)" in text
        assert [r["email_id"] for r in found.collect()] == [1]
    replaced = concept_features(messages.withColumn("mine", F.lit("old")), F.col("body"), named)
    assert replaced.columns == ["email_id", "body", "subject", "dept", "mine"] and dict(replaced.dtypes)["mine"] == "double"
    assert replaced.count() == 9 and replaced.filter("mine IS NULL").count() == 5


def test_cosine_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [3.0, 4.0]), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    found = df.select("id", cosine_to(F.col("v"), [1.0, 0.0]).alias("a"),
                      cosine(F.col("v"), F.array(F.lit(1.0), F.lit(0.0))).alias("b"),
                      has_length(F.col("v"), 2).alias("ok")).orderBy("id").collect()
    assert [r["a"] for r in found] == [1.0, 0.0, None, None, pytest.approx(0.6), None]
    assert [r["b"] for r in found] == [1.0, 0.0, None, None, pytest.approx(0.6), None]
    assert [r["ok"] for r in found] == [True, True, False, False, True, False]


def test_words_of_texts_are_cut_in_slices_of_few_rows_and_bytes():
    from tierwatch.functions import embedding

    texts = pa.array(["a b " * 100_000, None, "", *["word " * 1000] * 700, *["x"] * 2000])
    slices = list(embedding._slices(texts))
    assert pa.concat_arrays(slices).to_pylist() == [t or "" for t in texts.to_pylist()]
    assert max(map(len, slices)) <= 512
    assert all(len(s) == 1 or pc.sum(pc.binary_length(s)).as_py() <= 1 << 20 for s in slices)
