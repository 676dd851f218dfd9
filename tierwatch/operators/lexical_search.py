"""BM25 ranking (Robertson and Zaragoza 2009) straight from a text column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierwatch.constants import BM25_B, BM25_K1
from tierwatch.functions.embedding import token_table, word_counts
from tierwatch.operators.vector_search import Filter, equals, with_rank
from tierwatch.session import materialize


def query_terms(query: str) -> list[str]:
    """Distinct words of a query, cut as messages are."""
    return sorted(token_table(pa.array([query]))[2].to_pylist())


def idf(n_docs: Column, n_with_term: Column) -> Column:
    rest = n_docs.cast("double") - n_with_term + 0.5
    return F.log(1.0 + rest / (n_with_term + 0.5))


def term_weight(tf: Column, length: Column, mean_length: Column) -> Column:
    norm = BM25_K1 * (1.0 - BM25_B + BM25_B * length / mean_length)
    return tf * (BM25_K1 + 1.0) / (tf + norm)


def bm25_scores(df: DataFrame, key: str, text: str, query: str,
                filter_eq: Filter = None) -> DataFrame:
    """``(key, score)`` of the rows that hold a query word and pass the filter.

    Statistics are those of the whole table. Texts are cut into words once: the few
    numbers per row are stored, and both the statistics (a single row, read as a scalar
    subquery) and the scores come from them. For repeated searches build a ``SearchIndex``.
    """
    terms = query_terms(query)
    if not terms:
        return df.select(key, F.lit(0.0).alias("score")).filter(F.lit(False))
    counted = df.filter(F.col(text).isNotNull()).select(
        key, equals(filter_eq).alias("_kept"), word_counts(F.col(text), terms).alias("_c"))
    return counted_scores(materialize(counted.select(key, "_kept", "_c.*"), "word-counts"), key, terms)


def counted_scores(counted: DataFrame, key: str, terms: Sequence[str]) -> DataFrame:
    """Scores from stored word counts: ``key, _kept, length, tf_0, tf_1, ...`` of all rows with a text."""
    if not terms:
        return counted.select(key, F.lit(0.0).alias("score")).filter(F.lit(False))
    names = [f"tf_{i}" for i in range(len(terms))]
    stats = counted.agg(F.struct(
        F.count("*").alias("n"), F.avg("length").alias("mean_length"),
        *[F.count_if(F.col(n) > 0).alias(n) for n in names]).alias("stats")).scalar()

    matching = counted.filter(F.col("_kept") & (F.greatest(F.lit(0), *names) > 0)).withColumn("_s", stats)
    parts = [idf(F.col("_s")["n"], F.col("_s")[n])
             * term_weight(F.col(n), F.col("length"), F.col("_s")["mean_length"]) for n in names]
    return matching.select(key, F.round(reduce(add, parts), 10).alias("score"))


def bm25_search(df: DataFrame, key: str, text: str, query: str, k: int,
                filter_eq: Filter = None, digits: int = 6) -> DataFrame:
    """The ``k`` best rows for a query, ties by key."""
    return top_scores(bm25_scores(df, key, text, query, filter_eq), key, k, digits)


def top_scores(scores: DataFrame, key: str, k: int, digits: int = 6) -> DataFrame:
    order = F.desc("score"), F.asc(key)
    top = scores.orderBy(*order).limit(k)
    return with_rank(top, *order).withColumn("score", F.round("score", digits))
