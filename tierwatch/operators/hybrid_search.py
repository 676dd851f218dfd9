"""Fusion of a lexical and a vector ranking by reciprocal rank (Cormack et al. 2009)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tierwatch.constants import RRF_CONSTANT
from tierwatch.functions.embedding import Embedder, similarities, word_counts
from tierwatch.functions.ratios import safe_ratio
from tierwatch.functions.text import message_text
from tierwatch.operators.lexical_search import counted_scores, query_terms
from tierwatch.operators.vector_search import SCORE_DIGITS, Filter, equals, with_rank
from tierwatch.session import delete_folder, scratch_path

LISTS = ("lexical", "vector")


def fuse(lexical: DataFrame, vector: DataFrame, key: str, k: int, constant: int = RRF_CONSTANT,
         digits: int = 6) -> DataFrame:
    """The ``k`` best rows by the sum of ``1 / (constant + rank)`` over both full rankings.

    A row that one ranking lacks gets nothing from it. Rows are never ranked as a whole,
    which would sort the table in one task, and no list of scores is written; still the result is that of the full
    rankings:

    * A row outside the best ``d`` of both lists scores at most ``2 / (constant + d + 1)``.
      The best ``k`` of one list each score at least ``1 / (constant + k)``. With
      ``d = constant + 2 k`` the first is smaller, so the best ``k`` are among the at most
      ``2 d`` candidates. Each task keeps ``d`` of its rows.
    * The exact rank of a candidate is one plus the number of better rows, counted for
      all candidates at once by one aggregate.

    Both lists are evaluated three times, once for the candidates only: scores should be cheap to compute from what is
    stored. ``hybrid_scan_search`` stores them first.
    """
    depth = constant + 2 * k
    spark = lexical.sparkSession
    order = F.desc("score"), F.asc(key)
    lists = dict(zip(LISTS, (lexical.select(key, "score"), vector.select(key, "score"))))
    heads = {name: scores.orderBy(*order).limit(depth).collect() for name, scores in lists.items()}
    ids = sorted({row[key] for rows in heads.values() for row in rows})
    wanted = {name: _scores_of(lists[name], key, ids, heads[name], depth) for name in LISTS}

    ranks = exact_ranks(lists, key, wanted)
    points = reduce(add, [_points(name, constant) for name in LISTS])
    best = ranks.groupBy(key).agg(
        *[F.max(F.when(F.col("list") == name, F.col("_rank"))).alias(f"{name}_rank") for name in LISTS],
        F.round(points, 12).alias("_points"))
    final = F.desc("_points"), F.asc(key)
    top = with_rank(best.orderBy(*final).limit(k), *final).select(
        key, *[f"{name}_rank" for name in LISTS], F.round("_points", digits).alias("score"), "rank")
    return spark.createDataFrame(top.collect(), top.schema)


def hybrid_scan_search(messages: DataFrame, key: str, subject: str, body: str, query: str, k: int, filter_eq: Filter = None,
                       embedder: Embedder | None = None) -> DataFrame:
    """Hybrid search straight from a table: each text is read once, and what its scores need is stored, a few numbers."""
    terms = query_terms(query)
    text = message_text(F.col(subject), F.col(body))
    cut = messages.select(key, equals(filter_eq).alias("_kept"), F.col(body).isNotNull().alias("_text"), word_counts(F.col(body), terms).alias("_c"),
                          similarities(text, {"score": query}, embedder).alias("_v"))
    path = scratch_path(messages.sparkSession, "scores")
    try:
        cut.select(key, "_kept", "_text", "_c.*", "_v.*").write.parquet(path)
        stored = messages.sparkSession.read.parquet(path)
        vector = stored.filter(F.col("_kept") & F.col("score").isNotNull()).select(key, F.round("score", SCORE_DIGITS).alias("score"))
        return fuse(counted_scores(stored.filter("_text"), key, terms), vector, key, k)
    finally:
        delete_folder(messages.sparkSession, path)


def _scores_of(scores: DataFrame, key: str, ids: Sequence, head: Sequence[Row], depth: int) -> list[Row]:
    """The rows of a list with these keys, best first: those of its head are known, and all of a list that ends with it."""
    known = {row[key] for row in head}
    missing = [i for i in ids if i not in known]
    more = scores.filter(F.col(key).isin(missing)).collect() if missing and len(head) == depth else []
    return sorted([*head, *more], key=lambda r: (-r["score"], r[key]))


def _points(name: str, constant: int) -> Column:
    mine = F.max(F.when(F.col("list") == name, F.col("_rank")))
    return safe_ratio(F.lit(1.0), constant + mine)


def exact_ranks(lists: Mapping[str, DataFrame], key: str, wanted: Mapping[str, Sequence[Row]]) -> DataFrame:
    """``(list, key, _rank)``: ranks of a bounded set of rows, given best first, within all rows of each list.

    Each row of a list is placed among the wanted ones, and only the counts per place are shuffled.
    """
    spark = next(iter(lists.values())).sparkSession
    places = [scores.select(F.lit(name).alias("list"), _place(wanted[name], key).alias("_place")) for name, scores in lists.items()]
    counts = reduce(DataFrame.union, places).groupBy("list", "_place").agg(F.count("*").alias("_rows"))

    # Every wanted row has a place of its own, so the running sum over the places before
    # it counts the better rows. There are at most as many places as wanted rows, plus one.
    before = Window.partitionBy("list").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    running = counts.select("list", "_place", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_better"))
    kind = next(iter(lists.values())).schema[key].dataType.simpleString()
    steps = spark.createDataFrame([(name, i, r[key]) for name, rows in wanted.items() for i, r in enumerate(rows, 1)],
                                  f"list string, _place int, {key} {kind}")
    return running.join(F.broadcast(steps), ["list", "_place"]).select(
        "list", key, (F.col("_better") + 1).cast("int").alias("_rank"))


def _place(wanted: Sequence[Row], key: str) -> Column:
    """How many of the wanted rows (best first) are as good as or better than the row at hand.

    Two binary searches per row, over the scores and, among equal scores, over the keys.
    """
    worse_first = np.array([-w["score"] for w in wanted])
    ids = np.array([w[key] for w in wanted])

    @F.arrow_udf("int")
    def find(scores: pa.Array, keys: pa.Array) -> pa.Array:
        mine = -scores.to_numpy(zero_copy_only=False)
        start = np.searchsorted(worse_first, mine, side="left")
        end = np.searchsorted(worse_first, mine, side="right")
        places = start.copy()
        tied = np.flatnonzero(end > start)
        if len(tied):
            names = np.array(keys.take(pa.array(tied)).to_pylist())
            for block in np.unique(start[tied]):
                rows = start[tied] == block
                last = end[tied][rows][0]
                places[tied[rows]] += np.searchsorted(ids[block:last], names[rows], side="right")
        return pa.array(places.astype(np.int32))

    return find(F.col("score"), F.col(key)) if wanted else F.lit(0)


def attach(hits: DataFrame, rows: DataFrame, key: str, columns: Sequence[str], limit: int) -> DataFrame:
    """Add table columns to a result of at most ``limit`` rows.

    The few keys are fetched first and become a filter at the scan. It spares what is not read of the table
    only where row groups hold ranges of keys; where keys are spread over all files, every row group is read.
    """
    found = hits.limit(limit).collect()
    small = hits.sparkSession.createDataFrame(found, hits.schema)
    matching = rows.filter(F.col(key).isin([h[key] for h in found])).select(
        key, *[c for c in columns if c != key])
    return matching.join(F.broadcast(small), key).orderBy("rank")
