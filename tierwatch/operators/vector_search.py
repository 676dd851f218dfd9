"""Exact nearest-neighbour search over a vector column."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierwatch.functions.embedding import Embedder, embed, unit_rows
from tierwatch.functions.once import with_once
from tierwatch.functions.text import message_text
from tierwatch.functions.vectors import cosine_to, vector_rows

# Scores are compared at this many digits, so that copies of a vector tie exactly and
# fall back to the key, whatever batch they were computed in.
SCORE_DIGITS = 10
# So many questions at most are broadcast; more are dealt into blocks of about as many.
QUERY_BLOCK = 2048
# Corpus rows that meet a block of questions in one task, about.
CORPUS_BLOCK = 20_000


Filter = Mapping[str, object] | Column | None


def equals(filter_eq: Filter) -> Column:
    """Conjunction of equality conditions (true when there are none), or the condition as it is."""
    if isinstance(filter_eq, Column):
        return filter_eq
    condition = F.lit(True)
    for column, value in (filter_eq or {}).items():
        condition = condition & (F.col(column) == F.lit(value))
    return condition


def build_vectors(messages: DataFrame, key: str, subject: str, body: str, attributes: Sequence[str] = (),
                  embedder: Embedder | None = None, body_chars: int | None = None) -> DataFrame:
    """The vector table: key, attributes and the vector of subject and body.

    The whole body counts unless ``body_chars`` sets a limit.
    """
    text = message_text(F.col(subject), F.col(body), body_chars)
    made = F.struct(embed(text, embedder).alias("embedding"))
    return with_once(messages, made, "embedding").select(key, *attributes, "embedding")


def with_rank(top: DataFrame, *order: Column) -> DataFrame:
    """Number an already limited result from 1."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def vector_scores(vectors: DataFrame, query: Sequence[float], key: str, vector: str = "embedding",
                  filter_eq: Filter = None) -> DataFrame:
    """``(key, score)`` of every row that passes the filter and has a valid vector.

    Only the key, the vector and the filter columns are read.
    """
    rows = vectors.filter(equals(filter_eq)).select(key, F.col(vector).alias("_vector"))
    score = F.round(cosine_to(F.col("_vector"), query), SCORE_DIGITS).alias("score")
    return with_once(rows, F.struct(score), "score").select(key, "score").filter(F.col("score").isNotNull())


def vector_search(vectors: DataFrame, query: Sequence[float], k: int, key: str, vector: str = "embedding",
                  filter_eq: Filter = None, digits: int = 3) -> DataFrame:
    """The ``k`` rows most similar to a vector, best first, ties by key.

    Every task keeps its own best ``k`` and only those meet in the final step.
    """
    order = F.desc("score"), F.asc(key)
    top = vector_scores(vectors, query, key, vector, filter_eq).orderBy(*order).limit(k)
    return with_rank(top, *order).select(key, F.round("score", digits).alias("similarity"), "rank")


def more_like(vectors: DataFrame, row: object, k: int, key: str, vector: str = "embedding",
              digits: int = 3) -> DataFrame:
    """The ``k`` rows most similar to a given row, itself left out."""
    found = vectors.filter(F.col(key) == F.lit(row)).select(vector).first()
    if found is None or found[0] is None:
        raise ValueError(f"no vector for {key} = {row!r}")
    return vector_search(vectors.filter(F.col(key) != F.lit(row)), found[0], k, key, vector, digits=digits)


def vector_length(vectors: DataFrame, vector: str = "embedding") -> int:
    """The length of a corpus's vectors, as its first valid one has it; 0 for an empty corpus."""
    found = vectors.select(F.size(vector).alias("n")).filter(F.col("n") > 0).first()
    return found["n"] if found else 0


def bad_queries(queries: DataFrame, dim: int, query_vector: str = "embedding") -> DataFrame:
    """The queries that no search can answer: without a vector, or with one of another length."""
    return queries.filter(F.col(query_vector).isNull() | (F.size(query_vector) != dim))


def vector_search_many(vectors: DataFrame, queries: DataFrame, k: int, key: str, query_key: str,
                       vector: str = "embedding", query_vector: str = "embedding", digits: int = 3,
                       exclude_self: bool = False, query_block: int = QUERY_BLOCK, dim: int | None = None) -> DataFrame:
    """Exact top ``k`` for each query row whose vector has the corpus's length ``dim``.

    Up to ``query_block`` questions are sent to every task, which keeps a running top ``k`` per
    question while it reads its vectors once. More questions are dealt into blocks, and the corpus as
    well; each pair of blocks meets in one task, so nothing of either side passes through the driver. No pair
    of rows becomes a row, but every pair is scored, and each side is shuffled once for each block of the
    other: for every row of a large table there is ``similar_rows.more_like_graph``.
    ``bad_queries`` gives the questions that are left out.
    """
    wanted = k + 1 if exclude_self else k
    dim = vector_length(vectors, vector) if dim is None else dim
    if query_key == key:
        # A column name of its own, so that a self search does not clash.
        query_key, queries = "query_id", queries.withColumnRenamed(key, "query_id")
    questions = queries.select(query_key, F.col(query_vector).alias("_query")).filter(
        F.col(query_key).isNotNull() & (F.size("_query") == dim))
    corpus = vectors.select(key, F.col(vector).alias("_vector")).dropna()
    schema = T.StructType([questions.schema[query_key], corpus.schema[key], T.StructField("score", T.DoubleType())])

    n_blocks = max(1, math.ceil(questions.count() / query_block))
    search = _broadcast_search if n_blocks == 1 else partial(_grid_search, n_blocks, query_block)
    found = search(corpus, questions, wanted, dim, schema)
    if exclude_self:
        found = found.filter(F.col(query_key) != F.col(key))
    best = Window.partitionBy(query_key).orderBy(F.desc("score"), F.asc(key))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select(query_key, key, F.round("score", digits).alias("similarity"), "rank"))


class Best:
    """Running top ``k`` (score descending, key ascending) for each query."""

    def __init__(self, query_keys: pa.Array, query_vectors: pa.Array, k: int, dim: int):
        rows, valid = vector_rows(query_vectors, dim)
        self.query_keys = query_keys.filter(pa.array(valid))
        self.unit, self.dim, self.k = unit_rows(rows), dim, k
        self.scores = [np.zeros(0)] * len(rows)
        self.keys: list[np.ndarray] = [np.zeros(0)] * len(rows)

    def add(self, keys: pa.Array, vectors: pa.Array) -> None:
        rows, valid = vector_rows(vectors, self.dim)
        if not len(rows) or not len(self.unit):
            return
        names = np.asarray(keys.filter(pa.array(valid)).to_pylist())
        scores = np.round(self.unit @ unit_rows(rows).T, SCORE_DIGITS)
        for q, line in enumerate(scores):
            self._merge(q, line, names)

    def _merge(self, q: int, line: np.ndarray, names: np.ndarray) -> None:
        full = len(self.scores[q]) == self.k
        floor = self.scores[q][-1] if full else -np.inf
        if not full and len(line) > self.k:
            floor = max(floor, np.partition(line, -self.k)[-self.k])
        near = np.flatnonzero(line >= floor)
        if not len(near):
            return
        scores = np.concatenate([self.scores[q], line[near]])
        keys = np.concatenate([self.keys[q], names[near]]) if len(self.keys[q]) else names[near]
        order = np.lexsort((keys, -scores))[: self.k]
        self.scores[q], self.keys[q] = scores[order], keys[order]

    def table(self, schema: pa.Schema) -> pa.RecordBatch:
        sizes = [len(s) for s in self.scores]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        keys = [x for part in self.keys for x in part.tolist()]
        scores = np.concatenate(self.scores) if sizes else np.zeros(0)
        return pa.RecordBatch.from_arrays([
            self.query_keys.take(pa.array(owner, pa.int64())).cast(schema.types[0]),
            pa.array(keys, schema.types[1]), pa.array(scores)], schema=schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return pa.schema([pa.field(f.name, f.type) for f in to_arrow_schema(schema)])


def _broadcast_search(corpus: DataFrame, questions: DataFrame, k: int, dim: int, schema: T.StructType) -> DataFrame:
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast(questions.toArrow().combine_chunks())
    target = arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = Best(flat(asked.column(0)), flat(asked.column(1)), k, dim)
        for batch in batches:
            best.add(batch.column(0), batch.column(1))
        yield best.table(target)

    return corpus.mapInArrow(search, schema)


def question_groups(n_blocks: int, query_block: int, n_parts: int, cores: int) -> int:
    """How often a grid shuffles its corpus: small blocks of questions come together in groups."""
    return max(math.ceil(n_blocks * query_block / CORPUS_BLOCK), min(n_blocks, math.ceil(2 * cores / n_parts)))


def _grid_search(n_blocks: int, query_block: int, corpus: DataFrame, questions: DataFrame, k: int, dim: int, schema: T.StructType) -> DataFrame:
    """Each group of blocks of questions meets each block of the corpus in one task, a block of questions at a time.

    The corpus is shuffled once a group: as few as keep all cores busy, and each of about ``CORPUS_BLOCK`` questions at most.
    """
    n_parts = max(1, math.ceil(corpus.count() / CORPUS_BLOCK))
    n_groups = question_groups(n_blocks, query_block, n_parts, corpus.sparkSession.sparkContext.defaultParallelism)
    (query_key, _), (key, _) = questions.columns, corpus.columns
    asked = questions.withColumn("_block", F.pmod(F.xxhash64(query_key), F.lit(n_groups)).cast("int")).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    dealt = corpus.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(n_parts)).cast("int")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    target = arrow_schema(schema)

    def search(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        found = []
        for start in range(0, len(ours), query_block):
            mine = ours.slice(start, query_block)
            best = Best(flat(mine[query_key]), flat(mine["_query"]), k, dim)
            for batch in theirs.to_batches(max_chunksize=4096):
                best.add(batch[key], batch["_vector"])
            found.append(best.table(target))
        return pa.Table.from_batches(found, target)

    return asked.groupBy("_block", "_part").cogroup(dealt.groupBy("_block", "_part")).applyInArrow(search, schema)


def flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
