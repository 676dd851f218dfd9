"""Nearest rows of every row, approximately: hash buckets give first neighbours, descent along the graph better ones."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierwatch.functions.embedding import unit_rows
from tierwatch.functions.memory import give_back
from tierwatch.functions.vectors import has_length, vector_rows
from tierwatch.operators.vector_search import SCORE_DIGITS, vector_length
from tierwatch.session import materialize

#: Tables of hash buckets, rows of an even bucket, neighbours on a row's list, rounds of descent.
TABLES, BUCKET_ROWS, LIST, ROUNDS = 100, 2, 10, 2
#: Up to so many rows that bucket size does. Near rows share a bucket of one size the less often the more rows there are, so
#: that buckets of larger tables grow by this power of the rows: recall then holds on random vectors, the worst case.
FEW_ROWS, GROWTH = 2000, 0.6
#: Each row of a bucket meets so many that follow it in the bucket's order; more in proportion to larger buckets.
WINDOW = 24
#: Random directions of one hash; more buckets are had by two hashes or more, which part near rows more often.
DIRECTIONS = 8192
#: Rows of a batch that are hashed at once, and rows that a task hashes, about.
HASHED_ROWS, CODED_ROWS = 512, 10_000
#: Rows that the tables of a first round deal out, about, and tables of it at least; rows that any round deals out.
FIRST_DEALT, FIRST_TABLES, ROWS_DEALT = 1_000_000, 4, 16_000_000
#: Rows that a task sweeps at once, about, rows of a matrix product, and pairs held before only the best of them are kept.
SWEPT_ROWS, MET_ROWS, PAIRS_HELD = 8192, 64, 1 << 19
#: Graph edges that one task joins, about.
EDGES_PER_BLOCK = 50_000


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest scores of each row, of equal ones those furthest left."""
    if scores.shape[1] > k:
        rows, columns = np.nonzero(scores >= np.partition(scores, -k, axis=1)[:, -k][:, None])
    else:
        rows, columns = (a.ravel() for a in np.indices(scores.shape))
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, np.arange(len(scores)))
    kept = np.arange(len(rows)) - first[rows] < k
    return rows[kept], columns[kept]


def _codes(vector: Column, dim: int, tables: int, buckets: int, seed: int) -> Column:
    """``struct<codes, place>``: the bucket of a vector in each table, and its place on a random line.

    A hash is the random direction, or its opposite, that a vector is nearest to. A table takes as many hashes as
    its number of buckets needs.
    """
    hashes = max(1, ceil(log(max(buckets, 2)) / log(2 * DIRECTIONS)))
    directions = max(1, round(max(buckets, 2) ** (1 / hashes) / 2))

    @F.arrow_udf("struct<codes: array<long>, place: double>")
    def code(vectors: pa.Array) -> pa.Array:
        rows, valid = vector_rows(vectors, dim)
        unit = unit_rows(rows).astype(np.float32)
        made = np.zeros((len(unit), tables), np.int64)
        for t in range(tables):
            for h in range(hashes):
                lines = np.random.default_rng([seed, t, h]).standard_normal((dim, directions), np.float32)
                for start in range(0, len(unit), HASHED_ROWS):
                    along, mine = unit[start:start + HASHED_ROWS] @ lines, made[start:start + HASHED_ROWS, t]
                    high, low, row = along.argmax(axis=1), along.argmin(axis=1), np.arange(len(along))
                    towards = along[row, high] > -along[row, low]
                    mine[:] = mine * 2 * directions + 2 * np.where(towards, high, low) + towards
        places = unit @ np.random.default_rng([seed, tables]).standard_normal(dim, np.float32)
        all_codes, all_places = np.zeros((len(vectors), tables), np.int64), np.zeros(len(vectors))
        all_codes[valid], all_places[valid] = made, places
        offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * tables)
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(all_codes.ravel())), pa.array(all_places)],
                                          ["codes", "place"])

    return code(vector)


def _classes(vectors: DataFrame, k: int, key: str, vector: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors with their ``k + 1`` smallest keys, and the class of each row; the smallest key names a class."""
    rows = vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector")).filter(
        F.col("_key").isNotNull() & has_length(F.col("_vector"), dim) & ~F.exists("_vector", F.isnan))
    named = rows.withColumns({"_one": F.xxhash64("_vector"), "_two": F.xxhash64(F.lit(1), "_vector")})
    order = F.row_number().over(Window.partitionBy("_one", "_two").orderBy("_key"))
    some = named.withColumn("_n", order).filter(F.col("_n") <= k + 1)
    classes = some.groupBy("_one", "_two").agg(F.sort_array(F.collect_list("_key")).alias("_keys"), F.first("_vector").alias("_vector"))
    classes = materialize(classes.withColumn("_lead", F.col("_keys")[0]), "vector-classes")
    return classes, named.select("_key", "_one", "_two").join(classes.select("_one", "_two", "_lead"), ["_one", "_two"])


def _edge_schema(classes: DataFrame) -> T.StructType:
    kind = classes.schema["_lead"].dataType
    return T.StructType([T.StructField("_query", kind), T.StructField("_lead", kind), T.StructField("score", T.DoubleType())])


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return unit_rows(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(vectors), -1))


def bucket_size(n: int) -> int:
    """Rows of an even bucket of a table of ``n`` rows."""
    return round(BUCKET_ROWS * max(1.0, n / FEW_ROWS) ** GROWTH)


def table_rounds(n: int, tables: int) -> list[range]:
    """The tables of ``n`` rows in rounds: as many as before once more, and no more rows at once than ``ROWS_DEALT``."""
    rounds, done, most = [], 0, max(1, ROWS_DEALT // max(1, n))
    while done < tables:
        at_once = min(most, max(done, FIRST_TABLES, FIRST_DEALT // max(1, n)))
        rounds.append(range(done, min(tables, done + at_once)))
        done = rounds[-1].stop
    return rounds


def _nearest(query: np.ndarray, other: np.ndarray, scores: np.ndarray, size: int, twice: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``size`` neighbours of each query, of equal ones those of the lowest number; a pair that comes ``twice`` counts once."""
    if twice:
        order = np.lexsort((-scores, other, query))
        query, other, scores = query[order], other[order], scores[order]
        once = np.ones(len(query), bool)
        once[1:] = (query[1:] != query[:-1]) | (other[1:] != other[:-1])
        query, other, scores = query[once], other[once], scores[once]
    order = np.lexsort((other, -scores, query))
    query, other, scores = query[order], other[order], scores[order]
    near = np.arange(len(query)) - np.searchsorted(query, query) < size
    return query[near], other[near], scores[near]


def _overlapping(batches: Iterator[pa.RecordBatch], overlap: int) -> Iterator[tuple[pa.Table, int]]:
    """The rows of a task in blocks that begin with the last ``overlap`` rows of the block before, and how many these are."""
    last, held, size = None, [], 0

    def block() -> tuple[pa.Table, int]:
        return pa.Table.from_batches(held if last is None else [last, *held]).combine_chunks(), 0 if last is None else len(last)

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += len(batch)
        if size >= SWEPT_ROWS:
            rows, fresh = block()
            yield rows, fresh
            last, held, size = rows.slice(max(0, len(rows) - overlap)).combine_chunks().to_batches()[0], [], 0
    if held:
        yield block()
    give_back()


def _first_neighbours(classes: DataFrame, dim: int, size: int, tables: int, bucket_rows: int | None, window: int | None, seed: int,
                      scored: Accumulator | None) -> DataFrame:
    """The lists of the best ``size`` of the vectors that share a bucket with each vector.

    Buckets are sorted along a random line and dealt by ranges, so that a large one lies over many tasks. A vector meets
    the ``window`` that follow it; those of smaller buckets all meet. Tables are swept in rounds. A task hands on the best of
    each vector's neighbours, and only those that are as good as the last one on the list that the vector has from earlier rounds: no
    other can be among the best of all tables.
    """
    n = classes.count()
    bucket_rows = bucket_rows or bucket_size(n)
    window = window or max(WINDOW, WINDOW * bucket_rows // BUCKET_ROWS)
    buckets = ceil(n / bucket_rows)
    parts = max(1, min(ceil(n / HASHED_ROWS), max(classes.sparkSession.sparkContext.defaultParallelism, ceil(n / CODED_ROWS))))
    coded = classes.select("_lead", "_vector").repartition(parts, "_lead").withColumn(
        "_at", _codes(F.col("_vector"), dim, tables, buckets, seed))
    coded = materialize(coded.select("_lead", "_vector", "_at.codes", "_at.place"), "vector-codes")
    schema = _edge_schema(classes)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, fresh in _overlapping(batches, window):
            table, bucket = rows["_table"].to_numpy(), rows["_bucket"].to_numpy()
            found = rows["_lead"].combine_chunks().dictionary_encode()
            in_order = pc.sort_indices(found.dictionary)
            leads, numbers = found.dictionary.take(in_order), np.empty(len(in_order), np.int64)
            numbers[in_order.to_numpy()] = np.arange(len(in_order))
            number = numbers[found.indices.to_numpy()]
            floor = np.full(len(leads), -np.inf)
            floor[number] = pc.fill_null(rows["_floor"], -np.inf).to_numpy()
            unit, places = _matrix(rows["_vector"]), np.arange(len(rows))
            new = np.ones(len(rows), bool)
            new[1:] = (table[1:] != table[:-1]) | (bucket[1:] != bucket[:-1])
            # Each row meets those from ``since`` on and before ``until``.
            until = np.minimum(np.append(np.flatnonzero(new)[1:], len(rows))[np.cumsum(new) - 1], places + window + 1)
            since = np.maximum(places + 1, fresh)
            if scored is not None:
                scored.add(int(np.maximum(until - since, 0).sum()))
            held, n_held = [], 0

            def best() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                query, other, scores = _nearest(*(np.concatenate(x) for x in zip(*held)), size, table[0] != table[-1])
                full = np.flatnonzero(np.arange(len(query)) - np.searchsorted(query, query) == size - 1)
                floor[query[full]] = np.maximum(floor[query[full]], scores[full])
                return query, other, scores

            for start in range(0, len(rows), MET_ROWS):
                stop, low, high = min(len(rows), start + MET_ROWS), since[start], until[start:start + MET_ROWS].max()
                if low >= high:
                    continue
                scores = np.round(unit[start:stop] @ unit[low:high].T, SCORE_DIGITS)
                first, second = np.nonzero(scores >= np.minimum(floor[number[start:stop], None], floor[number[low:high]]))
                scores, first, second = scores[first, second], first + start, second + low
                met = (second >= since[first]) & (second < until[first])
                scores, first, second = scores[met], number[first[met]], number[second[met]]
                for query, other in ((first, second), (second, first)):
                    good = scores >= floor[query]
                    held.append((query[good], other[good], scores[good]))
                    n_held += len(held[-1][0])
                if n_held > PAIRS_HELD:
                    held = [best()]
                    n_held = len(held[0][0])
            if n_held:
                query, other, scores = best()
                yield pa.RecordBatch.from_arrays([leads.take(pa.array(query)), leads.take(pa.array(other)), pa.array(scores)], names=schema.names)

    order, graph = ("_table", "_bucket", "place", "_lead"), None
    for some in table_rounds(n, tables):
        codes = coded.select("_lead", "_vector", "place", F.slice("codes", some.start + 1, len(some)).alias("codes"))
        placed = codes.withColumn("_floor", F.lit(None).cast("double")) if graph is None else codes.join(_floors(graph, size), "_lead", "left")
        placed = placed.select("_lead", "_vector", "place", "_floor", F.posexplode("codes").alias("_table", "_bucket"))
        found = placed.select(*order, "_vector", "_floor").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sweep, schema)
        found = found.withColumn("fresh", F.lit(True))
        graph = materialize(_lists(found if graph is None else found.unionByName(graph), size), "neighbours")
    return graph


def _floors(graph: DataFrame, size: int) -> DataFrame:
    """``_lead, _floor``: the score of the last neighbour of each vector whose list is full."""
    full = graph.groupBy(F.col("_query").alias("_lead")).agg(F.count("*").alias("_n"), F.min("score").alias("_floor"))
    return full.filter(F.col("_n") >= size).drop("_n")


def _lists(edges: DataFrame, size: int) -> DataFrame:
    """The best ``size`` of each vector's neighbours; ``fresh`` are those that ``edges`` has as new only."""
    met = edges.groupBy("_query", "_lead").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
    near = Window.partitionBy("_query").orderBy(F.desc("score"), F.asc("_lead"))
    return met.withColumn("_n", F.row_number().over(near)).filter(F.col("_n") <= size).drop("_n")


def _descend(graph: DataFrame, classes: DataFrame, size: int, n_edges: int, scored: Accumulator | None) -> DataFrame:
    """Introduce the neighbours of each vector to one another: pairs of which one at least is fresh.

    Of these only such are handed on that are as good as the last one on a full list.
    """
    both = graph.select(F.col("_lead").alias("_centre"), F.col("_query").alias("_member"), "score", "fresh").union(
        graph.select("_query", "_lead", "score", "fresh"))
    both = both.groupBy("_centre", "_member").agg(F.max("score").alias("score"), F.max("fresh").alias("fresh"))
    # A vector that is on very many lists introduces the nearest of those.
    near = Window.partitionBy("_centre").orderBy(F.desc("score"), F.asc("_member"))
    both = both.withColumn("_n", F.row_number().over(near)).filter(F.col("_n") <= 4 * size)
    vectors = classes.select("_lead", "_vector").join(_floors(graph, size), "_lead", "left")
    met = both.select("_centre", F.col("_member").alias("_lead"), "fresh").join(vectors, "_lead")
    blocks = max(1, n_edges // EDGES_PER_BLOCK)
    schema = _edge_schema(classes)

    def introduce(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_centre", "ascending"), ("_lead", "ascending")])
        leads, fresh, unit = rows["_lead"].combine_chunks(), rows["fresh"].to_numpy(), _matrix(rows["_vector"])
        floor = pc.fill_null(rows["_floor"], -np.inf).to_numpy()
        ends = pc.run_end_encode(rows["_centre"].combine_chunks()).run_ends.to_numpy()
        queries, others, values, pairs = [], [], [], 0
        for a, b in zip([0, *ends[:-1]], ends):
            ours = np.arange(a, b)
            new, old = ours[fresh[a:b]], ours[~fresh[a:b]]
            pairs += len(new) * (len(new) - 1) // 2 + len(new) * len(old)
            if not len(new) or b - a < 2:
                continue
            scores = np.round(unit[new] @ unit[ours].T, SCORE_DIGITS)
            scores[np.arange(len(new)), new - a] = -2.0
            i, j = _best(scores, min(size, b - a - 1))
            queries.append(new[i]), others.append(ours[j]), values.append(scores[i, j])
            if len(old):
                back = scores[:, old - a].T
                i, j = _best(back, min(size, len(new)))
                queries.append(old[i]), others.append(new[j]), values.append(back[i, j])
        if scored is not None:
            scored.add(pairs)
        q, o = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (queries, others))
        scores = np.concatenate(values) if values else np.zeros(0)
        good = scores >= floor[q]
        return pa.table([leads.take(pa.array(q[good])), leads.take(pa.array(o[good])), pa.array(scores[good])], names=schema.names)

    block = F.pmod(F.xxhash64("_centre"), F.lit(blocks)).alias("_block")
    found = met.select(block, "_centre", "_lead", "_vector", "_floor", "fresh").groupBy("_block").applyInArrow(introduce, schema)
    return _lists(graph.withColumn("fresh", F.lit(False)).unionByName(found.withColumn("fresh", F.lit(True))), size)


def neighbour_graph(classes: DataFrame, dim: int, size: int = LIST, tables: int = TABLES, bucket_rows: int | None = None,
                    window: int | None = None, rounds: int = ROUNDS, seed: int = 7, scored: Accumulator | None = None) -> DataFrame:
    """``_query, _lead, score``: about the best ``size`` neighbours of each of the distinct vectors ``_lead, _vector``.

    Buckets grow by a power of the rows, lists do not: pairs scored grow faster than the rows (by the power 1.6 beyond ``FEW_ROWS``)
    and slower than their square; what is shuffled grows with the rows. Descent stops early when few lists change. ``scored`` adds up the pairs
    that meet, not those that a matrix product of neighbouring rows scores beside them.
    """
    graph = _first_neighbours(classes, dim, size, tables, bucket_rows, window, seed, scored)
    for _ in range(rounds):
        n_edges, n_fresh = graph.agg(F.count("*"), F.count_if("fresh")).first()
        if n_fresh <= n_edges // 100:
            break
        graph = materialize(_descend(graph, classes, size, n_edges, scored), "neighbours")
    return graph.select("_query", "_lead", "score")


def more_like_graph(vectors: DataFrame, k: int, key: str, vector: str = "embedding", dim: int | None = None, tables: int = TABLES,
                    bucket_rows: int | None = None, window: int | None = None, rounds: int = ROUNDS, seed: int = 7, digits: int = 3,
                    scored: Accumulator | None = None) -> DataFrame:
    """Approximately the ``k`` most similar rows of every row, itself left out: ``query_id, key, similarity, rank``.

    First neighbours are those in the same bucket of one of ``tables`` tables; then ``rounds`` times each vector's neighbours are
    introduced to one another, pairs that have not met. Scores are exact. Nothing passes through the driver, and the pairs
    scored grow more slowly than the square of the rows. More tables and rounds find more; tests measure the recall and the
    pairs. Equal vectors are compared once; of each the ``k + 1`` smallest keys can be among the best. Rows without a
    key and vectors of another length than ``dim`` are left out.
    """
    dim = vector_length(vectors, vector) if dim is None else dim
    classes, class_of_row = _classes(vectors, k, key, vector, dim)
    pairs = neighbour_graph(classes, dim, max(LIST, k), tables, bucket_rows, window, rounds, seed, scored)

    # From classes to rows: the keys of the near classes and those of the own one.
    others = pairs.join(classes.select("_lead", "_keys"), "_lead").select("_query", "score", F.explode("_keys").alias(key))
    own = classes.select(F.col("_lead").alias("_query"), F.exists("_vector", lambda x: x != 0).cast("double").alias("score"),
                         F.explode("_keys").alias(key))
    order: Sequence[Column] = (F.desc("score"), F.asc(key))
    best = (others.unionByName(own).withColumn("_n", F.row_number().over(Window.partitionBy("_query").orderBy(*order)))
            .filter(F.col("_n") <= k + 1).select(F.col("_query").alias("_lead"), "score", key))
    asked = class_of_row.select("_lead", F.col("_key").alias("query_id")).join(best, "_lead").filter(F.col("query_id") != F.col(key))
    return (asked.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
            .filter(F.col("rank") <= k).select("query_id", key, F.round("score", digits).alias("similarity"), "rank"))


def more_like_lsh(vectors: DataFrame, k: int, key: str, vector: str = "embedding", dim: int | None = None, tables: int = 120,
                  **settings) -> DataFrame:
    """:func:`more_like_graph` by hash buckets alone, with more tables in place of descent."""
    return more_like_graph(vectors, k, key, vector, dim, tables, rounds=0, **settings)
