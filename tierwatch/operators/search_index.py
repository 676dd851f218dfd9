"""A persisted search index: messages, blocks of postings and a log of batches."""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tierwatch.functions.embedding import Embedder, embed_literal, packed, terms_and_vector, unpacked
from tierwatch.operators import postings as blocks_of
from tierwatch.operators.hybrid_search import attach, fuse
from tierwatch.operators.index_log import Batch, CommitLog, Snapshot
from tierwatch.operators.lexical_search import query_terms, term_weight, top_scores
from tierwatch.operators.registry import _read_meta, _write_meta
from tierwatch.operators.vector_search import Filter, equals, vector_scores

_META = ("name string, version string, text_column string, key string, attributes string, target_lag string")
#: How folders end that hold packed vectors; those of earlier versions hold arrays.
_PACKED = "-packed"
#: Blocks that a search reads first, to learn how good its answers are at least.
FIRST_BLOCKS = 16
#: Messages that a search looks up in the lists of its frequent words, at most; beyond, it reads those lists.
LOOKUPS = 5000


@dataclass(frozen=True)
class _Word:
    """A query word: its weight, and the most that it can add to a score."""

    term: str
    idf: float
    most: float


class SearchIndex:
    """An index over one text column with filter attributes.

    A refresh cuts and embeds each text once and stores what comes of it; blocks of postings are made
    from that. Then it commits: readers take the batches of the last commit only, so they never see half a
    batch. Commits are numbered, and a message is as old as the commit it came with, also after ``compact`` has rewritten
    it. A batch names the keys of older messages that it takes out, be it by newer ones or by ``delete``, and that
    holds for all messages older than the batch, in whatever folder they are by then. A writer that finds
    another commit ahead of its own looks again. So no change is lost, whoever writes at the same time.

    A repeated batch of the same origin takes out all of its earlier attempt.

    Postings are stored by word bucket in blocks, with the attributes beside them, so that a filter applies
    before scoring. A search reads the buckets of its words only, and of those only blocks that can hold an answer.
    """

    def __init__(self, root: str, name: str, key: str, text: str, subject: str,
                 attributes: Sequence[str] = (), embedder: Embedder | None = None,
                 target_lag: str = "1 hour", buckets: int = 64,
                 body_chars: int | None = None, block_rows: int = blocks_of.BLOCK_ROWS):
        self.base = f"{root.rstrip('/')}/indexes"
        self.root = f"{self.base}/{name}/current"
        self.name, self.key, self.text, self.subject = name, key, text, subject
        self.attributes, self.embedder = list(attributes), embedder
        self.target_lag, self.buckets, self.body_chars, self.block_rows = target_lag, buckets, body_chars, block_rows
        self.log = CommitLog(f"{self.root}/commits")

    def describe(self, spark: SparkSession) -> None:
        """Record the index so that ``list_indexes`` finds it."""
        _write_meta(spark, f"{self.root}/meta",
                    (self.name, "current", self.text, self.key, ",".join(self.attributes), self.target_lag), _META)

    def refresh(self, messages: DataFrame, batch_id: int | str, origin: str = "bulk", newest: str | None = None) -> None:
        """Index the messages of one batch; those without a key are left out.

        Of repeated keys the row with the largest ``newest`` stays, of equal ones (or without such a column) the one
        with the largest digest of its text and attributes.
        """
        spark, batch_id = messages.sparkSession, str(batch_id)
        folder = f"{origin}-{batch_id}-{uuid.uuid4().hex}{_PACKED}"
        body, subject = F.col(self.text), F.col(self.subject)
        digest = F.xxhash64(subject, body, *(F.col(a) for a in self.attributes))
        order = [F.col(newest).alias("newest")] if newest else []
        made = terms_and_vector(subject, body, self.embedder, self.body_chars)
        cut = messages.filter(F.col(self.key).isNotNull()).select(
            self.key, *self.attributes, body.isNotNull().alias("has_text"), made["terms"].alias("terms"), made["embedding"].alias("embedding"),
            F.lit(None).cast("long").alias("since"), F.struct(*order, digest.alias("digest"), F.monotonically_increasing_id().alias("row")).alias("order"))
        cut = cut.withColumn("length", F.aggregate("terms", F.lit(0), lambda n, t: n + t["tf"]))
        data, n_docs, n_words = self._write_messages(cut, folder)
        self._write_postings(spark, data)
        self._commit(spark, self._messages(spark, [data]).select(self.key), origin, batch_id, data, n_docs, n_words)

    def delete(self, keys: DataFrame, batch_id: int | str, origin: str = "deleted") -> None:
        """Take the messages with these keys out of the index."""
        self._commit(keys.sparkSession, keys.select(self.key), origin, str(batch_id), None, 0, 0)

    def compact(self, spark: SparkSession) -> None:
        """Rewrite the live messages as one batch; earlier folders are no longer read."""
        done = False
        while not done:
            before = self.log.latest(spark)
            data = before.numbers("data")
            if not data:
                return
            replaced = {b.n for b in before.batches}
            folder, n_docs, n_words = self._write_messages(
                self._live(spark, self._messages(spark, data, before), before).drop("batch"), f"compacted-{uuid.uuid4().hex}{_PACKED}", unique=True)
            self._write_postings(spark, folder)

            def prepare(now: Snapshot) -> tuple[Batch, set[int]] | None:
                # Where another compaction was faster, what this one has read is there no more.
                known = replaced <= {b.n for b in now.batches}
                return (Batch(0, "compacted", folder, folder, None, n_docs, n_words), replaced) if known else None

            done = self.log.commit(spark, prepare) is not None

    def _write_messages(self, rows: DataFrame, folder: str, unique: bool = False) -> tuple[str, int, int]:
        """Store messages, one for each key: the folder, how many have a text, and their words."""
        spark, texts = rows.sparkSession, F.col("has_text")
        counts = [F.count("*").alias("rows"), F.count_if(texts).alias("n_docs"),
                  F.coalesce(F.sum(F.when(texts, F.col("length"))), F.lit(0)).cast("long").alias("n_words")]
        seen = Observation()
        rows.observe(seen, *counts).write.parquet(self._path("messages", folder))
        found = seen.get
        if not unique:
            stored = spark.read.schema(rows.schema).parquet(self._path("messages", folder))
            winners = stored.groupBy(self.key).agg(F.max("order")["row"].alias("row"))
            if winners.count() < found["rows"]:
                # Some keys are repeated: what stays of them is written anew, the first folder is not read again.
                kept = stored.withColumn("row", F.col("order.row")).join(winners.select("row"), "row", "left_semi").drop("row")
                return self._write_messages(kept, f"{folder.removesuffix(_PACKED)}-once{_PACKED}", unique=True)
        return folder, found["n_docs"], found["n_words"]

    def _write_postings(self, spark: SparkSession, folder: str) -> None:
        made = blocks_of.pack(self._messages(spark, [folder]).filter("has_text"), self.key, self.attributes, self.buckets, self.block_rows)
        made.write.partitionBy("bucket").parquet(self._path("postings", folder))

    def _commit(self, spark: SparkSession, keys: DataFrame, origin: str, batch_id: str, data: str | None, n_docs: int, n_words: int) -> None:
        """The last step of a batch: take out older messages with its keys, and let readers see it."""
        def prepare(now: Snapshot) -> tuple[Batch, set[int]]:
            batch = Batch(0, origin, batch_id, data, None, n_docs, n_words)
            older = now.numbers("data")
            if not older:
                return batch, set()
            attempts = [b.data for b in now.batches if (b.origin, b.batch_id) == (origin, batch_id) and b.data]
            live = self._live(spark, self._messages(spark, older, now).select(self.key, "has_text", "length", "terms", "since", "batch"), now)
            again = live.join(keys.distinct().withColumn("_again", F.lit(True)), self.key, "left").filter(
                F.col("_again") | F.col("batch").isin(attempts))
            # A folder of its own for each look: one that comes to nothing is never named.
            marks, seen = f"{origin}-{batch_id}-{uuid.uuid4().hex}", Observation()
            texts = F.col("has_text")
            again.select(self.key, "has_text", "terms", "length").observe(
                seen, F.count("*").alias("rows"), F.count_if(texts).alias("n_docs"),
                F.coalesce(F.sum(F.when(texts, F.col("length"))), F.lit(0)).alias("n_words")).write.parquet(self._path("marks", marks))
            gone = seen.get
            if not gone["rows"]:
                return batch, set()
            words = self._read(spark, "marks", [marks]).filter("has_text").select(F.explode("terms").alias("_t")).groupBy("_t.term").agg(
                (-F.count("*")).alias("n"))
            words.withColumn("bucket", blocks_of.bucket_of(F.col("term"), self.buckets)).write.partitionBy("bucket").parquet(
                self._path("gone", marks))
            return replace(batch, marks=marks, n_docs=n_docs - gone["n_docs"], n_words=n_words - gone["n_words"]), set()

        if self.log.commit(spark, prepare).n == 1:
            self.describe(spark)

    def _path(self, name: str, folder: str) -> str:
        return f"{self.root}/{name}/batch={folder}"

    def _read(self, spark: SparkSession, name: str, folders: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read.option("basePath", f"{self.root}/{name}")
        return (reader.schema(schema) if schema else reader).parquet(*(self._path(name, f) for f in folders))

    def _messages(self, spark: SparkSession, folders: Sequence[str], at: Snapshot | None = None) -> DataFrame:
        """Stored messages; with a snapshot, ``since`` is the commit that each came with."""
        by_layout = [[f for f in folders if f.endswith(_PACKED) == new] for new in (True, False)]
        parts = [self._read(spark, "messages", some) for some in by_layout if some]
        if by_layout[1]:
            parts[-1] = parts[-1].withColumn("embedding", packed(F.col("embedding")))
        stored = reduce(DataFrame.unionByName, parts)
        return stored if at is None else stored.withColumn("since", _since(at))

    def _live(self, spark: SparkSession, rows: DataFrame, at: Snapshot) -> DataFrame:
        """The rows of ``key, since`` that no younger batch takes out."""
        marks = at.numbers("marks")
        if not marks:
            return rows
        taken = self._read(spark, "marks", list(marks)).select(F.col(self.key).alias("_gone"), _number(marks).alias("_at"))
        return rows.join(taken, (F.col(self.key) == F.col("_gone")) & (F.col("_at") > F.col("since")), "left_anti")

    def vectors(self, spark: SparkSession) -> DataFrame:
        return self._packed_vectors(spark).withColumn("embedding", unpacked(F.col("embedding")))

    def _packed_vectors(self, spark: SparkSession) -> DataFrame:
        at = self.log.latest(spark)
        found = self._messages(spark, at.numbers("data"), at).select(self.key, *self.attributes, "embedding", "since")
        return self._live(spark, found, at).drop("since")

    def _blocks(self, spark: SparkSession, at: Snapshot, terms: Sequence[str]) -> DataFrame:
        folders = list(at.numbers("data"))
        schema = blocks_of.schema(self._messages(spark, folders[-1:]).schema, self.key, self.attributes)
        wanted = sorted({zlib.crc32(t.encode()) % self.buckets for t in terms})
        stored = self._read(spark, "postings", folders, schema.add("batch", "string"))
        return stored.filter(F.col("bucket").isin(wanted) & F.col("term").isin(list(terms)))

    def _words(self, spark: SparkSession, at: Snapshot, blocks: DataFrame, terms: Sequence[str]) -> tuple[dict[str, _Word], float]:
        """The query words that the index holds, and the mean length of its messages: from the heads of blocks."""
        n_docs, n_words = sum(b.n_docs for b in at.batches), sum(b.n_words for b in at.batches)
        mean = n_words / n_docs if n_docs else 0.0
        heads = blocks.select("term", F.col("n").cast("long").alias("n"), _weight(mean).alias("weight"))
        marks = at.numbers("marks")
        if marks:
            wanted = sorted({zlib.crc32(t.encode()) % self.buckets for t in terms})
            gone = self._read(spark, "gone", list(marks), T.StructType.fromDDL("term string, n long, bucket int, batch string"))
            heads = heads.unionByName(gone.filter(F.col("bucket").isin(wanted) & F.col("term").isin(list(terms))).select("term", "n"),
                                      allowMissingColumns=True)
        words = {}
        for r in heads.groupBy("term").agg(F.sum("n").alias("n"), F.max("weight").alias("weight")).collect():
            if r["n"] > 0:
                idf = math.log(1.0 + (n_docs - r["n"] + 0.5) / (r["n"] + 0.5))
                words[r["term"]] = _Word(r["term"], idf, idf * r["weight"])
        return words, mean

    def _scored(self, spark: SparkSession, at: Snapshot, blocks: DataFrame, words: Mapping[str, _Word], mean: float,
                filter_eq: Filter) -> DataFrame:
        """``(key, score)`` of the live messages of some blocks that pass the filter."""
        hits = blocks_of.unpack(blocks, "batch").filter(equals(filter_eq)).withColumn("since", _since(at))
        part = _of(words, "idf") * term_weight(F.col("tf"), F.col("length"), F.lit(mean))
        return self._live(spark, hits, at).groupBy(self.key).agg(F.round(F.sum(part), 10).alias("score"))

    def _none(self, spark: SparkSession, at: Snapshot) -> DataFrame:
        return self._messages(spark, at.numbers("data")).select(self.key, F.lit(0.0).alias("score")).filter(F.lit(False))

    def lexical_scores(self, spark: SparkSession, query: str,
                       filter_eq: Filter = None) -> DataFrame:
        """``(key, score)`` of the messages that hold a query word."""
        at, terms = self.log.latest(spark), query_terms(query)
        blocks = self._blocks(spark, at, terms) if terms else None
        words, mean = self._words(spark, at, blocks, terms) if terms else ({}, 0.0)
        return self._scored(spark, at, blocks.filter(F.col("term").isin(list(words))), words, mean, filter_eq) if words else self._none(spark, at)

    def lexical_search(self, spark: SparkSession, query: str, k: int,
                       filter_eq: Filter = None) -> DataFrame:
        """The ``k`` best messages by their words; reads only blocks that can hold one."""
        at, terms = self.log.latest(spark), query_terms(query)
        blocks = self._blocks(spark, at, terms) if terms else None
        words, mean = self._words(spark, at, blocks, terms) if terms else ({}, 0.0)
        if not words:
            return top_scores(self._none(spark, at), self.key, k)
        chosen = self._chosen(spark, at, blocks, words, mean, k, filter_eq)
        return top_scores(self._scored(spark, at, chosen, words, mean, filter_eq), self.key, k)

    def blocks_read(self, spark: SparkSession, query: str, k: int, filter_eq: Filter = None) -> DataFrame:
        """``(term, n_blocks, n_read)``: how much of the lists of its words a search reads."""
        at, terms = self.log.latest(spark), query_terms(query)
        blocks = self._blocks(spark, at, terms)
        words, mean = self._words(spark, at, blocks, terms)
        chosen = self._chosen(spark, at, blocks, words, mean, k, filter_eq).groupBy("term").agg(F.count("*").alias("n_read"))
        return blocks.groupBy("term").agg(F.count("*").alias("n_blocks")).join(chosen, "term", "left").fillna(0)

    def _chosen(self, spark: SparkSession, at: Snapshot, blocks: DataFrame, words: Mapping[str, _Word], mean: float, k: int,
                filter_eq: Filter) -> DataFrame:
        """The blocks that can hold a posting of one of the ``k`` best messages.

        The blocks of the highest bounds show what the ``k``-th best scores at least. What is below that with
        all that other words may add is left out. Words that cannot make an answer together are looked up for the
        messages that the other words bring, in blocks whose range of keys holds one of them.
        """
        blocks = blocks.filter(F.col("term").isin(list(words)))
        bound = _of(words, "idf") * _weight(mean)
        first = blocks.orderBy(bound.desc(), "term", "first", "batch").limit(FIRST_BLOCKS)
        best = self._scored(spark, at, first, words, mean, filter_eq).orderBy(F.desc("score")).limit(k).agg(
            F.min("score").alias("least"), F.count("*").alias("n")).first()
        if best["n"] < k:
            return blocks
        # Scores are rounded; a little less is safe.
        least = best["least"] - 1e-9
        rest, most = [], 0.0
        for word in sorted(words.values(), key=lambda w: w.most):
            if most + word.most >= least:
                break
            rest.append(word.term)
            most += word.most
        ahead = [t for t in words if t not in rest]
        others = sum(w.most for w in words.values()) - _of(words, "most")
        chosen = blocks.filter(F.col("term").isin(ahead) & (bound + others >= least))
        if not rest:
            return chosen
        found = self._scored(spark, at, chosen, words, mean, filter_eq).filter(F.col("score") + most >= least)
        keys = [r[0] for r in found.select(self.key).limit(LOOKUPS + 1).collect()]
        more = blocks.filter(F.col("term").isin(rest))
        return chosen.union(more if len(keys) > LOOKUPS else more.filter(_holds_one(keys)(F.col("first"), F.col("last"))))

    def vector_scores(self, spark: SparkSession, query: str,
                      filter_eq: Filter = None) -> DataFrame:
        return vector_scores(self._packed_vectors(spark), embed_literal(query, self.embedder), self.key,
                             filter_eq=filter_eq)

    def search(self, spark: SparkSession, query: str, k: int = 5,
               filter_eq: Filter = None) -> DataFrame:
        """Hybrid search: words and vectors, fused by rank."""
        return fuse(self.lexical_scores(spark, query, filter_eq),
                    self.vector_scores(spark, query, filter_eq), self.key, k)

    def answer(self, messages: DataFrame, request: str | Mapping) -> DataFrame:
        """Serve a request ``{query, columns, filter, limit}``.

        A filter is ``{"@eq": {column: value}}``, likewise ``@gte`` and ``@lte``, or ``@and``,
        ``@or`` with a list of filters, or ``@not`` with one; anything else is an error. The
        request may be JSON text; its values are data and never part of a query text.
        """
        asked = json.loads(request) if isinstance(request, str) else request
        k = int(asked.get("limit", 10))
        wanted = asked.get("filter")
        hits = self.search(messages.sparkSession, asked["query"], k, condition(wanted, self.attributes) if wanted else None)
        return attach(hits, messages, self.key, asked["columns"], k)


def _number(folders: Mapping[str, int]) -> Column:
    """The commit number of the folder at hand; there are as many as live batches."""
    return F.create_map(*(F.lit(x) for pair in folders.items() for x in pair))[F.col("batch")].cast("long")


def _since(at: Snapshot) -> Column:
    return F.coalesce(F.col("since"), _number(at.numbers("data")))


def _weight(mean: float) -> Column:
    """The highest weight of a posting of the block at hand."""
    return blocks_of.highest(lambda tf, length: term_weight(tf, length, F.lit(mean)))


def _of(words: Mapping[str, _Word], field: str) -> Column:
    """A number of the word at hand."""
    return F.create_map(*(x for w in words.values() for x in (F.lit(w.term), F.lit(getattr(w, field)))))[F.col("term")]


def _holds_one(keys: Sequence):
    """Whether one of some keys lies in a range."""
    held = np.array(sorted(keys), object)

    @F.arrow_udf("boolean")
    def holds(first: pa.Array, last: pa.Array) -> pa.Array:
        low, high = np.array(first.to_pylist(), object), np.array(last.to_pylist(), object)
        return pa.array(np.searchsorted(held, low, "left") < np.searchsorted(held, high, "right"))

    return holds


_COMPARE = {"@eq": Column.__eq__, "@gte": Column.__ge__, "@lte": Column.__le__}


def condition(wanted: Mapping, attributes: Sequence[str]) -> Column:
    """The filter of a request as a condition; an unknown operator or attribute is an error."""
    if not isinstance(wanted, Mapping) or len(wanted) != 1:
        raise ValueError(f"a filter has one operator: {wanted!r}")
    (operator, value), = wanted.items()
    if operator in ("@and", "@or"):
        parts = [condition(v, attributes) for v in value]
        if not parts:
            raise ValueError(f"{operator} needs a filter")
        return reduce(and_ if operator == "@and" else or_, parts)
    if operator == "@not":
        return ~condition(value, attributes)
    if operator not in _COMPARE:
        raise ValueError(f"unknown filter operator {operator!r}")
    unknown = [c for c in value if c not in attributes]
    if unknown or not value:
        raise ValueError(f"no filter attribute: {unknown}")
    return reduce(and_, [_COMPARE[operator](F.col(c), F.lit(v)) for c, v in value.items()])


def list_indexes(spark: SparkSession, root: str) -> DataFrame:
    return _read_meta(spark, f"{root.rstrip('/')}/indexes", _META)


def search_request(query: str, columns: Sequence[str], limit: int,
                   filter_eq: Mapping[str, object] | None = None) -> str:
    """The JSON text of a request that ``SearchIndex.answer`` takes."""
    request: dict[str, object] = {"query": query, "columns": list(columns), "limit": limit}
    if filter_eq:
        request["filter"] = {"@eq": dict(filter_eq)}
    return json.dumps(request)
