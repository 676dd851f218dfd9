"""A factorisation machine over hashed words, structure statistics and metadata.

The score of features x is ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairs cost
linear time as ``1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``. Words are hashed into
``N_WORDS`` places and their counts scaled to length 1; statistics and metadata are cut into
bins of their logarithm, each bin a feature of value 1, so that pairs of them interact.

Training takes at most ``max_rows`` labelled rows (TRAIN_ROWS by default), those with the
smallest hash of their id, so the driver holds at most ``max_rows`` sparse rows of ``N_FEATURES``
features whatever the size of the tables. Scoring is one pass over whole texts.

Edge cases: a null text is an empty one and gets a score as well; null metadata has a feature of
its own; null ids are not held out; rows without a label, or with a label other than 0 and 1,
teach nothing; without labels every score is 0.5; repeated rows are each scored; an empty table
gives an empty result. Only named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwatch.llm.registered import query, table
from tierwatch.llm.words import NOT_SPACE, byte_class, chunks, count_between, of_row, words

N_WORDS = 4096
BINS = 16
N_METADATA = 256
RANK = 8
TRAIN_ROWS = 5_000
EPOCHS, BATCH, STEP, DECAY, SEED = 12, 128, 0.02, 1e-4, 7
METADATA = ("n_chars",)

_UPPER, _LOWER, _DIGITS = byte_class([(65, 90)]), byte_class([(97, 122)]), byte_class([(48, 57)])
_MARKS = byte_class([(33, 47), (58, 64), (91, 96), (123, 126)])
_SENTENCE = np.isin(np.arange(256), np.frombuffer(b".,;:?!'\"-()", np.uint8))
_BEYOND = byte_class([(0x80, 0xFF)])
STATISTICS = ("words", "upper", "lower", "digits", "symbols", "sentence_marks", "beyond_ascii", "lines", "word_length",
              "distinct", "adjacent", "commonest")
N_FEATURES = N_WORDS + BINS * len(STATISTICS) + N_METADATA


def _ratio_bins(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """0 for none, then by the logarithm of the share in thousandths."""
    share = 1000.0 * part / np.maximum(whole, 1)
    return np.clip(np.floor(np.log2(1 + share)), 0, BINS - 1).astype(np.int64)


def _size_bins(value: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.log2(1.0 + value)), 0, BINS - 1).astype(np.int64)


def _metadata_place(name: str, value: str | None) -> int:
    """Numbers go by their logarithm, other values as they are."""
    try:
        number = float(value) if value is not None else None
        label = "none" if number is None else f"{int(np.log2(1 + abs(number)))}" if np.isfinite(number) else "odd"
    except ValueError:
        label = f"={value}"
    return N_FEATURES - N_METADATA + zlib.crc32(f"{name}:{label}".encode()) % N_METADATA


@dataclass
class Sparse:
    """Rows of (feature, value); the features of row i are ``bounds[i]:bounds[i + 1]``."""

    bounds: np.ndarray
    features: np.ndarray
    values: np.ndarray


def featurize(texts: pa.Array, metadata: Sequence[tuple[str, list]]) -> Sparse:
    """Features of a small batch of texts."""
    found, n = words(texts, NOT_SPACE, lower=False), len(texts)
    data, offsets, rows = found.data, found.offsets, found.rows()
    n_words, n_bytes = np.diff(found.bounds), np.diff(offsets)
    places = (found.hashes % np.uint64(N_WORDS)).astype(np.int64)
    cells, counts = np.unique(rows * N_WORDS + places, return_counts=True)
    word_rows, word_places = cells // N_WORDS, cells % N_WORDS
    lengths = np.sqrt(np.bincount(word_rows, counts.astype(float) ** 2, minlength=n))
    values = counts / lengths[word_rows]

    first = np.unique(of_row(found.hashes, rows), return_index=True)[1]
    distinct = np.bincount(rows[first], minlength=n)
    same = (found.hashes[1:] == found.hashes[:-1]) & (rows[1:] == rows[:-1])
    adjacent = np.bincount(rows[1:][same], minlength=n) if len(rows) else np.zeros(n, np.int64)
    commonest = np.zeros(n, np.int64)
    np.maximum.at(commonest, word_rows, counts)
    of = {name: count_between(t[data], offsets) for name, t in (
        ("upper", _UPPER), ("lower", _LOWER), ("digits", _DIGITS), ("symbols", _MARKS & ~_SENTENCE),
        ("sentence_marks", _SENTENCE), ("beyond_ascii", _BEYOND))}
    bins = {"words": _size_bins(n_words), **{name: _ratio_bins(c, n_bytes) for name, c in of.items()},
            "lines": _ratio_bins(count_between(data == 10, offsets), n_words),
            "word_length": _size_bins(4 * n_bytes / np.maximum(n_words, 1)), "distinct": _ratio_bins(distinct, n_words),
            "adjacent": _ratio_bins(adjacent, n_words), "commonest": _ratio_bins(commonest, n_words)}
    fixed = [N_WORDS + BINS * i + bins[name] for i, name in enumerate(STATISTICS)]
    fixed += [np.array([_metadata_place(name, v) for v in column], np.int64).reshape(n) for name, column in metadata]

    all_rows = np.concatenate([word_rows, np.tile(np.arange(n), len(fixed))])
    features = np.concatenate([word_places, *fixed])
    values = np.concatenate([values, np.ones(n * len(fixed))])
    order = np.argsort(all_rows, kind="stable")
    return Sparse(np.searchsorted(all_rows[order], np.arange(n + 1)), features[order], values[order].astype(np.float32))


@dataclass
class Machine:
    """Weights of a trained machine: ``bias``, one weight and RANK factors per feature."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    metadata: tuple[str, ...]

    def logits(self, x: Sparse) -> np.ndarray:
        """Linear in the number of features: the sum-of-squares form of the pairs."""
        if len(x.bounds) == 1:
            return np.zeros(0)
        scaled = self.factors[x.features] * x.values[:, None]
        total = np.add.reduceat(scaled, x.bounds[:-1], axis=0)
        squares = np.add.reduceat(scaled * scaled, x.bounds[:-1], axis=0)
        linear = np.add.reduceat(self.weights[x.features] * x.values, x.bounds[:-1])
        return self.bias + linear + 0.5 * (total * total - squares).sum(axis=1)

    def probabilities(self, x: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -500, 500)))


def untrained(metadata: Sequence[str]) -> Machine:
    return Machine(0.0, np.zeros(N_FEATURES, np.float32), np.zeros((N_FEATURES, RANK), np.float32), tuple(metadata))


def fit(x: Sparse, labels: np.ndarray, metadata: Sequence[str]) -> Machine:
    """Logistic loss by Adam on small batches; deterministic."""
    made, draw = untrained(metadata), np.random.default_rng(SEED)
    if not len(labels):
        return made
    made.factors = draw.normal(0, 0.05, made.factors.shape).astype(np.float32)
    share = np.clip(labels.mean(), 0.01, 0.99)
    made.bias = float(np.log(share / (1 - share)))
    parameters = [made.weights, made.factors]
    first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(draw.permutation(len(labels)), max(1, len(labels) // BATCH)):
            dense = np.zeros((len(rows), N_FEATURES), np.float32)
            for i, row in enumerate(rows):
                at = slice(x.bounds[row], x.bounds[row + 1])
                dense[i, x.features[at]] = x.values[at]
            total, squared = dense @ made.factors, dense * dense
            logit = made.bias + dense @ made.weights + 0.5 * (total ** 2 - squared @ made.factors ** 2).sum(axis=1)
            error = ((1 / (1 + np.exp(-logit)) - labels[rows]) / len(rows)).astype(np.float32)
            pulled = (error[:, None] * squared).sum(axis=0)[:, None] * made.factors
            slopes = [dense.T @ error, dense.T @ (error[:, None] * total) - pulled]
            step += 1
            made.bias -= STEP * float(error.sum())
            for p, slope, a, b in zip(parameters, slopes, first, second):
                slope = slope + DECAY * p
                a += 0.1 * (slope - a)
                b += 0.001 * (slope * slope - b)
                p -= STEP * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return made


def _batch_features(texts: pa.Array, metadata: Sequence[tuple[str, pa.Array]]):
    for row, part in chunks(texts):
        yield featurize(part, [(name, column.slice(row, len(part)).to_pylist()) for name, column in metadata])


def sparse_features(text: Column, metadata: Sequence[str]) -> Column:
    """``struct<features array<int>, values array<float>>`` of a text and its metadata."""
    names = tuple(metadata)

    @F.arrow_udf("features array<int>, values array<float>")
    def features(texts: pa.Array, *columns: pa.Array) -> pa.Array:
        parts = list(_batch_features(texts, list(zip(names, columns))))
        sizes = np.concatenate([np.diff(p.bounds) for p in parts] or [np.zeros(0, np.int64)])
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([getattr(p, f) for p in parts] or [np.zeros(0)]).astype(t)))
                 for f, t in (("features", np.int32), ("values", np.float32))]
        return pa.StructArray.from_arrays(lists, names=["features", "values"])

    return features(text, *[F.col(m).cast("string") for m in names])


def train(docs: DataFrame, labels: DataFrame, metadata: Sequence[str] = METADATA, max_rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Machine:
    """A machine from a bounded sample of labelled rows; ``labels`` holds what may be learnt from."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")).filter(
        F.col("__label").isin(0, 1) & F.col("__id").isNotNull())
    chosen = known.orderBy(F.md5(F.col("__id").cast("string")), "__id", "__label").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), *metadata)
    found = rows.join(F.broadcast(chosen), "__id").select(  # at most max_rows rows of two numbers
        "__id", "__label", sparse_features(F.col("__text"), metadata).alias("x"))
    # Ids may repeat in either table: the sample is bounded once more after the join.
    sample = found.orderBy(F.md5(F.col("__id").cast("string")), "__id", "__label").limit(max_rows).toArrow()
    x = sample.column("x").combine_chunks() if len(sample) else None
    if x is None:
        return untrained(metadata)
    lists = x.field("features")
    sparse = Sparse(lists.offsets.to_numpy().astype(np.int64), lists.flatten().to_numpy().astype(np.int64),
                    x.field("values").flatten().to_numpy())
    return fit(sparse, sample.column("__label").to_numpy().astype(np.float32), metadata)


def score(machine: Machine, text: Column) -> Column:
    """The probability of label 1, from 0 to 1."""

    @F.arrow_udf("double")
    def probability(texts: pa.Array, *columns: pa.Array) -> pa.Array:
        parts = [machine.probabilities(x) for x in _batch_features(texts, list(zip(machine.metadata, columns)))]
        return pa.array(np.concatenate(parts or [np.zeros(0)]).astype(np.float64))

    return probability(text, *[F.col(m).cast("string") for m in machine.metadata])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def learnt_from(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Machine:
    labels = table(spark, sf_dir, "labels")
    return train(docs, labels.filter(~held_out(F.col("doc_id"))))


@query()
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score(learnt_from(spark, sf_dir, docs), F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
