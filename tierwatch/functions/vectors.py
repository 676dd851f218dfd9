"""Vector similarity."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from tierwatch.functions.embedding import float_lists, unit_rows
from tierwatch.functions.ratios import safe_ratio


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vector columns, computed in double.

    0.0 when one is the zero vector; null when one is null, misses an element, or their
    lengths differ.
    """
    product = _dot(a, b)
    value = safe_ratio(product, F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))
    return F.when((F.size(a) == F.size(b)) & product.isNotNull(), value)


def vector_rows(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of the valid rows, valid) of a batch of vectors.

    A vector that is null, of another length or with a missing element is not valid.
    """
    lengths = pc.fill_null(pc.list_value_length(vectors), -1)
    valid = pc.equal(lengths, dim).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(vectors.filter(pa.array(valid))).cast(pa.float64()).to_numpy(zero_copy_only=False)
    rows = flat.reshape(-1, dim) if dim else np.zeros((int(valid.sum()), 0))
    whole = ~np.isnan(rows).any(axis=1)
    valid[np.flatnonzero(valid)[~whole]] = False
    return rows[whole], valid


def cosine_to(vector: Column, query: Sequence[float]) -> Column:
    """Cosine of a vector column, of arrays or packed, with one known vector.

    Null for a vector of another length or with a missing element.

    One matrix product per Arrow batch: per element this is far cheaper than a chain of
    interpreted higher-order functions.
    """
    dim = len(query)
    target = unit_rows(np.asarray([query], dtype=np.float64))[0]

    @F.arrow_udf("double")
    def compare(vectors: pa.Array) -> pa.Array:
        rows, valid = vector_rows(float_lists(vectors), dim)
        scores = np.zeros(len(vectors))
        scores[valid] = unit_rows(rows) @ target
        return pa.array(scores, mask=~valid)

    return compare(vector)


def has_length(vector: Column, dim: int) -> Column:
    """True for a vector of ``dim`` non-null values."""
    return F.coalesce((F.size(vector) == dim) & F.forall(vector, lambda x: x.isNotNull()), F.lit(False))
