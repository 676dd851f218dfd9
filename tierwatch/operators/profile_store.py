"""Profiles that grow with batches: small sketches per batch and column, merged without reading the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: HyperLogLog with 2 ** 14 registers: a standard error of 0.8 % of the number of different values.
DISTINCT_LG, DISTINCT_ERROR = 14, 0.008
#: Quantiles by KLL with ``k`` = 1000: ranks are off by less than 0.35 %, with a confidence of 99 %.
QUANTILE_K, RANK_ERROR = 1000, 0.0035


class ProfileStore:
    """One folder a batch, written anew when the batch comes again; a row a column, whatever the size of the batch."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def add(self, rows: DataFrame, batch: int, columns: Sequence[str], numbers: Sequence[str] = ()) -> None:
        """Profile a batch in one pass: rows, nulls and different values of ``columns``, quantiles of ``numbers`` as well."""
        def sketches(name: str) -> Column:
            value, known = F.col(name), F.col(name).isNotNull()
            spread = F.kll_sketch_agg_double(value.cast("double"), F.lit(QUANTILE_K)) if name in numbers else F.lit(None).cast("binary")
            return F.struct(F.lit(name).alias("column"), F.count("*").alias("n"), F.count_if(~known).alias("n_null"),
                            F.hll_sketch_agg(F.xxhash64(value), F.lit(DISTINCT_LG)).alias("distinct"), spread.alias("quantiles"))

        wanted = [*columns, *(c for c in numbers if c not in columns)]
        # A null has a hash too; it is told from the values afterwards.
        found = rows.agg(F.array(*(sketches(c) for c in wanted)).alias("found"))
        found.select(F.inline("found")).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def merged(self, spark: SparkSession, ranks: Sequence[float] = (0.1, 0.5, 0.9), batches: Sequence[int] | None = None) -> DataFrame:
        """``column, n, n_null, n_distinct, uniqueness, quantiles`` of some batches, or of all; distinct values and quantiles are estimates.

        ``quantiles`` is null for other columns than numbers, and where no value is known.
        """
        stored = spark.read.parquet(self.root)
        stored = stored if batches is None else stored.filter(F.col("batch").isin(list(batches)))
        merged = stored.groupBy("column").agg(
            F.sum("n").alias("n"), F.sum("n_null").alias("n_null"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("_distinct"), F.kll_merge_agg_double("quantiles").alias("_quantiles"),
            F.bool_or(F.col("quantiles").isNotNull()).alias("_numbers"))
        known = F.col("n") - F.col("n_null")
        distinct = F.least(F.greatest(F.col("_distinct") - (F.col("n_null") > 0).cast("long"), F.lit(0)), known)
        quantiles = F.when(F.col("_numbers") & (known > 0), F.kll_sketch_get_quantile_double("_quantiles", F.array(*(F.lit(float(r)) for r in ranks))))
        return merged.select("column", "n", "n_null", distinct.alias("n_distinct"),
                             F.coalesce(F.try_divide(distinct.cast("double"), known.cast("double")), F.lit(0.0)).alias("uniqueness"),
                             quantiles.alias("quantiles"))
