"""Proportional stratified interleaving: shards that all have the mixture of the whole.

Rows are shuffled within each source by a seeded hash and ranked; row r of n gets the
fractional rank (2 r - 1) / (2 n). Sorted by that, every stretch of the order holds the sources
in proportion, and cutting it into equal stretches gives shards whose counts are at most one
apart (the law ``rows``).

Both ranks are found without a sorted whole: hashes and fractional ranks are spread evenly, so
equal intervals of them are groups of bounded, even size, whatever one source holds. Counts
per interval give each interval's first rank, and a window ranks within it.

Edge cases: null texts have size 8 and crc32 0; null sources form a stratum of their own; equal
rows are ordered by id and content and otherwise interchangeable; an empty table gives an empty
result; fewer rows than shards leave shards empty. Only named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tierwatch.llm.registered import query, table
from tierwatch.session import materialize

ROWS_PER_INTERVAL = 20_000
HASH_BITS = 56
SEED = "mixture-1"
N_SHARDS = 24


def seeded_hash(seed: str, *columns: Column) -> Column:
    """Even over 0 to 2**56 - 1; the first 14 hexadecimal digits of an md5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[c.cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _ranked(rows: DataFrame, within: list[str], interval: str, order: list[str], into: str, total: str) -> DataFrame:
    """Adds the 1-based rank in ``order`` among rows equal in ``within``, and their number."""
    keys = [*within, interval]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*within)
    before = whole.orderBy(interval).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                           F.sum("__n").over(whole).alias(total))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (rows.withColumn("__place", place).join(counts, keys)
            .withColumn(into, F.col("__place") + F.col("__before")).drop("__place", "__before"))


def interleave(docs: DataFrame, n_shards: int = N_SHARDS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", rows_per_interval: int = ROWS_PER_INTERVAL) -> DataFrame:
    """``doc_id, size, text_crc32, stratum, fraction, shard, slot`` for every row."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null")).alias("stratum"))
    rows = materialize(narrow.withColumn("shuffled", seeded_hash(seed, F.col("doc_id"), F.col("text_crc32"))), "shard-rows")
    n = rows.count()
    intervals = max(1, -(-n // rows_per_interval))
    ties = ["shuffled", "doc_id", "text_crc32", "size"]
    width = -(-(1 << HASH_BITS) // intervals)
    rows = rows.withColumn("__interval", F.floor(F.col("shuffled") / F.lit(width).cast("double")))
    ranked = _ranked(rows, ["stratum"], "__interval", ties, "__rank", "__of").drop("__interval")
    fraction = (2 * F.col("__rank") - 1) / (2 * F.col("__of"))
    ranked = materialize(ranked.withColumn("fraction", fraction).drop("__rank", "__of"), "shard-fractions")
    # Intervals are counted by one short window: their number is that of all rows by rows_per_interval.
    ranked = ranked.withColumns({"__all": F.lit(0), "__interval": F.floor(F.col("fraction") * intervals)})
    placed = _ranked(ranked, ["__all"], "__interval", ["fraction", "stratum", *ties], "__rank", "__of")
    at, of = F.col("__rank") - 1, F.col("__of")
    shard = F.expr(f"(__rank - 1) * {n_shards} div __of")
    first = F.expr(f"(__shard * __of + {n_shards} - 1) div {n_shards}")
    return placed.withColumn("__shard", shard).select(
        "doc_id", "size", "text_crc32", "stratum", "fraction", F.col("__shard").cast("int").alias("shard"),
        (at - first).alias("slot"))


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
