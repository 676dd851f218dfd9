"""File scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierwatch.sources.contract import Checked, conform
from tierwatch.sources.csv_records import csv_records
from tierwatch.sources.schemas import MESSAGES, REJECT_REASON, TRAINING_PAIRS

_CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             lengths: Mapping[str, int] | None = None, multi_line: bool = True, split: bool = False) -> Checked:
    """CSV with a header, optional quotes and empty values as null, split by ``schema``.

    Every value is read as text and cast by the contract, so a bad row is kept with its
    reason instead of vanishing. Spark reads a file with line breaks inside quotes in one task.
    ``split`` reads it in many, at the price of reading it twice; see ``csv_records`` for what it asks of quotes.
    ``multi_line=False`` is for files without such values.
    """
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                              + [T.StructField(_CORRUPT, T.StringType())])
    options = dict(sep=",", quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, nullValue="", emptyValue="")
    if split:
        parsed = F.from_csv("record", F.lit(raw_schema.toDDL()), options)
        raw = csv_records(spark, path).select(parsed.alias("_row")).select("_row.*")
    else:
        raw = spark.read.csv(path, schema=raw_schema, header=True, multiLine=multi_line, enforceSchema=True, **options)
    cells = {f.name: F.nullif(F.col(f.name), F.lit("")) for f in schema.fields}
    marked = raw.withColumns(cells).withColumn(
        REJECT_REASON, F.when(F.col(_CORRUPT).isNotNull(), "wrong number of columns"))
    return conform(marked, schema, lengths)


def read_messages(spark: SparkSession, path: str, multi_line: bool = True, split: bool = False) -> Checked:
    """The message table from CSV: ``(accepted, rejected)``."""
    return read_csv(spark, path, MESSAGES, multi_line=multi_line, split=split)


def read_pairs(spark: SparkSession, path: str) -> Checked:
    """Prompt/completion pairs from JSON lines: ``(accepted, rejected)``.

    A value of another type is taken as text, as a path extraction with a cast would. A
    line that is not JSON, or that lacks one of the two, is kept with its reason.
    """
    names = [f.name for f in TRAINING_PAIRS.fields]
    lines = spark.read.text(path).withColumn("_row", F.try_parse_json("value"))
    read = lines.withColumns({n: F.try_variant_get("_row", f"$.{n}", "string") for n in names})
    missing = [F.when(F.col(n).isNull(), f"{n} is missing") for n in names]
    reason = F.when(F.col("_row").isNull(), "not JSON").otherwise(F.nullif(F.concat_ws("; ", *missing), F.lit("")))
    judged = read.withColumn(REJECT_REASON, reason)
    return Checked(judged.filter(F.col(REJECT_REASON).isNull()).select(*names),
                   judged.filter(F.col(REJECT_REASON).isNotNull()).select("value", REJECT_REASON))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name and size of the files below a path; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select(F.col("path").alias("name"), F.col("length").alias("size"))
            .orderBy("name"))


def rows_to_table(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """A small table from rows in memory (lookups, requests)."""
    return spark.createDataFrame(list(rows), schema)
