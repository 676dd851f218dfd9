"""Versioned feature views and models on shared storage.

One folder per name and version. A version's metadata lives beside its data, so
registering or deleting one never rewrites a table that others append to.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwatch.session import delete_folder

_FEATURE_META = ("name string, version string, entity string, join_keys string, ts_column string, "
                 "refresh_freq string, description string, columns string")
_MODEL_META = ("name string, version string, task string, comment string, features string, "
               "metrics string, sample_schema string")


def _write_meta(spark: SparkSession, path: str, row: tuple, schema: str) -> None:
    (spark.createDataFrame([row], schema).withColumn("registered_at", F.current_timestamp().cast("timestamp_ntz"))
     .coalesce(1).write.mode("overwrite").json(path))


def _read_meta(spark: SparkSession, root: str, schema: str) -> DataFrame:
    full = schema + ", registered_at timestamp_ntz"
    try:
        return spark.read.schema(full).json(f"{root}/*/*/meta").orderBy("name", "version")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: str
    join_keys: Sequence[str]
    ts_column: str
    refresh_freq: str = "1 day"
    description: str = ""
    column_descriptions: Mapping[str, str] = field(default_factory=dict)


class FeatureRegistry:
    def __init__(self, root: str):
        self.root = f"{root.rstrip('/')}/features"

    def _path(self, name: str, version: str, part: str) -> str:
        return f"{self.root}/{name}/{version}/{part}"

    def register(self, view: FeatureView, df: DataFrame, version: str, overwrite: bool = True) -> None:
        """Store the rows of a feature view version, then its description."""
        for column in (*view.join_keys, view.ts_column):
            if column not in df.columns:
                raise ValueError(f"{column} is not a column of the feature view")
        columns = {c: view.column_descriptions.get(c, "") for c in df.columns}
        df.write.mode("overwrite" if overwrite else "errorifexists").parquet(self._path(view.name, version, "data"))
        _write_meta(df.sparkSession, self._path(view.name, version, "meta"),
                    (view.name, version, view.entity, ",".join(view.join_keys), view.ts_column,
                     view.refresh_freq, view.description, json.dumps(columns)), _FEATURE_META)

    def load(self, spark: SparkSession, name: str, version: str) -> DataFrame:
        return spark.read.parquet(self._path(name, version, "data"))

    def data_path(self, name: str, version: str) -> str:
        return self._path(name, version, "data")

    def list(self, spark: SparkSession) -> DataFrame:
        return _read_meta(spark, self.root, _FEATURE_META)

    def columns(self, spark: SparkSession) -> DataFrame:
        """One row per feature view column with its description."""
        return self.list(spark).select(
            "name", "version", F.explode(F.from_json("columns", "map<string,string>")).alias("column", "description"))


class ModelRegistry:
    def __init__(self, root: str):
        self.root = f"{root.rstrip('/')}/models"

    def _path(self, name: str, version: str, part: str) -> str:
        return f"{self.root}/{name}/{version}/{part}"

    def log(self, model: PipelineModel, name: str, version: str, features: Sequence[str],
            metrics: Mapping[str, float], sample: DataFrame, comment: str = "",
            task: str = "TABULAR_BINARY_CLASSIFICATION") -> None:
        """Store a model version with its metrics, inputs and the schema of its input sample."""
        spark = sample.sparkSession
        model.write().overwrite().save(self._path(name, version, "model"))
        sample.write.mode("overwrite").parquet(self._path(name, version, "sample"))
        _write_meta(spark, self._path(name, version, "meta"),
                    (name, version, task, comment, ",".join(features), json.dumps(dict(metrics)),
                     sample.schema.simpleString()), _MODEL_META)

    def load(self, name: str, version: str) -> PipelineModel:
        return PipelineModel.load(self._path(name, version, "model"))

    def delete(self, spark: SparkSession, name: str) -> bool:
        """Drop every version of a model; false when there is none."""
        return delete_folder(spark, f"{self.root}/{name}")

    def list(self, spark: SparkSession) -> DataFrame:
        return _read_meta(spark, self.root, _MODEL_META)

    def metrics(self, spark: SparkSession) -> DataFrame:
        """One row per model version and metric."""
        return self.list(spark).select(
            "name", "version", F.explode(F.from_json("metrics", "map<string,double>")).alias("metric", "value"))
