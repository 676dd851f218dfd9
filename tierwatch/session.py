"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Every one of these is a default only: what the cluster sets wins.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts are wide rows: smaller Arrow batches keep Python workers small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_BATCH_ROWS, _SPARK_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
#: Whole texts are wide rows: so many in an Arrow batch keep the buffers on both sides small.
TEXT_BATCH_ROWS = "1000"


def batch_texts(spark: SparkSession) -> None:
    """Give a session that has left Spark's default batch size in place one for texts."""
    if spark.conf.get(_BATCH_ROWS) == _SPARK_DEFAULT:
        spark.conf.set(_BATCH_ROWS, TEXT_BATCH_ROWS)


def build_session(app_name: str = "tierwatch", **overrides: str) -> SparkSession:
    """A session with this package's defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def working_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return "file:" + tempfile.mkdtemp(prefix="tierwatch-")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{working_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used for a result that is costly and read several times; the lineage is cut and a
    lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder on any Hadoop file system; false when there was none."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any Hadoop file system; none if there is no such folder."""
    files, location = _file_system(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(location)] if files.exists(location) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, location = _file_system(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all of its content at once; false, and nothing done, if there is one already.

    The content is written aside and renamed. The rename must fail where the name is taken, as it does on HDFS; a
    store without such a rename needs one writer at a time.
    """
    from py4j.protocol import Py4JJavaError

    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    files, location = _file_system(spark, aside)
    stream = files.create(location, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    context = hadoop.FileContext.getFileContext(location.toUri() if location.toUri().getScheme() else files.getUri(),
                                                spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(location), files.makeQualified(hadoop.Path(path)), none)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        files.delete(location, False)
        return False
