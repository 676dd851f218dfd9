"""Files that tasks write by themselves, in a folder that driver and executors share."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Hadoop knows it from the session's settings."""
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(location).toString()


def _opened(folder: str):
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri("s3://" + folder.removeprefix("s3a://") if folder.startswith("s3a://") else folder)


def append_file(folder: str, prefix: str, rows: pa.Table) -> None:
    """Add a Parquet file to a folder. Readers do not see it before it is whole."""
    import pyarrow.parquet as pq

    files, path = _opened(folder)
    name = f"{prefix}{uuid.uuid4().hex}.parquet"
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/_{name}") as out:  # a hidden name
        pq.write_table(rows, out)
    files.move(f"{path}/_{name}", f"{path}/{name}")


def read_files(folder: str, prefix: str) -> list[pa.Table]:
    """The files that ``append_file`` has added with a prefix."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    files, path = _opened(folder)
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    names = sorted(f.path for f in found if f.base_name.startswith(prefix) and f.base_name.endswith(".parquet"))
    return [pq.read_table(files.open_input_file(name)) for name in names]
