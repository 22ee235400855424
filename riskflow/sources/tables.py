"""Parquet tables: reading one that may not exist yet, and working tables that cut lineage.

Results that are read more than once, or that must not change when an executor is
lost, are written to the shared folder the cluster names in ``spark.checkpoint.dir``
and read back. Where a session names none, the checkpoint folder of the context is used; a
local master without either gets a temporary folder, any other one an error.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_LOCAL_FALLBACK: list[str] = []
#: Compression of payments and fact rows: ids and fingerprints are hexadecimal text, which only entropy coding shortens.
CODEC = "zstd"
#: Working tables made since :func:`working_tables` was entered, if it was.
_OPENED: ContextVar[list[str] | None] = ContextVar("opened", default=None)


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    if not _LOCAL_FALLBACK:
        _LOCAL_FALLBACK.append(tempfile.mkdtemp(prefix="riskflow-"))
    return _LOCAL_FALLBACK[0]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses. It is not created."""
    return f"{shared_root(spark)}/riskflow-{purpose}-{uuid.uuid4().hex}"


def written(frame: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write a frame as a shared table and read it back: runs one job. The session's compression holds unless named."""
    path = new_folder(frame.sparkSession, purpose)
    opened = _OPENED.get()
    if opened is not None:
        opened.append(path)
    frame.write.parquet(path, compression=codec)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def configured(spark: SparkSession, key: str, value: str):
    """A session setting that holds in this block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def working_tables(spark: SparkSession):
    """Remove the tables that :func:`written` makes in this block (and thread) when it ends, however it ends."""
    mine: list[str] = []
    token = _OPENED.set(mine)
    try:
        yield
    finally:
        _OPENED.reset(token)
        for path in mine:
            remove_files(spark, path, [""])


def _files(spark: SparkSession, path: str):
    """File system of a path, the path, and a function for paths below it."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, root, lambda name: jvm.org.apache.hadoop.fs.Path(root, name)


def qualified(spark: SparkSession, path: str) -> str:
    """A path as a URI without a slash at its end."""
    system, root, _ = _files(spark, path)
    return system.makeQualified(root).toUri().toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    system, root, _ = _files(spark, path)
    return system.exists(root)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, from one listing; none if it is absent."""
    system, root, _ = _files(spark, path)
    if not system.exists(root):
        return []
    return [found.getPath().getName() for found in system.listStatus(root) if found.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files in a folder, from one listing; none if it is absent."""
    system, root, _ = _files(spark, path)
    if not system.exists(root):
        return []
    names = [found.getPath().getName() for found in system.listStatus(root) if found.isFile()]
    return [name for name in names if not name.startswith(("_", "."))]


def remove_files(spark: SparkSession, path: str, names: list[str]) -> None:
    """Delete files (or folders with all they hold) of a folder, itself if a name is empty; absent
    ones are no error."""
    system, root, below = _files(spark, path)
    for name in names:
        system.delete(below(name) if name else root, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, root, _ = _files(spark, path)
    if not system.mkdirs(root):
        raise OSError(f"cannot create {path}")


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, or an empty frame of the same schema before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
