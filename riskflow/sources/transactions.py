"""Transaction files and their order."""

from __future__ import annotations

import re
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from riskflow.schemas import TRANSACTIONS
from riskflow.sources.tables import qualified

#: What counts as one load: a Parquet file, or a folder of part files.
UNITS = ("file", "folder")


def load_name(spark: SparkSession, uri: str, unit: str, root: str | None) -> str:
    """Name of a file's load: its path below ``root``, so loads of equal names in different folders
    stay apart; without a root its last name."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}: {unit!r}")
    path = _decoded(uri)
    if unit == "folder":
        path = path.rpartition("/")[0]
    return path.rpartition("/")[2] if root is None else path.removeprefix(f"{_decoded(qualified(spark, root))}/")


def _decoded(uri: str) -> str:
    return unquote(urlparse(uri).path).rstrip("/")


def paths(transactions: DataFrame) -> list[str]:
    """Files of a scan as its rows name them, from the listing the driver holds anyway; of a
    micro-batch, whose frame has none, the files that its rows come from."""
    listed = transactions.inputFiles()
    if listed:
        return [re.sub("^file:/+", "file:/", uri) for uri in listed]
    return [row["path"] for row in transactions.select("path").distinct().collect()]


def _columns() -> list[Column]:
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row_index")]
    return [*[F.col(name) for name in TRANSACTIONS.fieldNames()], *place]


def read_transactions(spark: SparkSession, path: str | list[str], unit: str = "file") -> DataFrame:
    """Input columns, ``path`` (of the file a row came in) and ``row_index`` (its place there).

    Unused columns, also these two, are never read.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}: {unit!r}")
    reader = spark.read.schema(TRANSACTIONS).option("pathGlobFilter", "*.parquet")
    if unit == "folder":
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(*([path] if isinstance(path, str) else path)).select(*_columns())


def stream_transactions(
    spark: SparkSession, path: str, unit: str = "file", max_files: int | None = 1
) -> DataFrame:
    """The same as a stream; files are taken in the order they were written.

    With one file per step every file is a load of its own. Folder loads leave
    ``max_files`` open and deliver one folder between two steps.
    """
    reader: DataStreamReader = spark.readStream.schema(TRANSACTIONS).option(
        "pathGlobFilter", "*.parquet"
    )
    if unit == "folder":
        reader = reader.option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(*_columns())


def load_names(transactions: DataFrame, path: str, unit: str = "file") -> list[str]:
    """Names of all loads below ``path`` in name order, empty ones included."""
    spark = transactions.sparkSession
    return sorted({load_name(spark, uri, unit, path) for uri in paths(transactions)})


def files_of(transactions: DataFrame, unit: str = "file", root: str | None = None) -> DataFrame:
    """``path, file, file_seq`` of every file, numbered from 0 in the order of the loads' names.

    A local table of one row per file: no row of a scan is read or named for it.
    """
    spark = transactions.sparkSession
    named = [(uri, load_name(spark, uri, unit, root)) for uri in paths(transactions)]
    number = {name: k for k, name in enumerate(sorted({name for _, name in named}))}
    return spark.createDataFrame([(u, n, number[n]) for u, n in named], "path string, file string, file_seq int")


def file_order(transactions: DataFrame, unit: str = "file", root: str | None = None) -> DataFrame:
    """``file``, ``file_seq`` and ``total_rows`` of the loads that have rows. Reads no data column."""
    counts = transactions.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    known = counts.join(F.broadcast(files_of(transactions, unit, root)), "path")
    return known.groupBy("file", "file_seq").agg(F.sum("rows").alias("total_rows"))


def with_file_seq(transactions: DataFrame, unit: str = "file", root: str | None = None) -> DataFrame:
    """Add ``file`` and ``file_seq``. The broadcast is the listing, which the driver holds already:
    a join by shuffle would put each file's rows into one task."""
    return transactions.join(F.broadcast(files_of(transactions, unit, root)), "path", "inner")
