"""The registry cache as a log of versions: entries are appended, the newest live one of a company holds.

``version=N/expires_on=DAY`` folders hold what refresh N added. A reader lists only days that
have not passed, so expired entries cost nothing, and takes the newest version per company
in an aggregate. Compaction writes the live entries as one new version and then removes the older
ones; a reader in between sees entries twice and takes the newer, equal one.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.schemas import REGISTRY_CACHE
from riskflow.sources.tables import read_or_empty, remove_files, subfolders, written

_VERSION = "version="
_STORED = REGISTRY_CACHE.simpleString()[len("struct<"):-1].replace(":", " ") + ", version long, expires_on date"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions, from one listing."""
    return sorted(int(n.removeprefix(_VERSION)) for n in subfolders(spark, path) if n.startswith(_VERSION))


def append(entries: DataFrame, path: str) -> int:
    """Add entries (the columns of the cache) as a version of their own; gives its number."""
    version = 1 + max(versions(entries.sparkSession, path), default=-1)
    dated = entries.select(*REGISTRY_CACHE.fieldNames(), F.to_date("expires_at").alias("expires_on"))
    # Days are few; entries of a day are spread by company, so that no day is one task.
    dated.write.partitionBy("expires_on").parquet(f"{path}/{_VERSION}{version}")
    return version


def live(spark: SparkSession, path: str, now: datetime) -> DataFrame:
    """The newest entry of each company that has not expired at ``now``."""
    at = F.lit(now)
    stored = read_or_empty(spark, path, spark.createDataFrame([], _STORED).schema)
    fresh = stored.where((F.col("expires_on") >= F.to_date(at)) & (F.col("expires_at") > at))
    rest = [name for name in REGISTRY_CACHE.fieldNames() if name != "cnpj"]
    newest = F.max(F.struct("version", "expires_at", *[n for n in rest if n != "expires_at"])).alias("newest")
    return fresh.groupBy("cnpj").agg(newest).select("cnpj", *[F.col("newest")[n].alias(n) for n in rest])


def compact(spark: SparkSession, path: str, now: datetime) -> int:
    """Rewrite the live entries as one version and remove the older ones; gives its number."""
    older = versions(spark, path)
    version = append(written(live(spark, path, now), "live-cache"), path)
    remove_files(spark, path, [f"{_VERSION}{n}" for n in older])
    return version
