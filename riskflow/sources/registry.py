"""The company registry: raw records, snapshots, the expiring cache and lookups."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskflow.functions.dates import cache_expiry
from riskflow.schemas import REGISTRY, REGISTRY_CACHE, REGISTRY_JSON_FIELDS
from riskflow.sources.tables import read_or_empty, written


def parse_registry_json(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw (``cnpj``, ``raw``) records into valid registry rows and rejected ones.

    The two text fields must be JSON strings and the capital a number or numeric text;
    a missing, null or mistyped field rejects the record.
    """
    parsed = records.withColumn("_record", F.try_parse_json("raw"))

    def text(name: str) -> Column:
        path = f"$.{REGISTRY_JSON_FIELDS[name]}"
        kind = F.schema_of_variant(F.try_variant_get("_record", path, "variant"))
        return F.when(kind == "STRING", F.try_variant_get("_record", path, "string"))

    capital = F.try_variant_get(
        "_record", f"$.{REGISTRY_JSON_FIELDS['capital_stock']}", "double"
    )
    fields = parsed.select(
        "cnpj",
        "raw",
        text("status").alias("status"),
        text("activity_start_date").alias("activity_start_date"),
        capital.alias("capital_stock"),
    )
    complete = (
        F.col("status").isNotNull()
        & F.col("activity_start_date").isNotNull()
        & F.col("capital_stock").isNotNull()
    )
    valid = fields.where(complete).select(
        "cnpj", "status", "activity_start_date", F.col("capital_stock").cast("float").alias("capital_stock")
    )
    return valid, fields.where(~complete).select("cnpj", "raw")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(path)


def live_cache(cache: DataFrame, now: Column) -> DataFrame:
    """Entries that have not expired, without the expiry."""
    return cache.where(F.col("expires_at") > now).select(*REGISTRY.fieldNames())


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, REGISTRY_CACHE)


def split_cache(companies: DataFrame, live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Registry rows found in the cache, and the companies that are missing from it."""
    return live.join(companies, "cnpj", "left_semi"), companies.join(live, "cnpj", "left_anti")


def cache_stats(companies: DataFrame, live: DataFrame) -> DataFrame:
    """Hits, misses and the hit rate in per cent (0 without companies) in one row."""
    marked = companies.join(live.select("cnpj", F.lit(True).alias("_hit")), "cnpj", "left")
    hits = F.count("_hit")
    total = F.count(F.lit(1))
    return marked.agg(
        hits.alias("hits"),
        (total - hits).alias("misses"),
        F.coalesce(F.round(F.try_divide(hits * 100.0, total), 1), F.lit(0.0)).alias("hit_rate"),
    )


def fresh_entries(found: DataFrame, live: DataFrame, now: Column) -> DataFrame:
    """Cache rows for newly found companies: set only where absent, one per company."""
    return (
        found.select(*REGISTRY.fieldNames())
        .dropDuplicates(["cnpj"])
        .join(live.select("cnpj"), "cnpj", "left_anti")
        .withColumn("expires_at", cache_expiry(now))
    )


def merged(hits: DataFrame, fetched: DataFrame) -> DataFrame:
    """Cached and fetched registry rows. The two share no company, so nothing is shuffled."""
    return hits.unionByName(fetched.select(*REGISTRY.fieldNames()))


def fetch_missing(
    misses: DataFrame, fetch: Callable[[str], str], in_flight: int = 30, attempts: int = 3
) -> DataFrame:
    """Look missing companies up with a caller-supplied ``fetch(cnpj) -> JSON text``.

    Each of ``in_flight`` partitions looks up one company at a time, so no more run at
    once. A company that fails ``attempts`` times fails the job. Gives (``cnpj``,
    ``raw``) for :func:`parse_registry_json`.
    """

    def lookup(cnpj: str) -> str:
        for attempt in range(1, attempts):
            try:
                return fetch(cnpj)
            except Exception:  # any failure of the caller's client is worth another try
                time.sleep(0.1 * 2**attempt)
        return fetch(cnpj)

    def look_up_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(raw=[lookup(cnpj) for cnpj in frame["cnpj"]])

    return misses.select("cnpj").repartition(in_flight).mapInPandas(
        look_up_all, "cnpj string, raw string"
    )


def refresh_cache(
    companies: DataFrame,
    cache_path: str,
    find: Callable[[DataFrame], DataFrame],
    now: Column,
) -> DataFrame:
    """Registry rows of the ``companies``, looking up and caching the missing ones.

    ``find`` maps the missing companies to registry rows: a join with a snapshot, or
    :func:`fetch_missing`. What it finds is appended to the cache first and everything is
    read from there, so a lookup is not repeated when a task is. One writer at a time.
    """
    spark = companies.sparkSession
    asked = written(companies.select("cnpj"), "asked-companies")
    live = live_cache(read_cache(spark, cache_path), now)
    misses = written(split_cache(asked, live)[1], "missing-companies")
    if not misses.isEmpty():
        fresh_entries(find(misses), live, now).write.mode("append").parquet(cache_path)
    return split_cache(asked, live_cache(read_cache(spark, cache_path), now))[0]


def from_snapshot(snapshot: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A ``find`` for :func:`refresh_cache` that takes the rows of a registry table."""
    return lambda misses: snapshot.join(misses, "cnpj", "left_semi")
