"""From scored rows to the fact table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from riskflow.functions.fingerprint import canonical_uuid, payload_hash, strip_prefix
from riskflow.operators import landed
from riskflow.operators.keyindex import write_filter, write_keys
from riskflow.operators.landed import landed_loads, number_of
from riskflow.schemas import FACT, FACT_KEY, FACT_TABLE
from riskflow.sources.tables import CODEC, exists, make_folder, read_or_empty, remove_files, subfolders

_LOAD = "load_seq="
#: Below the fact table, one folder per micro-batch that has not landed: owner, micro-batch, number.
_STREAMS = "_streams"
#: Stored next to the fact columns: number of the input file that a row came in.
FILE_SEQ = "file_seq"


def fingerprinted(transactions: DataFrame, amount_style: str = "positional") -> DataFrame:
    """Strip the id prefix, then hash the payload, then bring the id into UUID form.

    The hash covers the id as it was written. An id that is not a UUID is left as it is
    for the landing check to report.
    """
    written_id = F.col("transaction_id")
    return (
        transactions.withColumn("transaction_id", strip_prefix(written_id))
        .withColumn("payload_hash", payload_hash(amount_style))
        .withColumn("transaction_id", F.coalesce(canonical_uuid(written_id), written_id))
    )


def to_fact(scored: DataFrame, run_time: datetime, *more: str) -> DataFrame:
    """The thirteen fact columns in order and type, and ``more`` as they are. Capital is cast
    directly, never through text."""
    stamped = scored.withColumn("processed_at", F.lit(run_time))
    return stamped.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in FACT.fields], *more
    )


def new_rows(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose (id, payload) is not stored, each pair once."""
    return rows.dropDuplicates(FACT_KEY).join(stored.select(*FACT_KEY), FACT_KEY, "left_anti")


def read_fact(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The landed loads of the fact table; ``before`` leaves out that load and later ones.

    Folders of loads that are not in the manifest are pruned by the semi join, in which the manifest is broadcast: the rows
    stay where they are, whatever is known of its size. The number of
    calls that the driver makes does not depend on the number of loads.
    """
    loads = landed_loads(spark, path, before).select("load_seq")
    rows = read_or_empty(spark, path, FACT_TABLE)
    return rows.join(F.broadcast(loads), "load_seq", "left_semi").select(*FACT_TABLE.fieldNames())


def read_load(spark: SparkSession, path: str, load_seq: int) -> DataFrame:
    """Rows of one load with ``file_seq``, the input file they came in; landed or not."""
    stored = StructType([*FACT.fields, StructField(FILE_SEQ, IntegerType())])
    return read_or_empty(spark, f"{path}/{_LOAD}{load_seq}", stored)


def _numbers(folders: list[str]) -> list[int]:
    return sorted(int(name.removeprefix(_LOAD)) for name in folders if name.startswith(_LOAD))


def _claimed(spark: SparkSession, path: str) -> dict[tuple[str, int], int]:
    """Load number by owner and micro-batch, of micro-batches that have not landed."""
    parts = (name.rsplit(".", 2) for name in subfolders(spark, f"{path}/{_STREAMS}"))
    return {(owner, int(micro_batch)): int(number) for owner, micro_batch, number in parts}


def _claim(owner: str, micro_batch: int, number: int) -> str:
    return f"{owner}.{micro_batch}.{number}"


def next_load_seq(spark: SparkSession, path: str) -> int:
    """A number above those of all loads, begun ones and those given to streams included."""
    begun = _numbers(subfolders(spark, path))
    return 1 + max([*begun, *_claimed(spark, path).values()], default=-1)


def stream_load_seq(spark: SparkSession, path: str, owner: str, micro_batch: int) -> int:
    """Number of the load that a micro-batch writes: the same one when it is run again.

    It is noted next to the loads before it is used, so no other writer is given it. The
    note goes when the load lands, as the manifest then names the micro-batch.
    """
    known = _claimed(spark, path).get((owner, micro_batch))
    if known is None:
        known = number_of(spark, path, owner, micro_batch)
    if known is not None:
        return known
    number = next_load_seq(spark, path)
    make_folder(spark, f"{path}/{_STREAMS}/{_claim(owner, micro_batch, number)}")
    return number


def write_load(
    fact_rows: DataFrame,
    path: str,
    load_seq: int,
    owner: str | None = None,
    micro_batch: int | None = None,
    with_filter: bool = False,
) -> int:
    """Publish one load (with ``file_seq``), as a whole or not at all; gives its rows.

    Rows first, then their keys, then the entry in the manifest that makes both count. Rows
    and the range of ids are observed while they are written. Writing the same load again takes it
    back first and then replaces it, so a retried load leaves one copy.
    """
    spark, folder = fact_rows.sparkSession, f"{path}/{_LOAD}{load_seq}"
    if exists(spark, folder):
        landed.record(spark, path, load_seq, False)
    seen = Observation()
    fact_rows.observe(
        seen, F.count(F.lit(1)).alias("rows"),
        F.min("transaction_id").alias("first_id"), F.max("transaction_id").alias("last_id"),
    ).write.mode("overwrite").parquet(folder, compression=CODEC)
    measured = seen.get
    stored = read_load(spark, path, load_seq)
    write_keys(stored, path, load_seq, measured["rows"])
    if with_filter:
        write_filter(stored, path, load_seq)
    landed.record(spark, path, load_seq, True, owner, micro_batch, **measured)
    if owner is not None:
        remove_files(spark, f"{path}/{_STREAMS}", [_claim(owner, micro_batch, load_seq)])
    return measured["rows"]
