"""Null gate, landing constraints and key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.functions.fingerprint import canonical_uuid, strip_prefix
from riskflow.schemas import FACT_KEY, HASH_FIELDS, TRANSACTIONS

# Text lengths and number sizes of the fact table.
TEXT_LIMITS = {"payer_cnpj": 14, "receiver_cnpj": 14, "payer_status": 100, "receiver_status": 100}
NUMBER_LIMITS = {
    "amount": "decimal(15,2)",
    "payer_company_age": "decimal(5,2)",
    "receiver_company_age": "decimal(5,2)",
    "payer_capital_stock": "decimal(19,2)",
}
#: Fact columns that follow from the company of a role alone, and those that the input itself decides.
COMPANY_CHECKS = {
    "payer": ("payer_status", "payer_company_age", "payer_capital_stock"),
    "receiver": ("receiver_status", "receiver_company_age"),
}
INPUT_CHECKS = ("transaction_id", "payer_cnpj", "receiver_cnpj", "amount", "payload_hash")


def null_counts(rows: DataFrame, by: str | None = None) -> DataFrame:
    """Row count and nulls per input column, for all rows or per load.

    Written as plain counts: one pass with partial sums, and a session with the v2
    Parquet reader and ``spark.sql.parquet.aggregatePushdown`` answers the ungrouped
    form from the file footers.
    """
    measures = [F.count(F.lit(1)).alias("total_rows")] + [
        (F.count(F.lit(1)) - F.count(name)).alias(f"null_{name}")
        for name in TRANSACTIONS.fieldNames()
    ]
    return rows.groupBy(by).agg(*measures) if by else rows.agg(*measures)


def has_nulls(report: DataFrame) -> Column:
    """Over a :func:`null_counts` report: whether the load has to be rejected."""
    return reduce(or_, (F.col(f"null_{name}") > 0 for name in TRANSACTIONS.fieldNames()))


def require_no_nulls(rows: DataFrame, load: str | None = None) -> DataFrame:
    """Pass rows through, failing the job on the first one with a null input column.

    The check runs inside the scan of the load itself. A load is published as a whole,
    so nothing of a rejected one becomes visible and no extra pass is needed.
    """
    names = TRANSACTIONS.fieldNames()
    where = F.coalesce(F.col(load), F.lit("?")) if load else F.lit("input")
    listing = F.array_join(
        F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names])), ", "
    )
    message = F.concat(where, F.lit(": null values in "), listing)
    complete = reduce(or_, (F.col(n).isNull() for n in names)) == F.lit(False)
    return rows.where(F.when(complete, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def _constraints() -> dict[str, Column]:
    """What must hold for each fact column that can be refused. Null means refused."""
    text = {name: F.length(name) <= size for name, size in TEXT_LIMITS.items()}
    numbers = {name: F.col(name).try_cast(kind).isNotNull() for name, kind in NUMBER_LIMITS.items()}
    return {
        "transaction_id": canonical_uuid(F.col("transaction_id")).isNotNull(),
        **text,
        **numbers,
        "payload_hash": F.col("payload_hash").isNotNull(),
    }


def landing_violations(names: Sequence[str] | None = None) -> Column:
    """Names of the fact columns (of ``names``) whose value the fact table would refuse, as an array."""
    return F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(held, F.lit(False)), F.lit(name))
                for name, held in _constraints().items()
                if names is None or name in names
            ]
        )
    )


def sound_input() -> Column:
    """Whether a row as it was delivered will pass the ``INPUT_CHECKS``: asked before it is fingerprinted.

    A fingerprint is null only where one of its fields is.
    """
    held = {name: check for name, check in _constraints().items() if name in INPUT_CHECKS}
    held["transaction_id"] = canonical_uuid(strip_prefix(F.col("transaction_id"))).isNotNull()
    held["payload_hash"] = reduce(and_, (F.col(name).isNotNull() for name in HASH_FIELDS))
    return reduce(and_, (F.coalesce(check, F.lit(False)) for check in held.values()))


def with_violations(rows: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows with their ``violations`` (of ``names``), decided once.

    The array goes through ``explode`` as the one element of another: what is asked of it
    later is not pushed below a generator, which would copy all checks into each filter.
    """
    return rows.select("*", F.explode(F.array(landing_violations(names))).alias("violations"))


def require_landable(rows: DataFrame) -> DataFrame:
    """Fail the job on the first row the fact table would refuse."""
    message = F.concat(
        F.coalesce("transaction_id", F.lit("?")),
        F.lit(": not landable because of "),
        F.array_join("violations", ", "),
    )
    sound = F.when(F.size("violations") == 0, F.lit(True))
    return with_violations(rows).where(
        sound.otherwise(F.raise_error(message).cast("boolean"))
    ).drop("violations")


def split_landable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that land, and the others with their ``violations``."""
    marked = with_violations(rows)
    found = F.size("violations")
    return marked.where(found == 0).drop("violations"), marked.where(found > 0)


def duplicate_keys(fact: DataFrame) -> DataFrame:
    """Keys held by more than one fact row; empty for a sound table."""
    return fact.groupBy(*FACT_KEY).count().where(F.col("count") > 1)
