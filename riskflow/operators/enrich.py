"""Company attributes for both roles of a transaction."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from riskflow.functions.dates import company_age
from riskflow.functions.fingerprint import with_packed_keys, with_unpacked_keys
from riskflow.operators.quality import COMPANY_CHECKS, landing_violations
from riskflow.operators.skew import BROADCAST_ROWS, HOT_ROWS, attach, fits, hot_part, hottest
from riskflow.schemas import FACT_KEY
from riskflow.sources.tables import written


def with_company_age(registry: DataFrame, as_of: date) -> DataFrame:
    """Replace the start date by the age, hold capital in single precision, one row per company.

    Of several rows of a company the one with the latest start date counts, then the
    greatest status and capital, so a lookup never multiplies a payment. Copies collapse
    before the shuffle.
    """
    latest = F.max(F.struct("activity_start_date", "status", "capital_stock")).alias("_latest")
    single = registry.groupBy("cnpj").agg(latest).select("cnpj", "_latest.*")
    return single.select(
        "cnpj",
        "status",
        company_age(F.col("activity_start_date"), F.lit(as_of)).alias("company_age"),
        F.col("capital_stock").cast("float").alias("capital_stock"),
    )


def payer_view(aged: DataFrame) -> DataFrame:
    return aged.select(
        F.col("cnpj").alias("payer_cnpj"),
        F.col("status").alias("payer_status"),
        F.col("company_age").alias("payer_company_age"),
        F.col("capital_stock").alias("payer_capital_stock"),
    )


def receiver_view(aged: DataFrame) -> DataFrame:
    """No rule looks at a receiver's capital, so it stays out of the join."""
    return aged.select(
        F.col("cnpj").alias("receiver_cnpj"),
        F.col("status").alias("receiver_status"),
        F.col("company_age").alias("receiver_company_age"),
    )


def distinct_companies(transactions: DataFrame) -> DataFrame:
    """Every company on either side, once, in one scan."""
    both = F.explode(F.array("payer_cnpj", "receiver_cnpj")).alias("cnpj")
    return transactions.select(both).distinct()


@dataclass(frozen=True)
class Lookups:
    """Registry rows for the companies of a batch, by role, and whether each role's fit a broadcast.

    ``met`` (``role, cnpj, count``) are the companies of the batch, ``hot`` the registry rows of its hot ones; both
    only where the whole registry does not fit.
    """

    payers: DataFrame
    receivers: DataFrame
    few_payers: bool = True
    few_receivers: bool = True
    met: DataFrame | None = None
    hot: DataFrame | None = None


def lookups(
    sides: DataFrame, aged: DataFrame, broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS
) -> Lookups:
    """What ``sides``, a frame with the companies of all rows, needs of ``aged``, one row per company.

    Counts the registry up to ``broadcast_rows`` first. Of one beyond that each role gets a table of the companies that
    the batch has in it: one narrow aggregate, which also finds those with more than ``hot_rows`` rows.
    """
    if fits(aged, broadcast_rows):
        return Lookups(payer_view(aged), receiver_view(aged))
    met = _companies_met(sides)

    def needed(role: str) -> DataFrame:
        some = met.where(F.col("role") == role).select("cnpj")
        return written(aged.join(some, "cnpj", "left_semi"), f"{role}-companies")

    payers, receivers = payer_view(needed("payer")), receiver_view(needed("receiver"))
    few = fits(payers, broadcast_rows), fits(receivers, broadcast_rows)
    hot = None if all(few) else _hot_companies(met, aged, hot_rows)
    return Lookups(payers, receivers, *few, met, hot)


def enrich(
    transactions: DataFrame,
    aged: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    sides: DataFrame | None = None,
) -> DataFrame:
    """Left join payer and receiver attributes; ``aged`` has one row per company.

    Companies are counted in ``sides``, a frame with the companies of at least these rows, if it can be read cheaper.
    """
    return attributed(
        transactions, lookups(transactions if sides is None else sides, aged, broadcast_rows, hot_rows)
    )


def attributed(transactions: DataFrame, known: Lookups, packed: bool = False) -> DataFrame:
    """Left join of both roles. What fits is broadcast; the other role is joined by shuffle, with the hot
    companies broadcast. Keys travel packed; those that are ``packed`` already are unpacked once that is done."""
    keyed = packed or (set(FACT_KEY) <= set(transactions.columns) and not (known.few_payers and known.few_receivers))
    rows = with_packed_keys(transactions) if keyed and not packed else transactions
    if known.few_payers:
        rows = rows.join(F.broadcast(known.payers), "payer_cnpj", "left")
    else:
        rows = attach(rows, known.payers, "payer_cnpj", payer_view(known.hot), _spread(transactions, "payer_cnpj"))
    if known.few_receivers:
        rows = rows.join(F.broadcast(known.receivers), "receiver_cnpj", "left")
    else:
        rows = attach(
            rows, known.receivers, "receiver_cnpj", receiver_view(known.hot), _spread(transactions, "receiver_cnpj")
        )
    return with_unpacked_keys(rows) if keyed else rows


def unsound_companies(known: Lookups) -> tuple[DataFrame, DataFrame]:
    """Payers and receivers of the batch with which no row can land, as tables; those without a registry row included."""

    def refused(role: str, registered: DataFrame) -> DataFrame:
        key = f"{role}_cnpj"
        some = known.met.where(F.col("role") == role).select(F.col("cnpj").alias(key)).join(registered, key, "left")
        return written(some.where(F.size(landing_violations(COMPANY_CHECKS[role])) > 0).select(key), f"unsound-{role}s")

    return refused("payer", known.payers), refused("receiver", known.receivers)


def _companies_met(transactions: DataFrame) -> DataFrame:
    per_role = F.explode(
        F.array(
            F.struct(F.lit("payer").alias("role"), F.col("payer_cnpj").alias("cnpj")),
            F.struct(F.lit("receiver").alias("role"), F.col("receiver_cnpj").alias("cnpj")),
        )
    ).alias("side")
    counts = transactions.select(per_role).groupBy("side").count()
    return written(counts.select("side.role", "side.cnpj", "count"), "companies-met")


def _hot_companies(met: DataFrame, aged: DataFrame, hot_rows: int) -> DataFrame:
    per_company = met.where(F.col("count") > hot_rows).groupBy("cnpj").agg(F.max("count").alias("count"))
    hot = hottest(written(per_company, "hot-companies"), hot_rows).select("cnpj")
    return written(hot_part(aged, hot, "cnpj"), "hot-registry")


def _spread(transactions: DataFrame, key: str) -> list[str]:
    return [name for name in transactions.columns if name != key]
