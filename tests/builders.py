"""Small hand-written inputs."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from riskflow.plans.loads import LoadSettings
from riskflow.schemas import REGISTRY, TRANSACTIONS

SETTINGS = LoadSettings(
    as_of=date(2024, 1, 1), run_time=datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
)
PAYER, RECEIVER = "10000000000001", "20000000000001"


def some_id(number: int) -> str:
    return str(uuid.UUID(int=number))


def payment(number: int = 1, **changes) -> tuple:
    row = {
        "transaction_id": f"trx_{some_id(number)}",
        "event_timestamp": "2023-12-31T10:00:00-03:00",
        "payer_cnpj": PAYER,
        "receiver_cnpj": RECEIVER,
        "invoice_id": "INV-1",
        "amount": 100.0,
        "payment_method": "PIX",
        "due_date": date(2024, 1, 31),
        "description": "goods",
    }
    row.update(changes)
    return tuple(row[name] for name in TRANSACTIONS.fieldNames())


def payments(spark, *rows):
    return spark.createDataFrame(list(rows), TRANSACTIONS)


def registry(spark, *rows):
    """Rows of (cnpj, status, start date, capital)."""
    return spark.createDataFrame(list(rows), REGISTRY)


def sound_registry(spark):
    return registry(
        spark,
        (PAYER, "ATIVO", "2010-01-01", 1_000_000.0),
        (RECEIVER, "ATIVO", "2010-01-01", 1_000_000.0),
    )
