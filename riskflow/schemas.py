"""Declared schemas and column lists. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_text = T.StringType()

TRANSACTIONS = _struct(
    ("transaction_id", _text),
    ("event_timestamp", _text),
    ("payer_cnpj", _text),
    ("receiver_cnpj", _text),
    ("invoice_id", _text),
    ("amount", T.DoubleType()),
    ("payment_method", _text),
    ("due_date", T.DateType()),
    ("description", _text),
)

REGISTRY = _struct(
    ("cnpj", _text),
    ("status", _text),
    ("activity_start_date", _text),
    ("capital_stock", T.FloatType()),
)

REGISTRY_CACHE = T.StructType(
    [*REGISTRY.fields, T.StructField("expires_at", T.TimestampType(), True)]
)

# The registry's JSON record. Field names of the public company registry.
REGISTRY_JSON_FIELDS = {
    "status": "descricao_situacao_cadastral",
    "activity_start_date": "data_inicio_atividade",
    "capital_stock": "capital_social",
}

FACT = _struct(
    ("transaction_id", _text),
    ("payer_cnpj", _text),
    ("receiver_cnpj", _text),
    ("amount", T.DecimalType(15, 2)),
    ("payer_status", _text),
    ("receiver_status", _text),
    ("payer_company_age", T.DecimalType(5, 2)),
    ("receiver_company_age", T.DecimalType(5, 2)),
    ("payer_capital_stock", T.DecimalType(19, 2)),
    ("risk_score", T.IntegerType()),
    ("score_reasons", _text),
    ("payload_hash", _text),
    ("processed_at", T.TimestampType()),
)

#: The fact table as stored: one directory per load.
FACT_TABLE = T.StructType([*FACT.fields, T.StructField("load_seq", T.LongType(), True)])

#: The manifest of landed loads: the newest entry of a load holds.
LANDED_LOADS = _struct(
    ("load_seq", T.LongType()),
    ("entry_no", T.LongType()),
    ("landed", T.BooleanType()),
    ("owner", _text),
    ("micro_batch", T.LongType()),
    ("rows", T.LongType()),
    ("first_id", _text),
    ("last_id", _text),
)

#: Stored keys, in folders by load and hash bucket of the id.
KEY_INDEX = _struct(
    ("transaction_id", _text), ("payload_hash", _text),
    ("load_seq", T.LongType()), ("bucket", T.IntegerType()),
)

#: Membership bitmaps per load and part of the hash space.
KEY_FILTERS = _struct(("part", T.LongType()), ("ids", T.BinaryType()), ("load_seq", T.LongType()))

#: The ledger of input files that have landed.
FINISHED_INPUTS = _struct(
    ("file", _text), ("path", _text), ("size", T.LongType()), ("digest", _text), ("load_seq", T.LongType())
)

FINAL_COLUMNS = FACT.fieldNames()

#: One row per (id, payload) lands in the fact table.
FACT_KEY = ["transaction_id", "payload_hash"]

# The fields of the payload fingerprint, in this order.
HASH_FIELDS = [
    "transaction_id",
    "payer_cnpj",
    "receiver_cnpj",
    "amount",
    "invoice_id",
    "description",
]

#: Append-only audit events; ``operators.audit.current_state`` folds them.
AUDIT_EVENTS = _struct(
    ("batch_id", _text),
    ("event_no", T.IntegerType()),
    ("status", _text),
    ("file", _text),
    ("total_rows", T.LongType()),
    ("inserted_rows", T.LongType()),
    ("started_at", T.TimestampType()),
    ("finished_at", T.TimestampType()),
)
