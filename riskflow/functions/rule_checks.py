"""Rule entries checked as rows: a list of violations each, before any rule is compiled.

An entry is one JSON object. What is wrong with it is found by column expressions over its
fields, so a catalogue of rules of any size is checked by a job; :func:`require_sound` is
the gate in front of a load.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskflow.functions.rules import COMPARISONS

#: Columns that a rule of the loads can name.
RULE_COLUMNS = (
    "amount", "payer_status", "payer_company_age", "payer_capital_stock", "receiver_status", "receiver_company_age",
)


class RuleErrors(ValueError):
    """Rules that cannot be compiled, with all that is wrong with them."""


def violations(entry: Column, columns: Iterable[str] = RULE_COLUMNS) -> Column:
    """What is wrong with one entry (JSON text), in a fixed order; empty for a sound one."""
    return _violations(_parts(entry), list(columns))


def _parts(entry: Column) -> dict[str, Column]:
    """What is asked of an entry: its kind, the kinds of its fields, and their texts."""
    return _parts_of(F.try_parse_json(entry))


def _parts_of(parsed: Column) -> dict[str, Column]:
    out = {"kind": F.schema_of_variant(parsed)}
    for name in ("column", "operator", "points", "value", "compare_column"):
        inner = F.try_variant_get(parsed, f"$.{name}", "variant")
        out[f"kind_{name}"] = F.coalesce(F.schema_of_variant(inner), F.lit("absent"))
    return out | {f"text_{name}": F.try_variant_get(parsed, f"$.{name}", "string")
                  for name in ("column", "operator", "reason", "compare_column")}


def _violations(parts: dict[str, Column], columns: list[str]) -> Column:
    kind = parts["kind"]

    def field(name: str) -> Column:
        return parts[f"text_{name}"]

    def kind_of(name: str) -> Column:
        return parts[f"kind_{name}"]

    def known(name: str) -> Column:
        return F.coalesce(field(name).isin(columns), F.lit(False))

    whole = kind_of("points").isin("BIGINT")
    against_value, against_column = kind_of("value") != "absent", kind_of("compare_column") != "absent"
    found = {
        "not an object": ~F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False)),
    }
    of_object = {
        "column missing": kind_of("column") == "absent",
        "column unknown": (kind_of("column") != "absent") & ~known("column"),
        "operator missing": kind_of("operator") == "absent",
        "operator unknown": (kind_of("operator") != "absent") & ~F.coalesce(field("operator").isin(*COMPARISONS), F.lit(False)),
        "points missing": kind_of("points") == "absent",
        "points not a whole number": (kind_of("points") != "absent") & ~whole,
        "reason missing": F.coalesce(field("reason"), F.lit("")) == "",
        "no operand": ~against_value & ~against_column,
        "compare_column unknown": against_column & ~known("compare_column"),
    }
    is_object = ~found["not an object"]
    found |= {name: is_object & wrong for name, wrong in of_object.items()}
    return F.array_compact(F.array(*[F.when(wrong, F.lit(name)) for name, wrong in found.items()]))


def rule_errors(entries: DataFrame, columns: Iterable[str] = RULE_COLUMNS) -> DataFrame:
    """``entry_no, violations`` of the entries (``entry_no, entry``) that have any.

    An entry is parsed once, each field is read once and the checks are decided once: each step goes
    through ``explode`` as the one element of an array, below which nothing that is asked of it is pushed.
    """
    once = lambda value, name: F.explode(F.array(value)).alias(name)
    parsed = entries.select("entry_no", once(F.try_parse_json("entry"), "parsed"))
    fields = _parts_of(F.col("parsed"))
    parts = parsed.select("entry_no", once(F.struct(*[value.alias(name) for name, value in fields.items()]), "parts"))
    known = {name: F.col(f"parts.{name}") for name in fields}
    checked = parts.select("entry_no", once(_violations(known, list(columns)), "violations"))
    return checked.where(F.size("violations") > 0)


def require_sound(spark: SparkSession, entries: Iterable[Mapping[str, Any]], columns: Iterable[str] = RULE_COLUMNS) -> None:
    """Raise :class:`RuleErrors` that names every violation of every entry of a rule file."""
    rows = [(number, json.dumps(entry, default=str)) for number, entry in enumerate(entries)]
    bad = rule_errors(spark.createDataFrame(rows, "entry_no int, entry string"), columns).orderBy("entry_no").collect()
    if bad:
        raise RuleErrors("; ".join(f"rule {r['entry_no']}: {', '.join(r['violations'])}" for r in bad))
