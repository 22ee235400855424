"""Declarative risk rules: YAML in, two Spark columns out."""

from __future__ import annotations

import json
import operator
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import Column, functions as F

DEFAULT_RULES = Path(__file__).resolve().parent.parent / "config" / "rules.yaml"

COMPARISONS: dict[str, Callable[[Any, Any], Any]] = {
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}


@dataclass(frozen=True)
class Rule:
    """``column <operator> operand`` is worth ``points`` and gives ``reason``."""

    column: str
    operator: str
    points: int
    reason: str
    value: Any = None
    compare_column: str | None = None

    def __post_init__(self) -> None:
        if self.operator not in COMPARISONS:
            raise ValueError(f"{self.operator!r} is none of the comparisons {list(COMPARISONS)}")
        if isinstance(self.points, bool) or not isinstance(self.points, int):
            raise ValueError(f"points of {self.reason} must be a whole number: {self.points!r}")

    @classmethod
    def from_mapping(cls, entry: Mapping[str, Any]) -> Rule:
        """Check one rule of the file; a missing key raises ``KeyError`` with its name."""
        against_column = "compare_column" in entry
        return cls(
            column=entry["column"],
            operator=entry["operator"],
            points=entry["points"],
            reason=entry["reason"],
            value=None if against_column else entry["value"],
            compare_column=entry["compare_column"] if against_column else None,
        )

    def condition(self) -> Column:
        """Three-valued: a null operand makes the condition null, never true."""
        operand = (
            F.lit(self.value) if self.compare_column is None else F.col(self.compare_column)
        )
        return COMPARISONS[self.operator](F.col(self.column), operand)

    def score(self) -> Column:
        return F.when(self.condition(), self.points).otherwise(0)


def load_rules(path: str | Path = DEFAULT_RULES) -> list[Rule]:
    """Read a rule file. It is job configuration, read once on the driver."""
    with open(path, encoding="utf-8") as handle:
        return [Rule.from_mapping(entry) for entry in yaml.safe_load(handle)["rules"]]


def risk_score(rules: Iterable[Rule]) -> Column:
    """Sum of the points of all rules that hold."""
    return reduce(operator.add, (rule.score() for rule in rules), F.lit(0)).cast("int")


def score_reasons(rules: Iterable[Rule]) -> Column:
    """Reason codes of the rules that hold, in rule order, as a JSON array.

    Codes are quoted when the rules are compiled, so a row only joins literals.
    """
    found = [F.when(rule.condition(), F.lit(json.dumps(rule.reason))) for rule in rules]
    return F.concat(F.lit("["), F.concat_ws(",", *found), F.lit("]"))
