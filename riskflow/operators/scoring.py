"""Rule points, reason codes and the mutation penalty."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskflow.functions.rules import Rule, risk_score, score_reasons

#: Penalty of rows flagged ``mutated``; it comes after all other rules. Fixed values.
MUTATION = Rule("mutated", "==", 75, "payload_mutation_detected", value=True)


def score(enriched: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``risk_score`` and ``score_reasons``."""
    return enriched.withColumns(
        {"risk_score": risk_score(rules), "score_reasons": score_reasons(rules)}
    )


def score_history(enriched: DataFrame, rules: list[Rule]) -> DataFrame:
    """:func:`score` for rows with a resolved history, penalty included."""
    return score(enriched, [*rules, MUTATION])


def rule_points(enriched: DataFrame, rules: list[Rule]) -> DataFrame:
    """One column of points per rule, named after its reason."""
    return enriched.withColumns({rule.reason: rule.score() for rule in rules})
