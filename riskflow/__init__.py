"""Risk scoring of payments between companies, on Spark DataFrames."""

from riskflow.functions.rules import Rule, load_rules
from riskflow.operators.landing import read_fact
from riskflow.plans.loads import LoadSettings, load_folder, load_rows
from riskflow.streaming.ingest import start as start_stream

__all__ = [
    "LoadSettings",
    "Rule",
    "load_folder",
    "load_rows",
    "load_rules",
    "read_fact",
    "start_stream",
]
