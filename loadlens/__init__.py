"""Document-to-columns extraction and validation on Spark."""

from .functions.text import normalise
from .operators.extract import Ruleset, extract, extract_routed, stop_rows
from .operators.segment import stops_long, stops_ranked
from .operators.validate import accuracy, compare, error_ledger, gate, missing_loads, schema_diff
from .plans.pipeline import compare_rulesets, load, load_vendors, store_by_load, validate
from .plans.rulesets import RULESETS

__all__ = [
    "RULESETS",
    "Ruleset",
    "accuracy",
    "compare",
    "compare_rulesets",
    "error_ledger",
    "extract",
    "extract_routed",
    "gate",
    "load",
    "load_vendors",
    "missing_loads",
    "normalise",
    "schema_diff",
    "stop_rows",
    "stops_long",
    "stops_ranked",
    "store_by_load",
    "validate",
]
