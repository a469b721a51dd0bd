"""Quality predicates and flag texts.

Three meanings of "valid" exist side by side and differ on code 4; each has its own name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Declared flag lists, thresholds and texts.
VALID_FLAGS = [1, 2, 3]
INVALID_FLAGS = [-1, -99]
MIN_DATA_CAPTURE_PCT = 75.0
VALIDITY_TEXT = {
    1: "Valid",
    2: "Valid (below detection limit)",
    3: "Valid (below detection limit + ...)",
    -1: "Not valid",
    -99: "Not valid (station maintenance)",
}
VERIFICATION_TEXT = {1: "Verified", 2: "Preliminary verified", 3: "Not verified"}
DATASET_TEXT = {
    1: "E2a (Up-To-Date/UTD)",
    2: "E1a (Verified)",
    3: "Airbase (Historical)",
}


def at_least_valid(validity: Column) -> Column:
    """``validity >= 1``, the rule of the daily aggregate; NULL is not valid."""
    return validity >= 1


def strictly_valid(validity: Column) -> Column:
    """``validity = 1``, the rule of the quality report."""
    return validity == 1


def declared_valid(validity: Column) -> Column:
    return validity.isin(VALID_FLAGS)


def declared_invalid(validity: Column) -> Column:
    return validity.isin(INVALID_FLAGS)


def enough_capture(data_capture: Column, minimum: float = MIN_DATA_CAPTURE_PCT) -> Column:
    return data_capture >= F.lit(minimum)


def hourly(aggregation_type: Column) -> Column:
    return aggregation_type == "hour"


def text_of(code: Column, texts: dict[int, str]) -> Column:
    """Code to its declared text, NULL for codes without one."""
    pairs = [F.lit(part) for item in texts.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), code)
