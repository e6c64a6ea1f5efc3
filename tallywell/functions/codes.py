"""Expansion of abbreviated codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywell.functions.names import literal_map

# Colour abbreviations.
COLORS = {
    "AL": "Aluminum", "AM": "Amber", "BG": "Beige", "BK": "Black",
    "BL": "Blue", "BN": "Brown", "BR": "Brown", "BZ": "Bronze",
    "CH": "Charcoal", "DK": "Dark", "GD": "Gold", "GO": "Gold",
    "GN": "Green", "GY": "Gray", "GT": "Granite", "IV": "Ivory",
    "LT": "Light", "OL": "Olive", "OR": "Orange", "MR": "Maroon",
    "PK": "Pink", "RD": "Red", "RE": "Red", "SI": "Silver", "SL": "Silver",
    "SM": "Smoke", "TN": "Tan", "VT": "Violet", "WT": "White", "WH": "White",
    "YL": "Yellow", "YE": "Yellow", "UN": "Unknown",
}


def expand_codes(code: Column, names: dict[str, str] = COLORS) -> Column:
    """Long name of ``code``; a code without one stays as it is, null stays null."""
    return F.coalesce(F.try_element_at(literal_map(names), code), code)
