"""Codes, labels and padding."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the victim descent codes.
DESCENT_LABELS = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
}


def has_prefix(code: Column, prefix: str) -> Column:
    """Whether the text of a code starts with ``prefix`` (for ``1``: 1, 10-19, 100-199, ..)."""
    return code.cast("string").startswith(prefix)


def decode(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code; a code without a label stays as it is, null stays null.

    For a short dictionary. Join a lookup table for a long one, see `decode_by_table`.
    """
    if not labels:
        return code
    pairs = F.create_map(*[F.lit(text) for text in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(pairs, code), code)


def pad(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Turn the named columns into text, left-justified to the given widths."""
    return df.withColumns({name: F.format_string(f"%-{w}s", name) for name, w in widths.items()})
