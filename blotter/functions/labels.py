"""Category code -> label lookup as a literal map (JVM-side, no UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Victim descent codes and their labels, in code order.
DESCENT_LABELS: dict[str, str] = {
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


def label_map(mapping: dict[str, str] = DESCENT_LABELS) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def code_to_label(col, mapping: dict[str, str] = DESCENT_LABELS) -> Column:
    """Label for a code; unknown or null codes give null (also under ANSI)."""
    c = col if isinstance(col, Column) else F.col(col)
    return F.try_element_at(label_map(mapping), c)


def label_case_sql(col_sql: str, mapping: dict[str, str] = DESCENT_LABELS) -> str:
    """The same lookup as a SQL CASE expression (for SQL twins and oracles)."""
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col_sql} {arms} END"
