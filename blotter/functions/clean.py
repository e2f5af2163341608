"""String cleaning for zone keys and money amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def zip_prefix(col, sep: str = "-") -> Column:
    """``90731-7232`` -> ``90731``: the part before the first separator."""
    return F.split_part(_c(col), F.lit(sep), F.lit(1))


def clean_money(col) -> Column:
    """``$33,887`` -> 33887: drop every non-digit, then int; empty gives null."""
    return F.regexp_replace(_c(col), r"[^0-9]", "").try_cast("int")

