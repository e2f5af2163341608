"""Dates, clock times and part-of-day bins as native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The incident files write dates as 12-hour US timestamps.
US_TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"

# Part-of-day bins on HHMM integers, inclusive bounds, and the
# label for anything that falls in none of them (the night bin really ends at
# 04:59; its label is kept as the reference prints it).
DAYPART_BINS: tuple[tuple[str, tuple[tuple[int, int], ...]], ...] = (
    ("05:00-11:59", ((500, 1159),)),
    ("12:00-16:59", ((1200, 1659),)),
    ("17:00-20:59", ((1700, 2059),)),
    ("21:00-03:59", ((0, 459), (2100, 2359))),
)
DAYPART_OTHER = "Null"

# Part-of-day by the first two characters of HHMM.
HOUR_PREFIX_BINS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("morning", ("05", "06", "07", "08", "09", "10", "11")),
    ("afternoon", ("12", "13", "14", "15", "16")),
    ("evening", ("17", "18", "19", "20")),
    ("night", ("21", "22", "23", "00", "01", "02", "03", "04")),
)


def parse_us_timestamp(col, fmt: str = US_TIMESTAMP_FORMAT) -> Column:
    """Parse a 12-hour US timestamp string to a DATE; malformed input gives null."""
    c = col if isinstance(col, Column) else F.col(col)
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def format_us_timestamp(col, fmt: str = US_TIMESTAMP_FORMAT) -> Column:
    c = col if isinstance(col, Column) else F.col(col)
    return F.date_format(c, fmt)


def hhmm_of(ts) -> Column:
    """Clock time of a timestamp as a 4-character HHMM string."""
    c = ts if isinstance(ts, Column) else F.col(ts)
    return F.date_format(c, "HHmm")


def daypart(hhmm, bins: Sequence = DAYPART_BINS, other: str = DAYPART_OTHER) -> Column:
    """Label of the first bin holding int(HHMM); null or unparseable input gets ``other``."""
    c = hhmm if isinstance(hhmm, Column) else F.col(hhmm)
    t = c.try_cast("int")
    out = None
    for label, ranges in bins:
        cond = None
        for lo, hi in ranges:
            part = t.between(lo, hi)
            cond = part if cond is None else (cond | part)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(other))


def hour_prefix_part(hhmm, bins: Sequence = HOUR_PREFIX_BINS) -> Column:
    """Label by the first two characters of HHMM; no match gives null."""
    c = hhmm if isinstance(hhmm, Column) else F.col(hhmm)
    prefix = F.substring(c, 1, 2)
    out = None
    for label, values in bins:
        cond = prefix.isin(*values)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def year_range(col, year: int) -> Column:
    """``year(col) = year`` written as a range, so it reaches the Parquet scan."""
    c = col if isinstance(col, Column) else F.col(col)
    return (c >= F.lit(f"{year}-01-01").cast("date")) & (c < F.lit(f"{year + 1}-01-01").cast("date"))
