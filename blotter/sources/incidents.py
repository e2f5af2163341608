"""Incident files: typed CSV load, the text-line variant, and an exporter.

The incident CSV has 28 columns. Two generations of the file differ only in
the header (one spells ``AREA`` with a trailing blank), so the loader maps
columns **by position** through an explicit schema and canonicalises the
names once; downstream code never sees back-ticked names. Dates are parsed
with ``try_to_timestamp`` and numbers with ``try_cast``: a malformed value
becomes null instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from blotter.functions.timeparts import US_TIMESTAMP_FORMAT, parse_us_timestamp
from blotter.sources.layouts import read_by_header
from blotter.sources.records import read_quoted_records

# The incident file header, in file order (the older file
# writes "AREA " with a trailing blank; two columns carry no usable name).
INCIDENT_HEADER = (
    "DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA", "AREA NAME", "Rpt Dist No", "Part 1-2",
    "Crm Cd", "Crm Cd Desc", "Mocodes", "Vict Age", "Vict Sex", "Vict Descent", "Premis Cd",
    "Premis Desc", "Weapon Used Cd", "Weapon Desc", "Status", "Status Desc", "Crm Cd 1", "Crm Cd 2",
    "Crm Cd 3", "Crm Cd 4", "extra_1", "extra_2", "LAT", "LON",
)

# Our canonical snake_case names, position by position.
INCIDENT_COLUMNS = (
    "incident_id", "reported_raw", "occurred_raw", "hhmm", "area", "area_name", "district", "part",
    "crime_code", "crime_desc", "mocodes", "victim_age_raw", "victim_sex", "victim_code", "premise_code",
    "premise", "weapon_code", "weapon_desc", "status", "status_desc", "crime_code_1", "crime_code_2",
    "crime_code_3", "crime_code_4", "extra_1", "extra_2", "lat_raw", "lon_raw",
)

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in INCIDENT_COLUMNS])

# Columns of the typed incident frame, in order.
TYPED_COLUMNS = (
    "incident_id", "reported_on", "occurred_on", "hhmm", "area", "victim_age", "victim_code",
    "premise", "weapon_code", "lat", "lon",
)


def typed_incidents(raw: DataFrame) -> DataFrame:
    """Cast the raw string columns; keep the ones the queries use."""
    return raw.select(
        "incident_id",
        parse_us_timestamp("reported_raw").alias("reported_on"),
        parse_us_timestamp("occurred_raw").alias("occurred_on"),
        "hhmm",
        "area",
        F.col("victim_age_raw").try_cast("int").alias("victim_age"),
        "victim_code",
        "premise",
        "weapon_code",
        F.col("lat_raw").try_cast("double").alias("lat"),
        F.col("lon_raw").try_cast("double").alias("lon"),
    )


def read_incidents_raw(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """All files in one scan, columns by position, all strings.

    ``enforceSchema`` applies our schema regardless of each file's header
    spelling, which is what makes the two generations union cleanly.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.schema(RAW_SCHEMA)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )


def load_incidents(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """Typed union of incident files (any Hadoop file system path)."""
    return typed_incidents(read_incidents_raw(spark, paths, multiline))


def read_incidents_by_header(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """The raw string columns by the names in each file's header, whatever their order, with the malformed text and the file of each row."""
    return read_by_header(spark, paths, dict(zip(INCIDENT_COLUMNS, INCIDENT_HEADER)), multiline, required=("incident_id",))


def load_incidents_by_header(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """Typed union of incident files whose columns may stand in any order; a column that a file lacks is null."""
    return typed_incidents(read_incidents_by_header(spark, paths, multiline))


def load_incidents_text(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """Line-wise variant: read text lines and decode each with ``from_csv``.

    Quoted commas are honoured. A quoted line break splits a record unless ``multiline`` is set: records are then cut across lines and across
    the splits of a file (:mod:`blotter.sources.records`), which stays splittable. Header lines are
    dropped by value, blank lines as the CSV reader drops them; a record
    without an id stays.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    ddl = ", ".join(f"`{c}` STRING" for c in INCIDENT_COLUMNS)
    lines = read_quoted_records(spark, paths) if multiline else spark.read.text(paths).filter(F.length(F.trim("value")) > 0)
    parsed = lines.select(F.from_csv(F.col("value"), ddl).alias("r")).select("r.*")
    return typed_incidents(parsed.filter(~F.col("incident_id").eqNullSafe(F.lit(INCIDENT_HEADER[0]))))


def write_incident_csv(df: DataFrame, path: str, area_header: str = "AREA") -> None:
    """Write a frame with ``INCIDENT_COLUMNS`` (strings) in the incident file layout."""
    header = list(INCIDENT_HEADER)
    header[INCIDENT_HEADER.index("AREA")] = area_header
    out = df.select(*[F.col(c).cast("string").alias(h) for c, h in zip(INCIDENT_COLUMNS, header)])
    out.write.mode("overwrite").option("header", True).csv(path)


__all__ = [
    "INCIDENT_COLUMNS",
    "INCIDENT_HEADER",
    "RAW_SCHEMA",
    "TYPED_COLUMNS",
    "US_TIMESTAMP_FORMAT",
    "load_incidents",
    "load_incidents_by_header",
    "load_incidents_text",
    "read_incidents_by_header",
    "read_incidents_raw",
    "typed_incidents",
    "write_incident_csv",
]
