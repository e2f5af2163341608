"""CSV files whose columns stand in different orders: columns by the names in each file's own header.

Spark reads one header for all files of a scan, and an enforced schema goes by position: a file with swapped columns would load under the wrong names. Here the
header line of each file is read first (one line a file, by threads on the driver, as a listing is), files are grouped by their header, and each group is one
scan with the schema of that header. The groups are united by name.

Rows whose number of values isn't that of their header are malformed: they stay, with what could be read, and their text is in ``CORRUPT``.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT, FILE = "_malformed", "_file"
_THREADS = 16


def _first_line(spark: SparkSession, uri: str) -> str:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = reader.readLine()
        while line is not None and not line.strip():  # the CSV reader skips blank lines too
            line = reader.readLine()
        return line or ""
    finally:
        reader.close()


def header_of(line: str) -> tuple[str, ...]:
    """The names of a header line as they are compared: without blanks around them, a byte order mark, and in small letters."""
    names = next(csv.reader([line.removeprefix("﻿")]), [])
    return tuple(n.strip().lower() for n in names)


def files_by_header(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below the paths, grouped by their headers; empty files are left out."""
    files = sorted(spark.read.text([paths] if isinstance(paths, str) else list(paths)).inputFiles())
    with ThreadPoolExecutor(_THREADS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line:
            out.setdefault(header_of(line), []).append(file)
    return out


def read_by_header(spark: SparkSession, paths: str | Sequence[str], columns: Mapping[str, str], multiline: bool = False, required: Sequence[str] = ()) -> DataFrame:
    """The string columns ``columns`` (our name -> name in the header) of all files, with ``CORRUPT`` and ``FILE``.

    Names are compared without case and blanks around them; of equal names in a header the first counts. A file that lacks one of ``required`` (our
    names) is an error, another missing column is null. Further columns of a file are not read.
    """
    parts = []
    for header, files in files_by_header(spark, paths).items():
        at = {name: i for i, name in reversed(list(enumerate(header)))}
        found = {ours: at[theirs.strip().lower()] for ours, theirs in columns.items() if theirs.strip().lower() in at}
        missing = [c for c in required if c not in found]
        if missing:
            raise ValueError(f"{files[0]} has no column for {', '.join(missing)}")
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(header))] + [StructField(CORRUPT, StringType())])
        rows = (
            spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", multiline)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv([_path_of(spark, f) for f in files])
        )
        own = [(F.col(f"c{found[c]}") if c in found else F.lit(None).cast("string")).alias(c) for c in columns]
        # columns aren't pruned in the scan, as a record of the wrong length would pass as whole then. The text is tied to a value: Spark refuses a
        # scan of it alone, and the CSV source must not filter by it before it is set
        malformed = F.expr(f"if(length(c0) < 0, null, {CORRUPT})").alias(CORRUPT)
        parts.append(rows.select(*own, malformed, F.col("_metadata.file_path").alias(FILE)))
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in (*columns, CORRUPT, FILE)]))
    return reduce(DataFrame.unionByName, parts)


def _path_of(spark: SparkSession, uri: str) -> str:
    """A listed file as a path that isn't taken for a pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def malformed_counts(rows: DataFrame) -> DataFrame:
    """(file, n_rows, n_malformed) of what :func:`read_by_header` gave: one row a file that has rows."""
    return rows.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), F.count(CORRUPT).alias("n_malformed"))
