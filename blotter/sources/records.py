"""CSV records with quoted line breaks, from text files that stay splittable.

``multiLine`` reads a file in one task. Here lines are read split by split, and what a split can't know, whether it begins inside a quoted value, is found by a
prefix scan: a first pass gives for each split the state at its end for both states at its start (a function on two states, one row a split);
running compositions per file give the state at each split's start. A second pass cuts each split's lines into records. Only the pieces of records that
cross a border are put together by a shuffle: at most two pieces a split.

A quoted value begins with a quote at the start of a field and ends at the next quote that no backslash escapes; what follows up to the delimiter is plain
text, and so are quotes elsewhere. That is how Spark's CSV reader reads with its default options. A value that is never closed lasts until its file ends, and
is then one record.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.operators.joins import DEFAULT_BROADCAST_BYTES, measured_bytes
from blotter.session import shared_dir

# Serialised by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: From inside a quoted value: up to the quote that closes it, if the line has it.
_CLOSE = re.compile(r'(?:[^"\\]|\\.|\\$)*+("?)', re.S)
#: From the start of a field that isn't quoted, up to the delimiter.
_PLAIN = re.compile(r"[^,]*")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted value is open at the end of a line, for a line that begins inside one or at the start of a record."""
    at = 0
    while True:
        if inside:
            m = _CLOSE.match(line, at)
            if not m[1]:
                return True
            at = m.end()
        m = _PLAIN.match(line, at)
        if m.end() >= len(line):
            return False
        at = m.end() + 1  # after the delimiter
        inside = line.startswith('"', at)
        at += inside


def _line_end(line: str, inside: bool) -> bool:
    # a record's first field may be quoted too: read it as if a delimiter stood before it
    return ends_inside(line, True) if inside else ends_inside("," + line, False)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str], list[bool], pa.RecordBatch]]:
    """Runs of lines of one split, with whether each line has a quote."""
    for b in batches:
        files, starts = b.column(0).dictionary_encode(), b.column(1).to_pylist()
        names, codes = files.dictionary.to_pylist(), files.indices.to_pylist()
        lines, quoted = b.column(2).to_pylist(), pc.match_substring(b.column(2), '"').to_pylist()
        i = 0
        while i < len(lines):
            j = i
            while j < len(lines) and codes[j] == codes[i] and starts[j] == starts[i]:
                j += 1
            yield (names[codes[i]], starts[i]), lines[i:j], quoted[i:j], b.slice(i, 1)
            i = j


def _split_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, from_outside, from_inside) of each split of a task."""
    states: dict[tuple[str, int], list[bool]] = {}
    for key, lines, quoted, _ in _splits(batches):
        state = states.setdefault(key, [False, True])
        for line, q in zip(lines, quoted):
            if q:
                state[:] = [_line_end(line, s) for s in state]
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in states], pa.string()), pa.array([k[1] for k in states], pa.int64()),
                                      pa.array([s[0] for s in states.values()], pa.bool_()), pa.array([s[1] for s in states.values()], pa.bool_())],
                                     names=["file", "start", "from_outside", "from_inside"])


_PIECE = "file string, start long, place int, value string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, and pieces of records at a split's borders: place 0 closes what came before, 1 is the middle of it, 2 opens one, null is whole."""
    key, inside, open_lines, head = None, False, [], False

    def batch(rows) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["file", "start", "place", "value"])

    def rest():
        return [(*key, 1 if head else 2, "\n".join(open_lines))] if open_lines else []

    for of, lines, quoted, first in _splits(batches):
        rows = []
        if of != key:
            rows += rest()
            key, open_lines = of, []
            inside = head = first.column(3)[0].as_py()
        for line, q in zip(lines, quoted):
            if q:
                inside = _line_end(line, inside)
            open_lines.append(line)
            if not inside:
                rows.append((*key, 0 if head else None, "\n".join(open_lines)))
                open_lines, head = [], False
        if rows:
            yield batch(rows)
    if rest():
        yield batch(rest())


def read_quoted_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    r"""(value): the records of CSV files as text, header lines too; a quoted value may hold line breaks (``\r\n``
    reads as ``\n``). Empty lines are dropped.

    Only the few border pieces and one row a split are shuffled. The splits of both passes are the same as long as the files and the session's split
    size are.
    """
    shared_dir(spark)
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    ends = lines.mapInArrow(_split_states, "file string, start long, from_outside boolean, from_inside boolean")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.col("from_outside") == F.col("from_inside")  # such a split ends alike whatever it begins with
    turns = F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)
    states = ends.withColumn("turns", F.sum(turns).over(upto)).select(
        "file", "start", F.last(F.when(fixed, F.struct(F.col("from_outside").alias("end"), "turns")), True).over(before).alias("last"),
        F.lag("turns", 1, 0).over(Window.partitionBy("file").orderBy("start")).alias("turned"))
    turned = (F.col("turned") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    states = states.select("file", "start", (F.coalesce("last.end", F.lit(False)) != turned).alias("inside")).checkpoint(eager=True)
    begun = states.where("inside")  # most splits begin outside, and need no row here
    crossing = bool(begun.limit(1).collect())
    if not crossing:
        pieces = lines.withColumn("inside", F.lit(False))
    elif measured_bytes(begun) <= DEFAULT_BROADCAST_BYTES:  # lines stay where they are
        pieces = lines.join(F.broadcast(begun), ["file", "start"], "left")
    else:
        pieces = lines.withColumn("pos", F.monotonically_increasing_id()).join(begun.hint("merge"), ["file", "start"], "left").sortWithinPartitions("file", "start", "pos")
    pieces = pieces.select("file", "start", "value", F.coalesce("inside", F.lit(False)).alias("inside")).mapInArrow(_cut, _PIECE)
    whole = pieces.where("place is null").select("value")
    if crossing:
        at = Window.partitionBy("file").orderBy("start", F.col("place"))
        parts = pieces.where("place is not null").withColumn("record", F.sum(F.when(F.col("place") == 2, 1).otherwise(0)).over(at))
        joined = parts.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "place", "value"))).alias("p"))
        whole = whole.unionByName(joined.select(F.array_join(F.col("p.value"), "\n").alias("value")))
    else:  # a value that the file's last split leaves open has no row in begun
        whole = pieces.select("value")
    return whole.select(F.regexp_replace("value", r"\r(?=\n|$)", "").alias("value")).where("value <> ''")
