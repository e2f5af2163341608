"""DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import shared_dir

#: Rows of one or two longs that may be broadcast; 500,000 of them are 16 MB at most.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of a few longs that are worth a stored file of their own.
FILE_ROWS = 50_000


def kept(df: DataFrame, most: int | None = None, file_rows: int = FILE_ROWS) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read from there: it survives lost executors.

    Sessions with ``spark.cleaner.referenceTracking.cleanCheckpoints`` delete the files when the frame goes. Every partition is a
    file, an empty one too, and without Hadoop's native library a local file system starts a chmod for each. ``most`` is the
    number of rows that ``df`` has at most, where that is known: these go to one file for ``file_rows`` of them, not to more.
    """
    shared_dir(df.sparkSession)
    return (df if most is None else df.coalesce(max(1, -(-most // file_rows)))).checkpoint()


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, jobs send Arrow batches of at most ``rows`` rows to Python; for steps with long rows that are stored at once.

    A session's own lower limit stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) < rows:  # 0 is no limit
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under its own names: other columns can't clash with anything."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def fresh(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that none of ``taken`` equals, in any case of letters."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` whose id isn't in ``ids`` (a stored frame with one column, id); rows without an id stay."""
    key = fresh("dropped", docs.columns)
    gone = ids.select(F.col("id").alias(key))
    gone = F.broadcast(gone) if ids.count() <= limit else gone
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col(key), "left_anti")


def rows_with(df: DataFrame, ids: DataFrame, key: str = "id", limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``df`` whose key is in ``ids`` (a stored frame of distinct keys).

    A small list (counted, at most ``limit`` rows) is broadcast, so ``df`` isn't shuffled; a longer one is joined by a
    shuffle. The rows are the same.
    """
    return df.join(F.broadcast(ids) if ids.count() <= limit else ids.hint("merge"), key, "left_semi")


#: Bits of an id filter: 1 MB, whatever the number of ids.
FILTER_BITS = 1 << 23


def id_filter(ids: DataFrame, key: str = "id") -> np.ndarray:
    """A bitmap of fixed size that has the bit of every id in ``ids``; made by an aggregate of at most 2**17 rows.

    An id whose bit is off is surely not among them. The more ids, the more others pass too: the filter then saves less, and a
    join behind it gives the same rows.
    """
    at = F.pmod(F.col(key).bitwiseXOR(F.shiftright(key, 23)), F.lit(FILTER_BITS))
    words = ids.select(at.alias("at")).select(F.shiftright("at", 6).alias("w"), F.expr("shiftleft(1L, cast(at & 63L as int))").alias("m")).groupBy("w").agg(F.bit_or("m").alias("m"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.collect():
        out[r["w"]] = r["m"]
    return out


def may_hold(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each id whether its bit is on."""
    at = (ids ^ (ids >> 23)) % FILTER_BITS
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int | None = None) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` reaches, itself included.

    Alternates large-star and small-star steps; all state stays in distributed tables, one stored per round. Rounds
    grow with the logarithm of the longest chain. The minima are stored before they are joined, so Spark can split the edges of
    a node that a large part of all nodes touches. What a round stores is at most a few times its edges, whose number is known;
    ``most``: that of ``edges`` at most, if the caller knows it.
    """
    e = kept(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), most)
    before = (e.count(), None)
    while True:
        n = before[0]
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), 2 * n)
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node's own minimum stays linked to it
        large = kept(large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct(), 3 * n)
        low = kept(large.groupBy("u").agg(F.min("v").alias("m")), 3 * n)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        e = kept(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), 6 * n)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
