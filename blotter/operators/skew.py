"""Equi-joins whose left side has hot keys: a corner, a default value or (0, 0) that holds a good part of all rows.

The hot keys are found by Spark's frequent-items sketch over a hash of the key: an aggregate of bounded size that is combined on the
map side. Rows of a hot key are dealt to as many salts as its share asks for, and the right side's rows of that key (and of no other) are copied
once per salt. All other keys are joined as they are. The result is that of the plain join.

A salt is a hash of the row and of its input partition: it doesn't depend on the order of rows, so a task that runs again deals them alike, and equal rows
of different input partitions are spread too.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.joins import measured_bytes

#: A key is hot from this share of the rows on; a salt of it then gets at most about that share.
HOT_SHARE = 1 / 256
#: Keys that the sketch tracks. Its error is below 2 / TRACKED of the rows, far below HOT_SHARE.
TRACKED = 8192
HOWS = ("inner", "left", "left_semi", "left_anti")


def hot_keys(df: DataFrame, keys: Sequence[str | Column], share: float = HOT_SHARE, tracked: int = TRACKED) -> tuple[int, dict[int, int]]:
    """(number of rows, {hash of a hot key: its estimated rows}): every key with ``share`` of the rows or more, at most about 1 / share of them."""
    if not 0 < share <= 1 or tracked * share < 8:
        raise ValueError("share must be in (0, 1], and tracked at least 8 / share")
    h = F.xxhash64(*keys).alias("h")
    most = min(tracked, math.ceil(2 / share))
    row = df.select(h).agg(F.expr(f"approx_top_k(h, {most}, {1 << math.ceil(math.log2(tracked))})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    n = row["n"]
    # estimates are never below the true count by more than the sketch's error
    least = share * n - 2 * n / tracked
    return n, {x["item"]: x["count"] for x in row["top"] or [] if x["count"] >= max(least, 2)}


def _salts(hashed: Column, salts: dict[int, int]) -> Column:
    """How many salts the key of a hash has."""
    if not salts:
        return F.lit(1)
    pairs = [F.lit(x) for item in sorted(salts.items()) for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), hashed), F.lit(1))


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "inner", *, share: float = HOT_SHARE, tracked: int = TRACKED,
              broadcast_bytes: int = 0) -> DataFrame:
    """``left`` joined to ``right`` by pairs of column names, with hot keys of the left side spread over several tasks.

    ``how``: inner, left, left_semi or left_anti, for which a left row meets the right rows of its key in one place. Null keys match nothing; rows with a null
    key are spread like those of a hot key. A right side of at most ``broadcast_bytes`` (measured) is broadcast, and then nothing is salted. The columns
    are those of the plain join: all of ``left``, then all of ``right`` (left only for semi and anti).
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}, not {how!r}")
    lk, rk = [left[a] for a, _ in on], [right[b] for _, b in on]
    if broadcast_bytes and measured_bytes(right) <= broadcast_bytes:
        same = lk[0] == rk[0]
        for a, b in zip(lk[1:], rk[1:]):
            same = same & (a == b)
        return left.join(F.broadcast(right), same, how)
    # keys of both sides as one type, so that equal keys have equal hashes
    kinds = [_common(left, a, right, b) for a, b in on]
    lkeys, rkeys = [F.col(f"`{a}`").cast(t) for (a, _), t in zip(on, kinds)], [F.col(f"`{b}`").cast(t) for (_, b), t in zip(on, kinds)]
    n, hot = hot_keys(left, [_plain(k, t) for k, t in zip(lkeys, kinds)], share, tracked)
    salts = {h: max(2, math.ceil(c / (share * n))) for h, c in hot.items()}
    lh, rh = F.xxhash64(*[_plain(k, t) for k, t in zip(lkeys, kinds)]), F.xxhash64(*[_plain(k, t) for k, t in zip(rkeys, kinds)])
    row_hash = F.xxhash64(*(F.to_json(F.struct(F.col(f"`{c}`"))) if _nested(left, c) else F.col(f"`{c}`") for c in left.columns), F.spark_partition_id())
    lrow, rrow = F.struct(*(F.col(f"`{c}`") for c in left.columns)), F.struct(*(F.col(f"`{c}`") for c in right.columns))
    l2 = left.select(lrow.alias("l"), *(k.alias(f"lk{i}") for i, k in enumerate(lkeys)), F.pmod(row_hash, _salts(lh, salts)).alias("lsalt"))
    r2 = right.select(rrow.alias("r"), *(k.alias(f"rk{i}") for i, k in enumerate(rkeys)), F.explode(F.sequence(F.lit(0).cast("long"), _salts(rh, salts).cast("long") - 1)).alias("rsalt"))
    same = F.col("lsalt") == F.col("rsalt")
    for i in range(len(on)):
        same = same & (F.col(f"lk{i}") == F.col(f"rk{i}"))
    out = l2.join(r2, same, how)
    own = [F.col("l")[c].alias(c) for c in left.columns]
    return out.select(*own) if how in ("left_semi", "left_anti") else out.select(*own, *(F.col("r")[c].alias(c) for c in right.columns))


def _nested(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("map", "variant")


def _plain(key: Column, kind: str) -> Column:
    """-0.0 and 0.0 are equal keys, so they must hash alike."""
    return F.when(key == 0, F.lit(0).cast(kind)).otherwise(key) if kind in ("double", "float") else key


def _common(left: DataFrame, a: str, right: DataFrame, b: str) -> str:
    """The type in which Spark compares the two columns."""
    x, y = left.schema[a].dataType, right.schema[b].dataType
    if x == y:
        return x.simpleString()
    both = left.select(F.col(f"`{a}`").alias("k")).limit(0).union(right.select(F.col(f"`{b}`").alias("k")).limit(0))
    return both.schema["k"].dataType.simpleString()
