"""Join helpers: size-checked broadcast, strategy hints, disjunctive key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# Default bound for broadcasting a dimension, in bytes of its rows.
DEFAULT_BROADCAST_BYTES = 64 << 20

JOIN_HINTS = ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row of ``df``: 8 for each field, and the length of what varies."""
    total = F.lit(8 * len(df.columns) + 8)
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    return total.cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``, measured by one distributed aggregate."""
    return int(df.agg(F.sum(row_bytes(df)).alias("n")).first()["n"] or 0)


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its measured size is small.

    Beyond the bound ``df`` is returned unchanged: the join then shuffles on
    its keys (AQE can still switch to a broadcast from runtime sizes and
    split skewed partitions).
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def with_join_hint(left: DataFrame, right: DataFrame, on, how: str = "inner", hint: str | None = None,
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join with a strategy hint on the right side.

    ``broadcast`` is applied only when the right side is proven small (else
    the join is left to the planner). ``shuffle_replicate_nl`` is refused:
    it evaluates every pair of rows (a Cartesian product), which does not
    scale with the inputs.
    """
    if hint is None:
        return left.join(right, on, how)
    hint = hint.lower()
    if hint not in JOIN_HINTS:
        raise ValueError(f"unknown join hint {hint!r}; expected one of {JOIN_HINTS}")
    if hint == "shuffle_replicate_nl":
        raise ValueError("shuffle_replicate_nl plans a Cartesian product over all row pairs; use an equi-join hint")
    if hint == "broadcast":
        return left.join(bounded_broadcast(right, max_broadcast_bytes), on, how)
    return left.join(right.hint(hint), on, how)


def key_spellings_join(left: DataFrame, right: DataFrame, left_key, right_spellings: Sequence[Column],
                       how: str = "inner", broadcast_right: bool = False,
                       spelling_col: str = "__join_key") -> DataFrame:
    """Join ``left_key = s1 OR left_key = s2 OR ...`` as one equi-join.

    Each right row is expanded into its distinct key spellings (e.g. ``PREC``
    and ``'0' || PREC``); a left row then matches a right row at most once,
    exactly like the disjunctive condition, but the planner can use a hash or
    sort-merge join instead of a nested loop over all pairs. Pass
    ``broadcast_right`` only for a right side of proven size.
    """
    lk = left_key if isinstance(left_key, Column) else left[left_key]
    expanded = right.withColumn(spelling_col, F.explode(F.array_distinct(F.array(*right_spellings))))
    if broadcast_right:
        expanded = F.broadcast(expanded)
    return left.join(expanded, lk == expanded[spelling_col], how).drop(spelling_col)


def union_of_equi_joins(left: DataFrame, right: DataFrame, left_key, right_spellings: Sequence[Column]) -> DataFrame:
    """The same disjunctive join as a UNION ALL of one equi-join per spelling.

    Exact when the spellings of one right row always differ (then no pair is
    produced twice).
    """
    lk = left_key if isinstance(left_key, Column) else left[left_key]
    parts = [left.join(right, lk == s, "inner") for s in right_spellings]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def disjunctive_join(left: DataFrame, right: DataFrame, branches: Sequence[Sequence[tuple[str | Column, str | Column]]], how: str = "inner") -> DataFrame:
    """``left JOIN right ON branch1 OR branch2 OR ...``, each branch a conjunction of equalities (left expression, right expression).

    Every branch is an equi-join of its own, kept to the pairs for which no earlier branch holds, so a pair that fulfils several
    comes once, as with the disjunction. Null keys match nothing. For ``left``, ``right`` and ``full`` the rows without any match are found by
    anti-joins, one a branch. All columns of ``left`` and then of ``right`` come out, under their names.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"how must be inner, left, right or full, not {how!r}")
    if not branches or not all(branches):
        raise ValueError("each branch needs an equality")

    def keyed(df: DataFrame, side: int, row: str) -> DataFrame:
        keys = [(f"{row}{i}_{j}", pair[side]) for i, branch in enumerate(branches) for j, pair in enumerate(branch)]
        own = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(row)
        return df.select(own, *((k if isinstance(k, Column) else F.col(f"`{k}`")).alias(name) for name, k in keys))

    def holds(i: int) -> Column:
        same = F.col(f"l{i}_0") == F.col(f"r{i}_0")
        for j in range(1, len(branches[i])):
            same = same & (F.col(f"l{i}_{j}") == F.col(f"r{i}_{j}"))
        return same

    def rows(df: DataFrame) -> DataFrame:
        nulls = {"l": left.schema, "r": right.schema}
        cols = []
        for row, schema in nulls.items():
            cols += [(F.col(row)[f.name] if row in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
        return df.select(*cols)

    a, b = keyed(left, 0, "l"), keyed(right, 1, "r")
    parts = []
    for i in range(len(branches)):
        pairs = a.join(b, holds(i), "inner")
        for earlier in range(i):
            pairs = pairs.where(~F.coalesce(holds(earlier), F.lit(False)))
        parts.append(rows(pairs))
    for of, alone, other in (("left", a, b), ("right", b, a)):
        if how in (of, "full"):
            for i in range(len(branches)):
                alone = alone.join(other, holds(i), "left_anti")
            parts.append(rows(alone))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)  # by position: both sides may use a name
    return out
