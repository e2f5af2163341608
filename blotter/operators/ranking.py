"""Places within groups: the first rows of each group by a named SQL window, and exact numbering of groups of any size.

``top_rows``     states ``rank()`` and ``row_number()`` over named windows in Spark SQL (a ``WINDOW`` clause). A bound on a place is planned
                 as a window group limit: each task keeps the first rows of its groups before anything is shuffled.

``number_rows``  numbers *all* rows of each group. A window over a group sorts it in one task; here the rows are sorted across all
                 tasks by range, so a group that holds a third of all rows lies in many partitions. Each partition numbers its own
                 part, and only the groups (and runs of equal rows) that continue from one partition to the next get an offset: at
                 most one of them per partition, so those tables are broadcast with a proven bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.session import shared_dir


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _pairs(order: Sequence[str | tuple[str, str]]) -> list[tuple[str, str]]:
    """(name, 'asc' or 'desc') of each item."""
    pairs = [(item, "asc") if isinstance(item, str) else tuple(item) for item in order]
    for _, way in pairs:
        if way not in ("asc", "desc"):
            raise ValueError(f"order must be 'asc' or 'desc', not {way!r}")
    return pairs


def _sql_order(order: Sequence[str | tuple[str, str]]) -> str:
    """``["a", ("b", "desc")]`` as an ORDER BY list; nulls come last either way."""
    return ", ".join(f"{_quoted(name)} {way.upper()} NULLS LAST" for name, way in _pairs(order))


def top_rows(df: DataFrame, by: Sequence[str], order: Sequence[str | tuple[str, str]], k: int, *, tie_break: Sequence[str | tuple[str, str]] = (),
             ties: bool = False, rank_col: str = "rank", number_col: str = "place") -> DataFrame:
    """The first ``k`` rows of each group with their rank (equal rows share one) and their place (``tie_break`` decides).

    ``ties`` keeps all rows of rank ``k`` or less, so a group can give more than ``k``. A null group is a group. Columns of ``df`` that
    have the names of the two new ones are replaced.
    """
    if not by or not order:
        raise ValueError("by and order name at least one column each")
    group = ", ".join(_quoted(c) for c in by)
    placed = _sql_order([*order, *tie_break])
    own = ", ".join(_quoted(c) for c in df.columns if c.lower() not in (rank_col.lower(), number_col.lower()))
    ranked = f"SELECT {own}, rank() OVER alike AS {_quoted(rank_col)}, row_number() OVER placed AS {_quoted(number_col)} FROM {{df}}"
    limit = _quoted(rank_col if ties else number_col)
    return df.sparkSession.sql(
        f"""
        SELECT * FROM (
          {ranked}
          WINDOW alike AS (PARTITION BY {group} ORDER BY {_sql_order(order)}), placed AS (PARTITION BY {group} ORDER BY {placed})
        ) WHERE {limit} <= {int(k)}
        """,
        df=df,
    )


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[str | tuple[str, str]], *, tie_break: Sequence[str | tuple[str, str]] = (),
                number_col: str = "place", rank_col: str | None = "rank") -> DataFrame:
    """``df`` with each row's place in its group, 1 and up, and its rank by ``order`` alone (rows equal there share it).

    Rows that ``tie_break`` leaves equal too get different places in no particular order. Null groups and null values count as equal, nulls
    come last. The sorted rows are checkpointed once, since later steps rely on where each row lies.
    """
    shared_dir(df.sparkSession)
    names, sort = df.columns, _pairs([*order, *tie_break])
    # the caller's columns travel in one struct, and the keys under names of their own
    keys = {f"b{i}": F.col(_quoted(c)) for i, c in enumerate(by)} | {f"k{i}": F.col(_quoted(c)) for i, (c, _) in enumerate(sort)}
    rows = df.select(F.struct(*(F.col(_quoted(c)) for c in names)).alias("row"), *(v.alias(k) for k, v in keys.items()), F.monotonically_increasing_id().alias("seq"))
    ways = [F.col(f"b{i}").asc_nulls_first() for i in range(len(by))]
    ways += [F.col(f"k{i}").asc_nulls_last() if way == "asc" else F.col(f"k{i}").desc_nulls_last() for i, (_, way) in enumerate(sort)]
    ways.append(F.col("seq").asc())  # every row is a key of its own, so no value is too frequent for one range
    group, equal = [f"b{i}" for i in range(len(by))], [f"k{i}" for i in range(len(order))]
    stored = rows.repartitionByRange(*ways).sortWithinPartitions(*ways).select("row", *group, *equal, F.monotonically_increasing_id().alias("pos"))
    stored = stored.withColumn("part", F.shiftright("pos", 33)).checkpoint(eager=True)

    local = Window.partitionBy("part", *group).orderBy("pos")
    alike = Window.partitionBy("part", *group, *equal)
    out = stored.withColumn("n", F.row_number().over(local)).withColumn("r", F.min("n").over(alike))
    before = _carried(stored.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("c")), group, F.sum("c"), "before")
    out = _with_carried(out, before, group, "before").withColumn("n", F.col("n") + F.coalesce("before", F.lit(0))).withColumn("r", F.col("r") + F.coalesce("before", F.lit(0)))
    values = {number_col: F.col("n").cast("long")}
    if rank_col:
        first = out.groupBy(*group, *equal, "part").agg(F.min("n").alias("c"))
        out = _with_carried(out, _carried(first, [*group, *equal], F.min("c"), "run"), [*group, *equal], "run")
        values[rank_col] = F.coalesce("run", "r").cast("long")
    return out.select(*(F.col("row")[c].alias(c) for c in names if c not in values), *(v.alias(k) for k, v in values.items()))


def _carried(per_part: DataFrame, keys: list[str], gathered: Column, name: str) -> DataFrame:
    """For the key that a partition continues from earlier ones (it can be one only): what the earlier parts gave."""
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.withColumn(name, gathered.over(earlier)).where(F.col(name).isNotNull()).select(*keys, "part", name)


def _with_carried(df: DataFrame, carried: DataFrame, keys: list[str], name: str) -> DataFrame:
    other = carried.select(*(F.col(c).alias(f"_{c}") for c in [*keys, "part"]), name)
    same = F.lit(True)
    for c in [*keys, "part"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(F.broadcast(other), same, "left").drop(*(f"_{c}" for c in [*keys, "part"]))
