"""Role views over the benchmark's Parquet tables.

The benchmark tables carry no incidents, coordinates, ZIP codes or incomes,
so each role is derived from them with integer arithmetic (identical in
Spark and in the SQL oracle):

incidents   orders (one incident per order): id = o_orderkey,
            occurred_on = o_orderdate, reported_on = occurred_on + (id % 3) days,
            weapon_code = o_orderpriority with '4-NOT SPECIFIED' as null
            (firearm = code starting with '1'), victim_code = o_orderstatus
            (null when id % 11 = 0), a point in the Los Angeles box from the
            id, and Null Island (0, 0) when id % 97 = 0.
            With customer: area = c_nationkey zero-padded to 2 characters.
stations    nation: site_id = n_nationkey, prec = unpadded key, division =
            n_name, (y, x) from the key.
outlets     customer: outlet_id = c_custkey, (y, x) from the key.
geocode     distinct incident points -> ZIP of one of 25 zones ('900NN'),
            with ZIP+4 spellings and null ZIPs mixed in.
income      supplier: ZIP of its nation, '$12,345'-style income (empty for
            some rows, several rows per ZIP).
events      events: HHMM of ts (null when event_id % 101 = 0),
            premise = event_type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat_index(key: Column) -> Column:
    return (key * 7919) % 6400


def _lon_index(key: Column) -> Column:
    return (key * 104729) % 5200


def point_lat(key: Column) -> Column:
    return F.when(key % 97 == 0, F.lit(0.0)).otherwise(F.lit(33.70) + _lat_index(key) / 10000)


def point_lon(key: Column) -> Column:
    return F.when(key % 97 == 0, F.lit(0.0)).otherwise(F.lit(-118.67) + _lon_index(key) / 10000)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    occurred = F.col("o_orderdate").cast("date")
    return o.select(
        k.alias("incident_id"),
        occurred.alias("occurred_on"),
        F.date_add(occurred, (k % 3).cast("int")).alias("reported_on"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("weapon_code"),
        F.when(k % 11 != 0, F.col("o_orderstatus")).alias("victim_code"),
        point_lat(k).alias("lat"),
        point_lon(k).alias("lon"),
        "o_custkey",
    )


def incidents_with_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("area"),
        F.col("c_mktsegment").alias("premise"),
    )
    return incidents(spark, sf_dir).join(c, F.col("o_custkey") == F.col("c_custkey"), "inner").drop("c_custkey")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        n.alias("site_id"),
        n.cast("string").alias("prec"),
        F.col("n_name").alias("division"),
        (F.lit(33.70) + ((n * 2551 + 1217) % 6400) / 10000).alias("y"),
        (F.lit(-118.67) + ((n * 3571 + 911) % 5200) / 10000).alias("x"),
    )


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many sites in the same box: one per customer, some in the same place."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("outlet_id"),
        (F.lit(33.70) + ((k * 3253) % 6389) / 10000).alias("y"),
        (F.lit(-118.67) + ((k * 4099) % 5197) / 10000).alias("x"),
    )


def geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    li, lo = _lat_index(k), _lon_index(k)
    pts = table(spark, sf_dir, "orders").filter(k % 97 != 0).select(
        point_lat(k).alias("lat"), point_lon(k).alias("lon"), li.alias("li"), lo.alias("lo")
    )
    zone = (F.floor(F.col("li") / 1280) * 5 + F.floor(F.col("lo") / 1040)).cast("int")
    base = F.concat(F.lit("9"), F.lpad(zone.cast("string"), 4, "0"))
    s = F.col("li") + F.col("lo")
    zip_code = (
        F.when(s % 23 == 0, F.lit(None).cast("string"))
        .when(s % 19 == 0, F.concat(base, F.lit("-"), F.lpad((F.col("li") % 10000).cast("string"), 4, "0")))
        .otherwise(base)
    )
    return pts.select("lat", "lon", zip_code.alias("zip")).distinct()


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(zip, income_raw): '$12,345'-style strings, '' for some rows."""
    amount = F.floor(F.abs(F.col("s_acctbal")) * 7).cast("long")
    text = (
        F.when(F.col("s_suppkey") % 17 == 0, F.lit(""))
        .when(amount >= 1000, F.concat(F.lit("$"), (amount / 1000).cast("long").cast("string"), F.lit(","),
                                       F.lpad((amount % 1000).cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("$"), amount.cast("string")))
    )
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("9"), F.lpad(F.col("s_nationkey").cast("string"), 4, "0")).alias("zip"),
        text.alias("income_raw"),
    )


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("incident_id"),
        F.when(F.col("event_id") % 101 != 0, F.date_format("ts", "HHmm")).alias("hhmm"),
        F.col("event_type").alias("premise"),
        "value",
    )
