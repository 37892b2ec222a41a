"""Panel fixtures derived from the driver's test tables.

Each fixture is a Spark DataFrame built with the DataFrame API from the
given tables, so its size grows with them; the same definition is written
in SQL in :mod:`gridcast.plans.oracle` for the DuckDB check. Sums use
integer cents so both engines agree exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def power_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly production panel: site = event type; the ``error`` site has
    zero capacity (exercises the capacity filter)."""
    use_utc(spark)
    ev = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return (ev.groupBy(F.col("event_type").alias("site_name"), hour.alias("delivery_time"))
            .agg((F.sum(F.round(F.col("value") * 100).cast("bigint")) / F.lit(100.0)).alias("production"))
            .withColumn("installed_capacity",
                        F.when(F.col("site_name") == "error", F.lit(0.0)).otherwise(F.lit(500.0))))


def weather_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather panel on the same key."""
    use_utc(spark)
    ev = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    uid, eid = F.col("user_id"), F.col("event_id")
    return (ev.groupBy(F.col("event_type").alias("site_name"), hour.alias("delivery_time"))
            .agg((F.sum(uid % 25) * 1.0 / F.count(F.lit(1))).alias("wind_speed_10m"),
                 (F.max(uid % 40) * 1.0).cast("double").alias("wind_speed_100m"),
                 (F.max(eid % 50) * 1.0).cast("double").alias("wind_gusts_10m"),
                 (F.max(eid * 53 % 360) * 1.0).cast("double").alias("wind_direction_10m"),
                 (F.min(eid * 37 % 360) * 1.0).cast("double").alias("wind_direction_100m"),
                 (F.min(eid % 35) - F.lit(5.0)).alias("temperature_2m"),
                 (F.lit(980.0) + F.max(eid % 60)).alias("pressure_msl"),
                 (F.min(eid % 7) - F.lit(1.0)).alias("precipitation"),
                 (F.count(F.lit(1)) * F.lit(1.0)).alias("cloud_cover_low"))
            .withColumn("wind_speed_10m", F.col("wind_speed_10m").cast("double")))


def ship_day(spark: SparkSession, sf_dir: str, site_col: str = "l_returnflag") -> DataFrame:
    """Long daily panel from lineitem (default step counts fit in it)."""
    use_utc(spark)
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col(site_col).cast("string").alias("site_name"),
                     F.col("l_shipdate").cast("timestamp").alias("delivery_time"))
            .agg(F.sum("l_quantity").alias("production"),
                 (F.lit(50.0) * F.count(F.lit(1))).alias("installed_capacity")))
