"""CSV results (S5): one folder per group and one combined file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BY_GROUP, COMBINED = "by_group", "combined"


def write_csv(rows: DataFrame, base: str, group: str) -> None:
    """Result rows (a few per group) under ``base``: a folder per value of ``group`` and one file of all."""
    rows.write.mode("overwrite").option("header", True).partitionBy(group).csv(f"{base}/{BY_GROUP}")
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{base}/{COMBINED}")


def read_csv(spark: SparkSession, base: str, schema: StructType, group: str) -> DataFrame:
    """Both copies with their ``kind``; the group of the first comes from the folder names."""
    names = [f.name for f in schema.fields]
    inner = StructType([f for f in schema.fields if f.name != group] + [schema[group]])
    parts = [spark.read.option("header", True).schema(s).csv(f"{base}/{k}").select(F.lit(k).alias("kind"), *names)
             for k, s in ((BY_GROUP, inner), (COMBINED, schema))]
    return reduce(DataFrame.unionByName, parts)
