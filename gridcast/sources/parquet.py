"""Multi-file panel scan.

The folder holds one parquet dataset per file (``dataset_*.parquet``) with
different schemas; they are joined on the panel key, not unioned (J1).
The file list is a driver-side listing of names only (no data).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.timeutil import to_utc_time
from gridcast.roles import DEFAULT_ROLES, Roles


def _glob(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + pattern)
    fs = path.getFileSystem(conf)
    statuses = fs.globStatus(path) or []
    return sorted(str(s.getPath().toString()) for s in statuses)


def list_dataset_files(spark: SparkSession, folder: str, pattern: str = "dataset_*.parquet",
                       exclude: Iterable[str] = ("dataset_2",)) -> list[str]:
    """Sorted dataset paths; a file is skipped when its *name* contains any
    exclusion fragment (so ``dataset_2`` also drops ``dataset_20``)."""
    frags = list(exclude)
    out = []
    for p in _glob(spark, folder, pattern):
        name = p.rstrip("/").rsplit("/", 1)[-1]
        if any(f in name for f in frags):
            continue
        out.append(p)
    return out


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN is the reference's missing marker; here missing is NULL only."""
    names = list(cols) if cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not names:
        return df
    wanted = set(names)
    return df.select(*[
        F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in wanted else F.col(c)
        for c in df.columns])


def read_panel_files(spark: SparkSession, folder: str, roles: Roles = DEFAULT_ROLES,
                     pattern: str = "dataset_*.parquet",
                     exclude: Iterable[str] = ("dataset_2",)) -> DataFrame:
    """Scan every dataset file, normalise its time column to UTC and fold
    them with an inner join on ``(group, time)``."""
    from gridcast.operators.panel import panel_join

    frames = []
    for path in list_dataset_files(spark, folder, pattern, exclude):
        df = spark.read.parquet(path)
        frames.append(nan_to_null(to_utc_time(df, roles.time)))
    if not frames:
        return spark.createDataFrame([], T.StructType([]))
    return panel_join(frames, roles)
