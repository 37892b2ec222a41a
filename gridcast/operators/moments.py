"""Mergeable statistics of linear regressions.

A statistic of the rows ``z = (x1 .. xd, y)`` is their number, their mean and
the products of their deviations from it. Two statistics merge without
subtracting large sums, and they hold all that a least-squares or ridge fit
needs. So the fits of many keys, or of the expanding folds of one table, come
from one pass of partial statistics per chunk of rows, merged per key, and
the number of Spark jobs does not depend on the number of keys.

A statistic travels as the columns ``n long, mean array<double>, dev binary``
(``dev``: the matrix of products as doubles).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.session import materialize

COLUMNS = "n long, mean array<double>, dev binary"
MERGE = 8  # statistics that one task merges at a time
ROWS = 2048  # rows of a matrix at a time


@dataclass
class Moments:
    n: int
    mean: np.ndarray
    dev: np.ndarray

    @staticmethod
    def of(z: np.ndarray) -> Moments:
        mean = z.mean(axis=0) if len(z) else np.zeros(z.shape[1])
        c = z - mean
        return Moments(len(z), mean, c.T @ c)

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, gap = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.dev + other.dev + np.outer(gap, gap) * (self.n * other.n / n))

    def scaled(self, shift: np.ndarray, scale: np.ndarray) -> Moments:
        """The statistic of ``(z - shift) / scale``."""
        return Moments(self.n, (self.mean - shift) / scale, self.dev / np.outer(scale, scale))

    def ridge(self, penalty: float = 0.0) -> tuple[np.ndarray, float]:
        """Coefficients and intercept that minimise the mean squared error plus
        ``penalty`` times the squared coefficients; without a penalty, the shortest solution."""
        a, b = self.dev[:-1, :-1] / self.n, self.dev[:-1, -1] / self.n
        if penalty:
            coef = np.linalg.solve(a + penalty * np.eye(len(a)), b)
        else:
            size = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))  # rank is judged on equal scales
            coef = np.linalg.lstsq(a / np.outer(size, size), b / size, rcond=1e-12)[0] / size
        return coef, float(self.mean[-1] - self.mean[:-1] @ coef)

    def fit(self, weight_decay: float = 0.0) -> tuple[np.ndarray, float]:
        """:meth:`ridge` with the penalty of Spark's linear regression, which is
        relative to the spread of the target."""
        spread = np.sqrt(self.dev[-1, -1] / self.n)
        return self.ridge(weight_decay / spread) if spread > 0 else (np.zeros(len(self.mean) - 1), float(self.mean[-1]))


def total(parts: Iterable[Moments]) -> Moments | None:
    out = None
    for p in parts:
        out = p if out is None else out + p
    return out


def packed(rows: list[tuple[tuple, Moments]], keys: list[str]) -> pd.DataFrame:
    """A frame with the key columns and a statistic in each row."""
    out = pd.DataFrame([k for k, _ in rows], columns=keys)
    return out.assign(n=pd.Series([m.n for _, m in rows], dtype="int64"), mean=pd.Series([m.mean for _, m in rows], dtype="object"),
                      dev=pd.Series([m.dev.tobytes() for _, m in rows], dtype="object"))


def unpacked(rows: pd.DataFrame) -> Iterator[Moments]:
    for n, mean, dev in zip(rows["n"], rows["mean"], rows["dev"], strict=True):
        mean = np.asarray(mean, float)
        yield Moments(int(n), mean, np.frombuffer(dev, float).reshape(len(mean), len(mean)))


def merge_parts(parts: DataFrame, keys: list[str], part: str, most: int) -> DataFrame:
    """At most ``MERGE`` statistics per key, from up to ``most`` (numbered by ``part``):
    every round merges ``MERGE`` of them per task, so no task gets all of a large key."""
    schema = ", ".join(f"`{c}` {parts.schema[c].dataType.simpleString()}" for c in [*keys, part]) + ", " + COLUMNS

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_from", kind="stable")
        return packed([((*rows.iloc[0][keys], rows.iloc[0][part]), total(unpacked(rows)))], [*keys, part])

    while most > MERGE:
        parts = materialize(parts.withColumn("_from", F.col(part)).withColumn(part, F.floor(F.col(part) / MERGE).cast(
            parts.schema[part].dataType)).groupBy(*keys, part).applyInPandas(merge, schema))
        most = -(-most // MERGE)
    return parts


def row_moments(df: DataFrame, keys: list[str], features: list[str], target: str) -> DataFrame:
    """Statistics of the complete rows of ``df``, at most ``MERGE`` per key: one per key and
    task, merged; the rows are not shuffled. Keys must be few (folds, options)."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys) + ", " + COLUMNS
    names = [*features, target]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple, Moments] = {}
        for batch in batches:
            for key, rows in batch.groupby(keys, dropna=False):
                m = Moments.of(rows[names].to_numpy(float))
                seen[key] = seen[key] + m if key in seen else m
        if seen:
            yield packed(list(seen.items()), keys)

    cols = [F.col(c) for c in keys] + [F.col(c).cast("double").alias(c) for c in names]
    parts = materialize(df.select(*cols).dropna(subset=names).mapInPandas(run, schema)
                        .withColumn("part", F.spark_partition_id().cast("long")))
    return merge_parts(parts, keys, "part", (parts.agg(F.max("part")).first()[0] or 0) + 1)
