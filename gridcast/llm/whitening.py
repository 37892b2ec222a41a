"""Embedding whitening through the exact characteristic polynomial.

Entries become integers x = floor(scale * c) + offset. The steps:

1. Exact moments: every partition sums the products of its rows' entries in integers,
   Spark adds the partial sums as decimals; n * (sum of products) - (products of sums) is n^2 times
   the covariance, an integer matrix with as many rows as dimensions.
2. Its characteristic polynomial modulo enough primes below 2^31, one task row per prime, by
   modular reduction to Hessenberg form; the integer coefficients by Chinese remaindering. The
   number of primes follows from a proven bound of the coefficients.
3. The largest roots to ``ROOT_BITS`` bits by bisection with exact root counts.
4. Unit eigenvectors of each root by elimination of the null space and inverse iteration in
   fixed-point integers of ``FIXED`` bits, rounded to doubles once.
5. Rows are centred exactly (n * x - sum, integers), projected, and divided by the root
   of the eigenvalue; the covariance of the result is measured against the identity.

Only tables whose size is set by the dimension (moments, polynomials, components) reach the driver.

Defined cases: rows with a null vector, or null or non-finite entries, are dropped; shorter vectors are padded with
the entry 0 up to the longest; entries whose scaled size exceeds 2^40 count as 2^40; repeated rows and null ids count as
rows of their own. Components with eigenvalue 0 have no whitened value and are left out, so an empty
table, a single row or rows that are all equal give no rows. Of equal eigenvalues (to 128 bits)
any orthonormal basis of their space is returned, the same for all rows. ``deviation`` is null where
it exceeds a long; ``deviation_exact`` (decimal) never is. Further input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import finite_vector, table, written, written_with
from gridcast.llm.exact_algebra import charpoly_mod, chinese_remainder, coefficient_bound, eigenvectors, largest_roots, primes_for

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
LARGEST = 1 << 40
OUTPUT = ("component int, n long, deviation long, whitened double, explained double, identity_error double, "
          "deviation_exact decimal(38,0)")


def _entries(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    """floor(scale * c) of every entry, without the offset (no covariance depends on it)."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return np.clip(np.floor(out * scale), -LARGEST, LARGEST).astype(np.int64)


def _products(y: np.ndarray) -> np.ndarray:
    """y'y, exact."""
    if int(np.abs(y).max(initial=0)) ** 2 * len(y) < 2 ** 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def moments(vectors: DataFrame, width: int, scale: int) -> tuple[list[int], np.ndarray]:
    """Sums and sums of products over all rows of ``v``, without the offset."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, squares = np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            y = _entries(batch["v"], width, scale)
            total, squares = total + y.sum(axis=0).astype(object), squares + _products(y)
        i, j = np.triu_indices(width)
        yield pd.DataFrame({"i": np.concatenate((i, np.arange(width))), "j": np.concatenate((j, np.full(width, -1))),
                            "s": [str(x) for x in (*squares[i, j], *total)]})

    parts = vectors.select("v").mapInPandas(run, "i int, j int, s string")
    sums, products = [0] * width, np.zeros((width, width), object)
    for r in parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # about width^2 / 2 rows
        if r["j"] < 0:
            sums[r["i"]] = int(r["s"])
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = int(r["s"])
    return sums, products


def characteristic_polynomial(spark, matrix: np.ndarray) -> list[int]:
    """Integer coefficients, constant term first, of a positive semi-definite
    integer matrix; one row per prime, spread over the cluster."""
    primes = primes_for(coefficient_bound(matrix))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"p": batch["p"], "c": [charpoly_mod(matrix, int(p)) for p in batch["p"]]})

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInPandas(run, "p long, c array<long>")
    return chinese_remainder({r["p"]: r["c"] for r in rows.collect()})


def principal_components(spark, scatter: np.ndarray, k: int) -> tuple[list[Fraction], np.ndarray]:
    """The up to ``k`` largest positive eigenvalues of a positive semi-definite integer matrix and their
    unit eigenvectors (rows)."""
    values, vectors = [], []
    for m, t, multiplicity in largest_roots(characteristic_polynomial(spark, scatter), k):
        for v in eigenvectors(scatter, m, t, multiplicity):
            values.append(Fraction(m, 1 << t))
            vectors.append(v)
    return values[:k], np.array(vectors[:k])


def _root(x: Fraction) -> float:
    """Square root, from an integer root with 64 more bits."""
    return isqrt((x.numerator << 256) // x.denominator) / (1 << 128)


def whiten(rows: DataFrame, id_col: str, vector_col: str, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row per remaining row and component: the id (under its name), ``component, n, deviation, whitened, explained,
    identity_error, deviation_exact``."""
    spark = rows.sparkSession
    used = rows.where(finite_vector(F.col(f"`{vector_col}`"))).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    used, seen = written_with(used, n=F.count(F.lit(1)), width=F.max(F.size("v")))
    n, width = seen["n"], seen["width"]
    kind = rows.schema[id_col].dataType.simpleString()
    none = spark.createDataFrame([], f"`{id_col}` {kind}, {OUTPUT}")
    if not n or not width:
        return none
    sums, products = moments(used, width, scale)
    total = np.array(sums, object)
    scatter = n * products - total[:, None] * total[None, :]
    trace = int(np.trace(scatter))
    if not trace:
        return none
    values, vectors = principal_components(spark, scatter, components)
    # whitened = (x - S/n) v / sqrt(e) with e = value / n^2, so n (x - S/n) v / sqrt(value)
    project = (vectors / np.array([_root(x) for x in values])[:, None]).T

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y = _entries(batch["v"], width, scale)
            largest = (int(np.abs(y).max(initial=0)) * n + max(map(abs, sums))) ** 2 * width
            z = y * n - np.array(sums, np.int64) if largest < 2 ** 62 else y.astype(object) * n - total
            yield pd.DataFrame({"id": batch["id"], "dev": [str(x) for x in (z * z).sum(axis=1)],
                                "w": list(z.astype(np.float64) @ project)})

    out = written(used.mapInPandas(run, f"id {kind}, dev string, w array<double>"))
    k = len(values)
    means = out.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(k)]).first()
    centred = [F.col("w")[i] - F.lit(means[i]) for i in range(k)]
    cov = out.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i, k))
    explained = F.array(*[F.lit(float(x / trace)) for x in values])
    exact = F.col("dev").cast("decimal(38,0)")
    return (out.select("id", exact.alias("exact"), F.posexplode("w").alias("c", "whitened"))
            .select(F.col("id").alias(id_col), (F.col("c") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
                    F.expr("try_cast(exact as bigint)").alias("deviation"), "whitened", F.element_at(explained, F.col("c") + 1).alias(
                        "explained"), F.lit(float(error)).alias("identity_error"), F.col("exact").alias("deviation_exact")))


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding")
