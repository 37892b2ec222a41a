"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridcast.session import checkpoint_dir

HOT_LEAST = 10_000
BROADCAST_ROWS = 200_000
BATCH_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files,
    so that a lost executor re-reads them instead of recomputing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_with(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`written`, and aggregates of the rows that the same pass takes."""
    seen = Observation()
    out = written(df.observe(seen, *[m.alias(k) for k, m in metrics.items()]))
    got = seen.get
    return out, {k: got.get(k) or 0 for k in metrics}


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until the frame has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def set_aside(df: DataFrame, *added: str) -> DataFrame:
    """``df`` with underscores at the end of columns named as the ``added`` ones,
    until no two columns share a name."""
    new = {a.lower() for a in added}
    taken, names = {c.lower() for c in df.columns} | new, {}
    for c in df.columns:
        n = c
        while c.lower() in new and n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        names[c] = n
    return df.select(*[F.col(f"`{c}`").alias(names[c]) for c in df.columns])


def give_back() -> None:
    """In a Python worker: return freed memory to the system. Idle workers are kept for
    later stages, and the allocators would keep the most that a batch ever took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Send Python workers at most ``BATCH_BYTES`` of texts at once (Spark's own bound is 64 MB, held
    on both sides of the pipe), unless the session sets a smaller bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def finite_vector(vector: Column) -> Column:
    """True for an array that is not null and holds no null, NaN or infinity."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def join_hot(left: DataFrame, right: DataFrame, on: str, weight: str, rows: int, how: str = "inner",
             most: int | None = None, least: int = HOT_LEAST) -> DataFrame:
    """``left`` joined with ``right``, which has one row per key and says in
    ``weight`` how many rows of ``left`` have the key. Keys with over a
    thousandth of the ``rows`` (at most 1000 keys) are joined by broadcast.
    ``most``: the largest weight, where it is known; ``least``: keys with no more rows than that stay whole."""
    least = max(least, rows // 1000)
    if rows <= least or (most is not None and most <= least):
        return left.join(right, on, how)
    hot, cold = right.where(F.col(weight) > least), right.where(F.col(weight) <= least)
    if hot.isEmpty():
        return left.join(right, on, how)
    return (left.join(F.broadcast(hot), on)
            .unionByName(left.join(F.broadcast(hot.select(on)), on, "left_anti").join(cold, on, how),
                         allowMissingColumns=True))


def join_sized(left: DataFrame, right: DataFrame, on: str, weight: str) -> DataFrame:
    """Inner join with a written table of one row per key (``weight``: rows of
    ``left`` with the key): by broadcast while it has at most
    ``BROADCAST_ROWS`` rows, else by shuffle with hot keys split off."""
    size = right.agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("rows")).first()
    if size["n"] <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on)
    return join_hot(left, right, on, weight, size["rows"])
