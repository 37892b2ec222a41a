"""Two-pass external shuffle into shards (native).

Pass 1 scatters the records uniformly over buckets with a seeded hash of id
and text; the number of buckets follows the bytes, so that a bucket fits in a
task's memory whatever the table's size. Pass 2 shuffles each bucket in memory
with Spark's ``shuffle`` (a Fisher-Yates permutation) and deals the buckets,
one after the other, over the shards like cards: global place p goes to shard
``p % shards``, slot ``p // shards`` (law ``rows``: counts differ by one at
most, slots have no gaps).

Reruns: the bucket's rows are sorted before they are shuffled and each bucket
stands at a fixed place of a fixed partition, so a recomputed task draws the
same permutation. Defined cases: a null text has no bytes; null ids and equal
texts spread by the other column; repeated rows are records of their own; an
empty table gives no rows; input columns that clash with ``shard`` or ``slot``
get underscores added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import fresh, set_aside, table, text_crc32, written

SHARDS = 40
BUCKET_BYTES = 16 << 20
SEED = 20_240_501


def shard(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``shard`` (0 to ``shards`` - 1) and ``slot``."""
    base = set_aside(docs, "shard", "slot")
    cols = base.columns
    bucket, place, group, key, rec = fresh(base, "bucket", "place", "records", "key", "rec")
    # size of the input: octets only, no text leaves the scan
    total = base.agg(F.coalesce(F.sum(F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)) + 16),
                                F.lit(0)).alias("b")).first()["b"]
    n = max(1, -(-int(total) // int(bucket_bytes)))

    # pass 1: scatter; the exchange's files hold the scattered records
    h = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    scattered = base.withColumn(key, h).withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(n)))
    counts = scattered.groupBy(bucket).count()
    offsets = written(counts.select(F.col(bucket).alias("o_bucket"), F.coalesce(F.sum("count").over(
        Window.partitionBy(F.lit(0)).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("offset")))

    # pass 2: Fisher-Yates in each bucket, then deal by global place
    packed = (scattered.repartition(n, bucket).groupBy(bucket)
              .agg(F.array_sort(F.collect_list(F.struct(key, *[F.col(f"`{c}`") for c in cols]))).alias(group))
              .sortWithinPartitions(bucket)
              .select(bucket, F.shuffle(F.col(group), F.lit(seed)).alias(group)))
    dealt = packed.select(bucket, F.posexplode(group).alias(place, rec))
    # one row per bucket: about bytes / bucket_bytes rows
    dealt = dealt.join(offsets, F.col(bucket) == F.col("o_bucket"))
    p = F.col("offset") + F.col(place)
    return dealt.select(*[F.col(rec).getField(c).alias(c) for c in cols],
                        (p % shards).cast("int").alias("shard"), F.floor(p / shards).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    s = shard(table(spark, sf_dir, "documents"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    return s.select("doc_id", size.alias("size"), text_crc32(F.col("text")).alias("text_crc32"),
                    F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
