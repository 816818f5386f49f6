"""Two-pass external shuffle of records into shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from bazaarlake.llm.batches import quoted

BUCKET_BYTES = 32 * 2**20


def shuffle_into_shards(
    df: DataFrame, key: str, text: str, shards: int, seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All columns of ``df`` plus ``shard`` and ``slot``, in uniformly shuffled order.

    Pass one scatters records by a seeded hash of their key (of their text where the
    key is null) into as many buckets as keep one near ``bucket_bytes``. Pass two
    puts each bucket in a fixed order and Fisher-Yates shuffles it. A record's
    place in the whole order is its bucket's offset plus its place in the bucket;
    place modulo ``shards`` is the shard, the quotient the slot. So shards differ by
    one row at most, slots have no gaps, and the result depends on the data and
    the seed alone. Null keys and texts are rows like others; rows that are equal in
    key and text are interchangeable; input columns ``shard`` and ``slot`` are replaced.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    hashed = F.xxhash64(F.lit(seed), F.coalesce(
        F.col(quoted(key)).cast("string"), F.xxhash64(quoted(text)).cast("string")))
    size = F.coalesce(F.octet_length(F.col(quoted(text)).cast("string")), F.lit(0)) + 1
    total = df.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    buckets = -(-total // bucket_bytes) or 1
    bucket = F.pmod(hashed, F.lit(buckets))
    counts = df.select(bucket.alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"))
    offsets = counts.select(F.col("bucket").alias("__b"), (F.sum("rows").over(
        Window.orderBy("bucket")) - F.col("rows")).alias("__offset"))
    carried = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)]
    scattered = df.select(*carried, hashed.alias("hash"), F.xxhash64(quoted(text)).alias("content"),
                          bucket.alias("bucket"))
    # As many partitions as keep each near a bucket; join and grouping need no other exchange.
    placed = scattered.repartition(2 * buckets, "bucket").join(
        offsets, F.col("bucket") == F.col("__b")).drop("__b")
    result = T.StructType([*df.select(*carried).schema.fields,
                           T.StructField("shard", T.IntegerType()),
                           T.StructField("slot", T.LongType())])

    def shuffle(records: pa.Table) -> pa.Table:
        records = records.sort_by([("hash", "ascending"), ("content", "ascending")])
        rng = np.random.default_rng([seed & 0xFFFFFFFF, records["bucket"][0].as_py()])
        place = records["__offset"][0].as_py() + np.arange(len(records))
        records = records.take(rng.permutation(len(records)))  # numpy's is Fisher-Yates
        return records.select([f"c{i}" for i in range(len(kept))]).append_column(
            "shard", pa.array((place % shards).astype("int32"))).append_column(
            "slot", pa.array(place // shards))

    return placed.groupBy("bucket").applyInArrow(shuffle, result).toDF(*kept, "shard", "slot")


def crc32_text(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text; of no bytes where null."""
    return F.crc32(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def write_shards(sharded: DataFrame, path: str, shards: int) -> None:
    """Write each shard as one folder ``shard=N``, rows in slot order."""
    sharded.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)
