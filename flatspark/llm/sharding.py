"""Sharding by a two-pass external shuffle.

The id and the number of shards decide a row's shard: the shard with the highest seeded hash of
both has it, so one shard more takes rows only into itself. Pass one scatters the records of
each shard uniformly into buckets sized to memory, by a seeded hash of columns that tell rows
apart. Pass two shuffles each bucket by Fisher-Yates and writes it; buckets of a shard follow one
another, so a row's slot is the rows of the shard's earlier buckets plus its place in its own.

What is permuted in memory is a bucket's list of row keys; the records themselves move once, by
one exchange and sorts that can spill, so a very long record needs no more than itself.

Null or empty texts are records like others; rows without an id share a shard, not a bucket.
Rows equal in all key columns share a bucket: give keys that are unique, such as a file's name
and the row's index in it. An empty table gives empty shards. Other columns travel with their
rows; ``shard``, ``slot`` and ``grown_shard`` replace columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flatspark.llm.common import written
from flatspark.session import work_dir

BUCKET_BYTES = 8 << 20
RESULTS = ["shard", "slot", "grown_shard"]


def shard_of(row_id: Column, shards: int, seed: int) -> Column:
    """The shard whose hash with the id is highest."""
    ranked = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), row_id).alias("h"), F.lit(s).alias("s")) for s in range(shards)]
    return (F.greatest(*ranked) if shards > 1 else ranked[0])["s"]


def buckets_per_shard(df: DataFrame, size: Column, shards: int, bucket_bytes: int) -> int:
    """So many that buckets take about ``bucket_bytes``, and at least as many in all as shuffle partitions."""
    total = df.select(F.sum(size)).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-max(least, -(-total // bucket_bytes)) // shards))


def shuffled_places(keyed: DataFrame, buckets: int, per_shard: int, seed: int) -> DataFrame:
    """(_bucket, _key, _places): the slots that the rows of a key take.

    Bucket b is partition b, and the shuffle function draws from a generator seeded with the
    partition: the sorted keys and the seed decide the order, also when a task is repeated.
    """
    lists = (
        keyed.groupBy("_bucket", "_key").agg(F.count(F.lit(1)).cast("int").alias("_n"))
        .repartitionById(buckets, F.col("_bucket"))
        .groupBy("_bucket").agg(F.array_sort(F.collect_list(F.struct("_key", "_n"))).alias("_keys"))
    )
    rows = F.flatten(F.transform("_keys", lambda k: F.array_repeat(k["_key"], k["_n"])))
    order = lists.select("_bucket", F.posexplode(F.shuffle(rows, F.lit(seed))).alias("_at", "_key"))
    order = written(order, "shard-order")
    counts = order.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    shard = F.floor(F.col("_bucket") / per_shard)
    before = F.sum("_rows").over(W.partitionBy(shard).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    placed = order.join(starts, "_bucket").select("_bucket", "_key", (F.col("_start") + F.col("_at")).alias("_slot"))
    return placed.groupBy("_bucket", "_key").agg(F.array_sort(F.collect_list("_slot")).alias("_places"))


def shard(
    df: DataFrame, shards: int, row_id: str, keys: list[str], size: Column, seed: int = 42,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The input's columns with ``shard``, ``slot`` and ``grown_shard`` (the shard if there were one
    more); a partition holds one bucket.
    """
    inputs = [c for c in df.columns if c not in RESULTS]
    per_shard = buckets_per_shard(df, size, shards, bucket_bytes)
    buckets = shards * per_shard
    own = shard_of(F.col(row_id), shards, seed)
    key = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    bucket = own * per_shard + F.pmod(F.xxhash64(F.lit(seed + 1), *[F.col(k) for k in keys]), F.lit(per_shard))
    keyed = df.select(F.struct(*inputs).alias("_row"), bucket.cast("int").alias("_bucket"), key.alias("_key"))
    places = shuffled_places(keyed.select("_bucket", "_key"), buckets, per_shard, seed)
    # Records and places of a key meet in the bucket's partition, the places first.
    both = keyed.unionByName(places, allowMissingColumns=True).repartitionById(buckets, F.col("_bucket"))
    of_key = W.partitionBy("_bucket", "_key").orderBy(F.col("_row").isNotNull())
    met = both.select(
        "_bucket", "_row", F.first("_places", ignorenulls=True).over(of_key).alias("_places"),
        (F.row_number().over(of_key) - 1).alias("_copy"))
    out = met.where(F.col("_row").isNotNull()).select(
        "_row.*", F.floor(F.col("_bucket") / per_shard).cast("int").alias("shard"),
        F.element_at("_places", F.col("_copy")).alias("slot"))
    return out.withColumn("grown_shard", shard_of(F.col(row_id), shards + 1, seed))


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, one file per bucket, in slot order."""
    df.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def sharded(df: DataFrame, shards: int, row_id: str, keys: list[str], size: Column, **settings) -> DataFrame:
    """``shard`` written to the shared folder and read back."""
    spark: SparkSession = df.sparkSession
    out = shard(df, shards, row_id, keys, size, **settings)
    path = work_dir(spark, "shards")
    write_shards(out, path)
    return spark.read.schema(out.schema).parquet(path)
