"""Two-pass external shuffle into shards.

Pass one scatters the records by a seeded hash into buckets sized to memory; pass two loads one bucket at a time,
shuffles it by Fisher-Yates and lays it down.  A bucket's place in the whole follows from the bucket counts alone, so
the shards hold row counts at most one apart (law `rows`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.llm.common import numbered, only_new, prefix_sum, small, table

SHARDS = 40
SEED = 71
BUCKET_BYTES = 16 << 20
#: Slots in a file of a written shard.
PART_ROWS = 100_000
_OWN = ("_vx_bucket", "_vx_hash", "_vx_place", "_vx_ordinal")


def fisher_yates(n: int, *seed: int) -> np.ndarray:
    """A permutation of 0 .. n-1."""
    order = np.arange(n)
    picks = (np.random.default_rng(list(seed)).random(n) * np.arange(1, n + 1)).astype(np.int64)
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def shuffle(df: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of `df`, and shard int, slot long (gapless from 0 in each shard).

    Buckets hash key and text, so a source or a group of copies with different keys spreads evenly; equal rows without a
    key are numbered and spread by that too.  A null text hashes as null; repeated rows may swap places with each other
    only; a very long text makes its bucket as large as itself; an empty table stays empty.  Input columns named shard or
    slot are replaced.
    """
    df = only_new(df, "shard", "slot", *_OWN)
    wanted = df.columns
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 16
    rows, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    df = numbered(df, key)
    hashed = df.withColumn("_vx_hash", F.xxhash64(F.lit(seed), F.col(key), F.col(text), F.col("_vx_ordinal"))).drop("_vx_ordinal")
    dealt = hashed.withColumn("_vx_bucket", F.pmod("_vx_hash", F.lit(buckets)).cast("long"))
    counts = dealt.groupBy("_vx_bucket").agg(F.count(F.lit(1)).alias("_vx_n"))
    starts = prefix_sum(counts, "_vx_bucket", "_vx_n", "_vx_start").select("_vx_bucket", "_vx_start")

    def second_pass(bucket: pa.Table) -> pa.Table:
        number = bucket.column("_vx_bucket")[0].as_py()
        bucket = bucket.sort_by([("_vx_hash", "ascending"), (key, "ascending")])
        bucket = bucket.take(pa.array(fisher_yates(bucket.num_rows, seed, number)))
        return bucket.append_column("_vx_place", pa.array(np.arange(bucket.num_rows)))

    schema = T.StructType([*dealt.schema.fields, T.StructField("_vx_place", T.LongType())])
    # as many partitions as buckets, so that each task holds a bucket or two at any size of input
    spread = dealt.repartition(max(buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "_vx_bucket")
    mixed = spread.groupBy("_vx_bucket").applyInArrow(second_pass, schema)
    placed = mixed.join(small(starts, buckets), "_vx_bucket").withColumn("_vx_place", F.col("_vx_place") + F.col("_vx_start"))
    shard = F.floor(F.col("_vx_place") * shards / F.lit(max(1, rows))) if rows * shards < 1 << 52 else F.expr(f"_vx_place * {shards} div {max(1, rows)}")
    placed = placed.withColumn("shard", shard.cast("int"))
    start = F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("slot", (F.col("_vx_place") - start).cast("long")).select(*wanted, "shard", "slot")


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Writes the shuffled records as Parquet, one folder a shard.

    A shard is cut into runs of PART_ROWS slots, each sorted and written by one task as a file of its own, so no task
    gets a whole shard; the names of a folder's files follow the slots.
    """
    placed = shuffle(df, **options).withColumn("part", F.floor(F.col("slot") / PART_ROWS))
    placed.repartition("shard", "part").sortWithinPartitions("shard", "part", "slot").write.partitionBy("shard", "part").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every document's place, with digests taken from the shuffled records."""
    out = shuffle(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
