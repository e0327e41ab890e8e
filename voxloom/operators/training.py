"""Training data: track lengths, chunks and mixtures as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def track_lengths(stems: DataFrame, track: str = "track", length: str = "n") -> DataFrame:
    """(track, n, mismatch): the shortest stem's length, and whether the stems differ; a stem without a file (null) does not count."""
    return stems.groupBy(track).agg(F.min(length).alias("n"), (F.min(length) != F.max(length)).alias("mismatch")).where("n is not null")


def loud_enough(samples: Column, least: float) -> Column:
    """Whether an array of samples has a mean absolute value of `least` or more."""
    total = F.aggregate(samples, F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    return F.coalesce((F.size(samples) > 0) & (total / F.size(samples) >= least), F.lit(False))


def chunk_offset(seed: int, item: Column, n: Column, size: int) -> Column:
    """Where a random chunk of an item begins, the same in every run: 0 for a track shorter than the chunk, which is padded."""
    return F.pmod(F.xxhash64(F.lit(seed), item), F.greatest(n - size, F.lit(0)) + 1)


def chunk_items(tracks: DataFrame, per_track: int, size: int, hop: int, index: str = "index") -> DataFrame:
    """(item, index, chunk, start, end) of a data set that walks over all tracks (index from 0) chunk by chunk: item % tracks is the track, item // tracks the chunk."""
    n = tracks.count()
    spread = tracks.select(index, F.explode(F.sequence(F.lit(0), F.lit(per_track - 1))).alias("chunk"))
    start = (F.col("chunk") * hop).cast("long")
    return spread.select((F.col("chunk").cast("long") * n + F.col(index)).alias("item"), index, "chunk", start.alias("start"), (start + size).alias("end"))


def mixture(stems: DataFrame, keys: list[str], value: str = "v", gain: str | None = None) -> DataFrame:
    """(keys, value): the sum over the stems, each by its own gain if there is one."""
    level = F.col(value) * F.coalesce(F.col(gain), F.lit(1.0)) if gain else F.col(value)
    return stems.groupBy(*keys).agg(F.sum(level).alias(value))


def clip_scale(rows: DataFrame, keys: list[str], value: str = "v", limit: float = 1.0) -> DataFrame:
    """Rows scaled down by key where their peak is beyond the limit."""
    peaks = rows.groupBy(*keys).agg(F.max(F.abs(F.col(value))).alias("_peak"))
    return rows.join(peaks, keys).withColumn(value, F.when(F.col("_peak") > limit, F.col(value) * limit / F.col("_peak")).otherwise(F.col(value))).drop("_peak")
