"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import atexit
import contextlib
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Up to so many rows a side may be broadcast; beyond it the same join runs as a shuffle join.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only in local mode (tests), and an error where a cluster names none."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or "/tmp/checkpoints/voxloom"


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Folders whose last tables results may still be read from; they go when the driver ends.
_open: dict[str, SparkSession] = {}


@atexit.register
def _delete_all() -> None:
    for top, spark in _open.items():
        with contextlib.suppress(Exception):  # the session may be gone
            _delete(spark, top)


class Scratch:
    """Intermediate tables in the shared folder: written once, reread by later jobs, so that a lost executor costs no lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.top = spark, f"{shared_dir(spark)}/voxloom-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._kept: list[str] = []
        _open[self.top] = spark

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.top}/{self._n}"
        self._n += 1
        df.write.parquet(path)
        self._kept.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def last(self, df: DataFrame) -> DataFrame:
        """Writes the result and deletes all tables before it."""
        kept, out = list(self._kept), self.keep(df)
        for path in kept:
            _delete(self.spark, path)
        self._kept = self._kept[-1:]
        self.tidy()
        return out

    def tidy(self) -> None:
        """Lets Spark's cleaner delete the shuffle files of jobs that are over; else they stay until the driver next collects its garbage."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, df: DataFrame) -> None:
        """Deletes a table that no later job reads."""
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            _delete(self.spark, path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marks a side for broadcast when its counted rows are within BROADCAST_ROWS."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def prefix_sum(df: DataFrame, order: str, value: str, out: str, width: int = 4096) -> DataFrame:
    """Adds `out`, the sum of `value` over rows of a smaller `order` (a dense id from 0), by blocks of ids: no task gets all rows but the block totals."""
    blocks = df.withColumn("_vx_ps_block", F.floor(F.col(order) / F.lit(width)))
    totals = blocks.groupBy("_vx_ps_block").agg(F.sum(value).alias("_vx_ps_total"))
    before = totals.withColumn("_vx_ps_before", F.sum("_vx_ps_total").over(Window.orderBy("_vx_ps_block").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.sum(value).over(Window.partitionBy("_vx_ps_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    joined = blocks.join(before.select("_vx_ps_block", "_vx_ps_before"), "_vx_ps_block")
    return joined.withColumn(out, F.coalesce(inside, F.lit(0)) + F.coalesce("_vx_ps_before", F.lit(0))).drop("_vx_ps_block", "_vx_ps_before")


def numbered(df: DataFrame, key: str, out: str = "_vx_ordinal") -> DataFrame:
    """Adds `out`: 0 for rows with a key; rows without one are counted by equal rows and numbered from 1, so that each has a number of its own.

    Equal rows collapse before they are shuffled and are laid out again in steps of 10,000, so no task gets them all.
    A table with a map column, by which rows cannot be grouped, gets 0 everywhere.
    """
    if any("map<" in kind for _, kind in df.dtypes):
        return df.withColumn(out, F.lit(0).cast("long"))
    alike = df.where(F.col(key).isNull()).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_vx_alike"))
    steps = alike.withColumn("_vx_step", F.explode(F.expr("sequence(0L, (_vx_alike - 1) div 10000L)"))).repartition(F.hash("_vx_step", *df.columns))
    rows = steps.withColumn(out, F.explode(F.expr("sequence(_vx_step * 10000L + 1L, least(_vx_alike, (_vx_step + 1) * 10000L))"))).drop("_vx_step", "_vx_alike")
    return df.where(F.col(key).isNotNull()).withColumn(out, F.lit(0).cast("long")).unionByName(rows)


def only_new(df: DataFrame, *names: str) -> DataFrame:
    """Drops input columns that an operator's own result columns would clash with."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def grown(df: DataFrame, **types: str) -> T.StructType:
    """The schema of `df` with more columns at its end."""
    schema = T.StructType([*df.schema.fields])
    for name, kind in types.items():
        schema.add(name, T.DataType.fromDDL(kind))
    return schema


def slices(batch: pa.RecordBatch, column: str, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Cuts a batch at rows so that each slice holds about `most` bytes of text, or a single longer row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, offsets); a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_P = np.uint64(0x9E3779B97F4A7C15 | 5)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, p, np.uint64)])) for p in (_P, _P_INV)]
    return _powers


#: Bytes whose words are hashed at once, some 50 bytes of arrays each; a longer text is worked off in parts.
HASHED_BYTES = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of each text, A-Z lower-cased, and the word offsets of each text."""
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(data):
        to = min(len(data), at + HASHED_BYTES)
        if to < len(data):  # cut after a space or at the end of a text, further on where there is none
            spaces = np.flatnonzero(_SPACE[data[at:to]])
            ends = offsets[np.searchsorted(offsets, at, side="right") : np.searchsorted(offsets, to, side="right")]
            to = max(at + int(spaces[-1]) + 1 if len(spaces) else at, int(ends[-1]) if len(ends) else at)
            while to == at or (to < len(data) and not _SPACE[data[to - 1]] and offsets[np.searchsorted(offsets, to)] != to):
                far = min(len(data), max(to, at + HASHED_BYTES) + HASHED_BYTES)
                spaces = np.flatnonzero(_SPACE[data[max(to, at) : far]])
                to = max(to, at) + int(spaces[0]) + 1 if len(spaces) else far
        part, begins = _hashed(data[at:to], np.clip(offsets - at, 0, to - at))
        hashes.append(part)
        starts.append(begins + at)
        at = to
    begins = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(begins, offsets).astype(np.int64)


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of a part of the texts."""
    low = _LOWER[data]
    word = ~_SPACE[low]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0], before[1:] = False, word[:-1]
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    power, inverse = _tables(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTES[low] * power[: len(data)], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles; a text of fewer words is one shingle; without words the set is empty."""
    words, at = word_hashes(data, offsets)
    n = len(words)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for i in range(width):
        rolled += words[i : i + len(rolled)] * np.uint64(pow(int(_P), i + 1, 1 << 64))
    rolled = mix64(rolled)
    sets = []
    for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if e - s >= width:
            sets.append(np.unique(rolled[s : e - width + 1]))
        elif e > s:
            part = words[s:e] * np.array([pow(int(_P), i + 1, 1 << 64) for i in range(e - s)], np.uint64)
            sets.append(mix64(part.sum(keepdims=True, dtype=np.uint64) + np.uint64(e - s)))
        else:
            sets.append(words[:0])
    return sets
