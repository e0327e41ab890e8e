"""Document fingerprints: bottom-k sketches of word-shingle hashes.

The k smallest distinct 48-bit hashes of a text's five-word shingles.  Two sketches merge into that of the union, and
estimate resemblance, containment and the number of distinct shingles.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import grown, only_new, shingle_sets, slices, table, text_bytes

K = 128
WIDTH = 5
RANGE_BYTES = 24 << 20
#: Ranges at most: what of them reaches the driver.
MOST_RANGES = 10_000
_BITS = 48


def sketches(texts: pa.Array, k: int = K, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted uint64 arrays of at most k hashes; fewer than k means that they are all there are."""
    out = []
    for hashes in shingle_sets(*text_bytes(texts), width):
        short = hashes >> np.uint64(64 - _BITS)
        out.append(np.unique(short)[:k] if len(short) <= k else short[: k + 8][np.concatenate([[True], np.diff(short[: k + 8]) > 0])][:k])
    return out


def to_string(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _BITS // 8 :].tobytes()).decode()


def from_string(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, _BITS // 8)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - _BITS // 8 :] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**_BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; two empty sets are alike (1), an empty one and another are not (0)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    union = np.concatenate([[True], ~twice])
    rank = np.cumsum(union)
    n = min(k, int(rank[-1]))
    return float(np.count_nonzero(twice & (rank[1:] <= n))) / n


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    union = distinct(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct(a, k))


def fingerprint(docs: DataFrame, text: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """All columns and fingerprint string, shingles double (distinct, estimated).  A null text counts as empty: an empty fingerprint."""
    docs = only_new(docs, "fingerprint", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                found = sketches(batch.column(text), k, width)
                new = [pa.array([to_string(s) for s in found], pa.string()), pa.array([distinct(s, k) for s in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "fingerprint", "shingles"])

    return docs.mapInArrow(run, grown(docs, fingerprint="string", shingles="double"))


def merge_parts(parts: DataFrame, group: str, k: int = K) -> DataFrame:
    """One (group, fingerprint) row a group from the fingerprints of its parts: merged in each partition first, so a hot group moves k hashes a task; nulls are a group of their own."""
    schema = grown(parts.select(group), fingerprint="string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for key, print_ in zip(batch[group], batch["fingerprint"], strict=True):
                key = None if pd.isna(key) else key
                new = from_string(print_ or "")
                held[key] = merge(held[key], new, k) if key in held else new
            if len(held) > 50_000:
                yield pd.DataFrame({group: list(held), "fingerprint": [to_string(s) for s in held.values()]})
                held = {}
        if held:
            yield pd.DataFrame({group: list(held), "fingerprint": [to_string(s) for s in held.values()]})

    def last(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = from_string("")
        for print_ in rows["fingerprint"]:
            whole = merge(whole, from_string(print_), k)
        return pd.DataFrame({group: [None if pd.isna(key[0]) else key[0]], "fingerprint": [to_string(whole)]})

    return parts.select(group, "fingerprint").mapInPandas(run, schema).groupBy(group).applyInPandas(last, schema)


def edited(text: str, following: str) -> str:
    """`text` with its last third replaced by as many code points from the start of `following`."""
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]


def in_descending_order(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows dealt into ranges of descending doc_id (ties by descending hash of the text) and sorted in them, each range closed by a copy (ghost 1) of the row that opens the next one, the last by the very first.

    Only range bounds and the first row's id and hash of each range reach the driver, of MOST_RANGES ranges at most; a
    range beyond that is larger, sorted with spill and read as a stream.  An id that fills ranges of its own (or null
    ids) is split among them by the hash.  Columns: _vx_range, _vx_ghost, doc_id, text.
    """
    low = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    sized = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    n = min(MOST_RANGES, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sized // range_bytes)))
    steps = [float(i) / n for i in range(1, n)]
    bounds = docs.agg(F.percentile_approx(low, steps, max(10_000, 10 * n))).first()[0] if steps else []
    cuts = np.array(sorted(bounds or []), np.int64)
    last = len(cuts)

    def cells(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Range of each row; an id that is a bound m times has m - 1 ranges to itself, dealt by the upper bits of the hash."""
        left, right = np.searchsorted(cuts, ids, side="left"), np.searchsorted(cuts, ids, side="right")
        own = np.maximum(right - left - 1, 0)
        upper = (hashes >> 32) + (1 << 31)
        return last - np.where(own > 0, left + 1 + ((upper * own) >> 32), left)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(cells(ids.to_numpy(np.int64), hashes.to_numpy(np.int64))).astype("int32")

    named = docs.select("doc_id", "text", low.alias("_vx_id"), F.xxhash64("text").alias("_vx_hash"))
    ranged = named.withColumn("_vx_range", range_of("_vx_id", "_vx_hash"))
    firsts = sorted((r[0], tuple(r[1])) for r in ranged.groupBy("_vx_range").agg(F.max(F.struct("_vx_id", "_vx_hash"))).collect())
    opens = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        a, b = ids.to_numpy(np.int64), hashes.to_numpy(np.int64)
        return pd.Series([[o, opens[v, h]] if (v, h) in opens else [o] for o, v, h in zip(cells(a, b).tolist(), a.tolist(), b.tolist(), strict=True)])

    dealt = named.withColumn("_vx_places", places("_vx_id", "_vx_hash"))
    exploded = dealt.select("doc_id", "text", "_vx_id", "_vx_hash", F.posexplode("_vx_places").alias("_vx_ghost", "_vx_range"))
    return exploded.repartition(n, "_vx_range").sortWithinPartitions("_vx_range", "_vx_ghost", F.desc("_vx_id"), F.desc("_vx_hash"), "text").select("_vx_range", "_vx_ghost", "doc_id", "text")


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def compare_with_edits(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """For each row its fingerprint, that of its edited text (see `edited`; the following row in descending doc_id) and their likeness.

    A null text is empty; null doc_ids come last; tied doc_ids go by the hash of their text, then by it; a single row follows itself; an empty table
    gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = list(zip(batch.column("doc_id").to_pylist(), (t or "" for t in batch.column("text").to_pylist()), batch.column("_vx_ghost").to_pylist(), strict=True))
                found = [(*row, s) for row, s in zip(rows, sketches(batch.column("text"), k, width), strict=True)]
                chain = [waiting, *found] if waiting else found
                waiting = chain[-1]
                pairs = [(a, b) for a, b in zip(chain[:-1], chain[1:], strict=True) if not a[2]]
                if not pairs:
                    continue
                texts = [edited(a[1], b[1]) for a, b in pairs]
                other = sketches(pa.array(texts, pa.large_string()), k, width)
                columns = [
                    [a[0] for a, _ in pairs],
                    [len(a[1]) for a, _ in pairs],
                    [hashlib.sha256(t.encode()).hexdigest() for t in texts],
                    [to_string(a[3]) for a, _ in pairs],
                    [to_string(s) for s in other],
                    [resemblance(a[3], s, k) for (a, _), s in zip(pairs, other, strict=True)],
                    [resemblance(a[3], b[3], k) for a, b in pairs],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, RESULT.types, strict=True)], schema=RESULT)

    return in_descending_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document against its edited text and the next document."""
    return compare_with_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
