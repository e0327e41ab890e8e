"""Best-fit packing of tokenised documents by the linear grouping scheme.

A document's token ids are cut into full sequences, which need no packing, and one shorter piece.  The pieces' lengths
form a histogram of at most 1023 entries, whatever the size of the corpus; only that reaches the driver.  There the
large lengths go, in groups of equal cardinality, to their group's largest; configurations of these few sizes are
optimised by column generation; the actual lengths take the rounded ones' places; and the small lengths fill the gaps
best-fit.  The plan is a short list of bin contents with multiplicities.  Each piece then finds its place from its rank
among the pieces of its length, which is counted in salted cells.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.llm.common import Scratch, grown, prefix_sum, slices, table

CAPACITY = 1024
END = 2
#: Lengths above this are large.
LARGE = 128
GROUPS = 64
CELL_ROWS = 20_000

Bin = tuple[tuple[int, ...], int]


@functools.cache
def _encoder():
    """The byte-level BPE of the 50k vocabulary, and the added tokens of the tokenizers file.  The ranks file gives the ids of the tokenizers file (see the tests), several times faster."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def token_ids(text: str | None, added: bool = False) -> np.ndarray:
    """Ids of a text, and END; with `added`, added tokens that stand in the text get their own ids (as the tokenizers file has it), else they are plain text."""
    ids = _encoder().encode_to_numpy(text or "", allowed_special="all" if added else set(), disallowed_special=())
    return np.append(ids, END).astype("<u4")


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """key, piece int, start long, length long, ids_crc32 long (and ids array<long>): the first piece takes what full pieces leave."""
    keep = docs.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                out = []
                for name, content in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist(), strict=True):
                    own = token_ids(content, added=True)
                    first = len(own) % capacity or capacity
                    bounds = [0, *range(first, len(own) + 1, capacity)]
                    out += [(name, i, s, e - s, zlib.crc32(own[s:e].tobytes()), own[s:e].tolist() if ids else None) for i, (s, e) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
                kinds = (batch.schema.field(key).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                names = [key, "piece", "start", "length", "ids_crc32", "ids"]
                columns = list(zip(*out, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)][: 5 + ids], names[: 5 + ids])

    schema = grown(docs.select(key), piece="integer", start="long", length="long", ids_crc32="long")
    if ids:
        schema = grown(docs.select(key), piece="integer", start="long", length="long", ids_crc32="long", ids="array<bigint>")
    return keep.mapInArrow(run, schema)


def _knapsack(sizes: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best value of a configuration, and how often it has each size."""
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), np.int16)
    for i, (size, value) in enumerate(zip(sizes.tolist(), values.tolist(), strict=True)):
        if value <= 1e-12:
            continue
        now = best.copy()
        for n in range(1, min(capacity // size, int(most[i])) + 1):
            with_n = best[: capacity + 1 - n * size] + n * value
            better = with_n > now[n * size :] + 1e-12
            now[n * size :][better] = with_n[better]
            taken[i, n * size :][better] = n
        best = now
    counts, room = np.zeros(len(sizes), np.int64), int(best.argmax())
    for i in range(len(sizes) - 1, -1, -1):
        counts[i] = taken[i, room]
        room -= counts[i] * sizes[i]
    return float(best.max()), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000, gap: float = 0.001) -> list[tuple[np.ndarray, int]]:
    """Configurations of a few sizes with multiplicities, within the demand: the cutting-stock linear program by column generation (revised simplex) to within `gap` of Farley's bound, rounded down."""
    m = len(sizes)
    basis = np.diag(np.minimum(capacity // sizes, np.maximum(demand, 1)).astype(float))
    inverse = np.linalg.inv(basis) if m else basis
    x = inverse @ demand
    for step in range(rounds if m else 0):
        duals = inverse.sum(axis=0)
        value, column = _knapsack(sizes, duals, demand, capacity)
        if value <= 1 + 1e-7 or x.sum() <= (1 + gap) * float(duals @ demand) / value:
            break
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / direction[up]
        leave = int(ratio.argmin())
        basis[:, leave] = column
        if step % 50 == 49:
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ demand, 0)
        else:
            theta = ratio[leave]
            x = np.maximum(x - theta * direction, 0)
            x[leave] = theta
            pivot = inverse[leave] / direction[leave]
            inverse = inverse - np.outer(direction, pivot)
            inverse[leave] = pivot
    left = demand.astype(np.int64).copy()
    out = []
    for j in np.argsort(-x, kind="stable"):
        counts = basis[:, j].round().astype(np.int64)
        has = counts > 0
        n = min(int(x[j] + 1e-6), int((left[has] // counts[has]).min(initial=0))) if has.any() else 0
        if n > 0:
            out.append((counts, n))
            left -= n * counts
    return out


def _substitute(config: list[tuple[np.ndarray, int]], members: list[list[list[int]]]) -> list[Bin]:
    """Bins of actual lengths: each group's documents, longest first, take the places of its rounded size."""
    bins: list[Bin] = []
    for counts, n in config:
        slots = [g for g, c in enumerate(counts.tolist()) for _ in range(c)]
        runs = []
        for g in slots:
            need, run = n, []
            while need:
                length, there = members[g][0]
                take = min(there, need)
                run.append((length, take))
                need -= take
                if take == there:
                    members[g].pop(0)
                else:
                    members[g][0] = [length, there - take]
            runs.append(run)
        at = [0] * len(runs)
        rest = [r[0][1] for r in runs]
        done = 0
        while done < n:
            step = min(rest)
            bins.append((tuple(r[i][0] for r, i in zip(runs, at, strict=True)), step))
            done += step
            for j in range(len(runs)):
                rest[j] -= step
                if not rest[j] and done < n:
                    at[j] += 1
                    rest[j] = runs[j][at[j]][1]
    return bins


def plan(histogram: dict[int, int], capacity: int = CAPACITY, large: int = LARGE, groups: int = GROUPS) -> list[Bin]:
    """(lengths in a bin, number of such bins) for all lengths of the histogram."""
    big = sorted(((n, c) for n, c in histogram.items() if n > large and c), reverse=True)
    small = sorted(((n, c) for n, c in histogram.items() if n <= large and c), reverse=True)
    total = sum(c for _, c in big)
    sizes, demand, members, filled = [], [], [], 0
    exact = len(big) <= groups
    for length, count in big:
        while count:
            end = total if exact else -(-total * len(sizes) // groups)
            if not sizes or (exact and sizes[-1] != length) or (not exact and filled >= end):
                sizes.append(length)
                demand.append(0)
                members.append([])
                end = total if exact else -(-total * len(sizes) // groups)
            take = count if exact else min(count, end - filled)
            demand[-1] += take
            members[-1].append([length, take])
            filled += take
            count -= take
    merged: dict[int, tuple[int, list]] = {}
    for size, n, own in zip(sizes, demand, members, strict=True):
        before = merged.get(size, (0, []))
        merged[size] = (before[0] + n, before[1] + own)
    sizes = sorted(merged, reverse=True)
    config = configurations(np.array(sizes, np.int64), np.array([merged[s][0] for s in sizes], np.int64), capacity)
    members = [merged[s][1] for s in sizes]
    open_bins: dict[tuple[int, ...], int] = {}
    for content, n in _substitute(config, members):
        open_bins[content] = open_bins.get(content, 0) + n
    rest = sorted((tuple(r) for own in members for r in own), reverse=True)
    by_gap: dict[int, dict[tuple[int, ...], int]] = {}

    def put(content: tuple[int, ...], n: int) -> None:
        own = by_gap.setdefault(capacity - sum(content), {})
        own[content] = own.get(content, 0) + n

    for content, n in open_bins.items():
        put(content, n)
    for length, count in rest + small:
        while count:
            gap = next((g for g in range(length, capacity + 1) if by_gap.get(g)), None)
            content, n = ((), count) if gap is None else next(iter(by_gap[gap].items()))
            each = min(count, (capacity if gap is None else gap) // length)
            bins = min(n, count // each) if count >= each else 0
            if gap is not None:
                by_gap[gap][content] -= bins
                if not by_gap[gap][content]:
                    del by_gap[gap][content]
            put((*content, *[length] * each), bins)
            count -= bins * each
    return [(content, n) for own in by_gap.values() for content, n in own.items()]


def places(bins: list[Bin]) -> list[tuple[int, int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, first sequence, copies of the length in a bin, offset of the first, next rank): where the pieces of a length go, in order of rank."""
    out, ranks, sequence = [], {}, 0
    for content, n in bins:
        offset = 0
        for length in dict.fromkeys(content):
            each = content.count(length)
            first = ranks.get(length, 0)
            out.append((length, first, n * each, sequence, each, offset, first + n * each))
            ranks[length] = first + n * each
            offset += each * length
        sequence += n
    return out


def _ranked(cut: DataFrame, key: str, rows: int) -> DataFrame:
    """Adds `rank` among the pieces of the same length (from 0): salted cells are counted first, so no task sees all pieces of a length."""
    cells = max(1, -(-rows // CELL_ROWS))
    salted = cut.withColumn("_vx_cell", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(cells)).cast("long"))
    counts = salted.groupBy("length", "_vx_cell").agg(F.count(F.lit(1)).alias("_vx_n"))
    dense = counts.withColumn("_vx_order", F.col("length") * cells + F.col("_vx_cell"))
    before = prefix_sum(dense, "_vx_order", "_vx_n", "_vx_before")
    lengths = counts.groupBy("length").agg(F.sum("_vx_n").alias("_vx_n")).withColumn("_vx_zero", F.lit(0))
    # a length's own start: all pieces of smaller lengths; at most `capacity` rows
    starts = lengths.withColumn("_vx_start", F.coalesce(F.sum("_vx_n").over(Window.partitionBy("_vx_zero").orderBy("length").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = before.join(F.broadcast(starts.select("length", "_vx_start")), "length").select("length", "_vx_cell", (F.col("_vx_before") - F.col("_vx_start")).alias("_vx_offset"))
    inside = F.row_number().over(Window.partitionBy("length", "_vx_cell").orderBy(key, "piece", "ids_crc32"))
    return salted.withColumn("_vx_row", inside).join(offsets, ["length", "_vx_cell"]).withColumn("rank", F.col("_vx_offset") + F.col("_vx_row") - 1).drop("_vx_cell", "_vx_row", "_vx_offset")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """key, piece, start, length, ids_crc32 (and ids), sequence_id long, offset long: every piece's place in sequences of at most `capacity` tokens.

    A null or empty text is one piece of one token; null keys, ties and repeated rows are packed like any others; an
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    cut = Scratch(spark, "packing").keep(pieces(docs, key, text, capacity, ids))
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    rows = sum(histogram.values())
    # full pieces are bins of their own; the plan holds the others, at most `capacity` - 1 lengths
    full = histogram.get(capacity, 0)
    bins = [((capacity,), full)] * bool(full) + plan({n: c for n, c in histogram.items() if n < capacity}, capacity)
    spots = spark.createDataFrame(places(bins), "length long, _vx_first long, _vx_ranks long, _vx_sequence long, _vx_each long, _vx_at long, _vx_next long")
    ranked = _ranked(cut, key, rows)
    placed = ranked.join(F.broadcast(spots), (ranked["length"] == spots["length"]) & (ranked["rank"] >= spots["_vx_first"]) & (ranked["rank"] < spots["_vx_next"])).drop(spots["length"])
    turn = F.col("rank") - F.col("_vx_first")
    return placed.select(
        *cut.columns,
        (F.col("_vx_sequence") + F.floor(turn / F.col("_vx_each"))).cast("long").alias("sequence_id"),
        (F.col("_vx_at") + F.pmod(turn, F.col("_vx_each")) * F.col("length")).cast("long").alias("offset"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every piece of every document in its sequence."""
    return pack(table(spark, sf_dir, "documents"))
