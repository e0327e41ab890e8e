"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

A document is the set of its distinct shingles (of three words unless told); two link at a Jaccard similarity of num / den
(0.9 unless told) or more.  Sets of
sizes in one band (or near its upper end) that are so similar differ in at most k shingles.  The shingle domain is cut
into partitions by hash, in two levels, and for every first-level group each subset of two second-level partitions
gives one signature: the hash of what the set holds there.  By the pigeonhole principle similar sets share one.

Weak signatures (of fewer than `weak` shingles) would be shared by chance, so there are SPARE more groups than the
principle needs: a set with no more than SPARE weak groups agrees with each partner in a group that is not weak, and
can leave its weak signatures out; a set with more sends all.

Equal sets are merged first.  Of the sets under one signature, all are compared with the smallest, the hub, and linked
ones become components.  Where a signature's members still lie in several components they are compared across components.
Parity bitmaps rule most of these pairs out, and only those left are compared on their sets.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.llm.common import Scratch, mix64, shingle_sets, slices, small, table, text_bytes

WIDTH = 3
#: Similarity as a fraction.
NUM, DEN = 90, 100
#: Upper over lower size of a band.
BAND = 1.5
WEAK = 2
#: Rows and shingles in a part of a signature's members; two parts meet in a task.
TILE = 4096
TILE_SHINGLES = 4_000_000
#: Partners that a row names in its tile at first.
REACH = 64
#: Up to this many differing shingles all subsets of two of k + 2 partitions are enumerated, beyond it two levels are used.
ONE_LEVEL = 6


@functools.cache
def bands(upto: int, band: float = BAND) -> list[tuple[int, int]]:
    """(lower, upper) sizes of bands that cover 1 .. upto."""
    out, low = [], 1
    while not out or out[-1][1] < upto:
        high = max(low, int(low * band))
        out.append((low, high))
        low = high + 1
    return out


@functools.cache
def instances(n: int, num: int = NUM, den: int = DEN, band: float = BAND) -> list[tuple[int, int]]:
    """(band number, k) under which a set of n shingles is signed: its own band, and those below if a set there can still be similar."""
    every = bands(1 << max(1, n.bit_length()), band)
    own = next(i for i, (low, high) in enumerate(every) if low <= n <= high)
    out = []
    for t in range(own, -1, -1):
        if num * n > den * every[t][1]:
            break
        # sizes a <= b <= a * den / num differ in at most (den - num) / num * a shingles
        k = (den - num) * every[t][1] // num
        if k:
            out.append((t, k))
    return out


@functools.cache
def _pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.array(list(itertools.combinations(range(n), 2)))
    return both[:, 0], both[:, 1]


def signatures(hashes: np.ndarray, num: int = NUM, den: int = DEN, band: float = BAND, weak: int = WEAK) -> np.ndarray:
    """The PartEnum signatures of a set of shingle hashes (none where only an equal set can be similar)."""
    out = []
    where = (hashes >> np.uint64(20)) & np.uint64((1 << 40) - 1)
    content = mix64(hashes + np.uint64(0x632BE59BD9B4E019))
    low, high = (content & np.uint64(0xFFFFFFFF)).astype(float), (content >> np.uint64(32)).astype(float)
    for number, k in instances(len(hashes), num, den, band) if len(hashes) else ():
        spare = 0 if k <= ONE_LEVEL else 2 + k // 12
        groups, parts = (1, k + 2) if k <= ONE_LEVEL else (k // 2 + 1 + spare, 3)
        part = (where % np.uint64(groups * parts)).astype(np.int64)
        count = np.bincount(part, minlength=groups * parts)
        held = mix64(np.bincount(part, low, groups * parts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.bincount(part, high, groups * parts).astype(np.uint64) + count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        held, count = held.reshape(groups, parts), count.reshape(groups, parts)
        a, b = _pairs(parts)
        name = np.arange(groups * len(a), dtype=np.uint64).reshape(groups, -1) + np.uint64(number << 40)
        signs = mix64(mix64(held[:, a] + name) + held[:, b] * np.uint64(0xC2B2AE3D27D4EB4F))
        few = count[:, a] + count[:, b] < weak
        if k > ONE_LEVEL and np.count_nonzero(few.any(axis=1)) <= spare:
            signs = signs[~few]
        out.append(signs.ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _sets(docs: DataFrame, key: str, text: str, width: int, columns: str, make) -> DataFrame:
    """Rows made of (keys, shingle sets) of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                names = batch.column(key).to_pylist()
                yield make(names, shingle_sets(*text_bytes(batch.column(text)), width))

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, columns)


def _set_keys(names: list[int | None], sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Two 64-bit keys of each set; an empty set gets keys of its own."""
    a, b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    for i, s in enumerate(sets):
        if len(s):
            a[i], b[i] = s.sum(dtype=np.uint64), mix64(s).sum(dtype=np.uint64)
        else:
            a[i], b[i] = mix64(np.array([(names[i] if names[i] is not None else i) & (1 << 64) - 1], np.uint64))[0], len(sets) + i
    return mix64(a).view(np.int64).tolist(), b.view(np.int64).tolist()


def _sizes(names: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    a, b = _set_keys(names, sets)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["_vx_doc", "n", "a", "b"])


def _long_lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*rows, np.zeros(0, np.uint64)]).view(np.int64)))


def _signed(names: list, sets: list[np.ndarray], share: int = 0, passes: int = 1, **rule) -> pa.RecordBatch:
    sizes = _sizes(names, sets)
    signs = [signatures(s, **rule) for s in sets]
    return pa.RecordBatch.from_arrays([*sizes.columns, _long_lists([x[x % np.uint64(passes) == share] for x in signs])], [*sizes.schema.names, "signs"])


def _whole(names: list, sets: list[np.ndarray]) -> pa.RecordBatch:
    a, _ = _set_keys(names, sets)
    bits = pa.array([_parity(s) if len(s) else b"" for s in sets], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(a, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), bits, _long_lists(sets)], ["v", "a", "n", "bits", "shingles"])


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, component): the smallest vertex reachable from each vertex of edges (v, w), by alternating large and small stars."""
    now = scratch.keep(edges.select(F.greatest("v", "w").alias("v"), F.least("v", "w").alias("w")).where("v != w").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("w").alias("v"), F.col("v").alias("w")))
        least = both.groupBy("v").agg(F.least(F.min("w"), F.first("v")).alias("m"))
        large = both.join(least, "v").where("w > v").select(F.col("w").alias("v"), F.col("m").alias("w")).where("v != w").distinct()
        down = large.groupBy("v").agg(F.min("w").alias("m"))
        tied = large.join(down, "v")
        stars = tied.select(F.col("w").alias("v"), F.col("m").alias("w")).unionByName(down.select("v", F.col("m").alias("w"))).where("v != w").distinct()
        new = scratch.keep(stars)
        state = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "w").cast("decimal(38,0)"))).first())
        scratch.drop(now)
        now = new
        if state == before:
            return now.select("v", F.col("w").alias("component"))
        before = state


def _similar(pairs: DataFrame, sets: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Those (v, w) whose shingle sets reach the similarity.  Only sets that some pair names are shuffled."""

    def named(column: str) -> DataFrame:
        wanted = pairs.select(F.col(column).alias("v")).distinct()
        return sets.join(small(wanted, wanted.count()), "v", "left_semi").select(F.col("v").alias(column), F.col("shingles").alias(f"of_{column}"))

    joined = pairs.join(named("v"), "v").join(named("w"), "w")
    shared = F.size(F.array_intersect("of_v", "of_w")).cast("long")
    union = F.size("of_v") + F.size("of_w") - F.col("_vx_shared")
    return joined.withColumn("_vx_shared", shared).where(den * F.col("_vx_shared") >= num * union).select("v", "w").distinct()


def _parity(s: np.ndarray) -> bytes:
    """Parity bitmap of a shingle set, two to four bits a shingle: the bits in which two bitmaps differ are never more than the shingles in which the sets do.  The upper half folds onto the lower one by xor, so bitmaps of two lengths compare as well."""
    n_bits = max(64, 1 << (2 * len(s) - 1).bit_length())
    place = (mix64(s + np.uint64(0x3C6EF372FE94F82B)) & np.uint64(n_bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=n_bits) & 1).astype(np.uint8), bitorder="little").tobytes()


class Bitmaps:
    """Bitmaps of a column of rows, read at any length up to their own."""

    def __init__(self, column: pa.Array):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = column.cast(pa.large_binary())
        self.at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) // 8
        self.words = np.diff(self.at)
        self.flat = np.frombuffer(column.buffers()[2] or b"", np.uint64)

    def folded(self, rows: np.ndarray, words: int) -> np.ndarray:
        out = np.empty((len(rows), words), np.uint64)
        for own in np.unique(self.words[rows]).tolist():
            some = np.flatnonzero(self.words[rows] == own)
            for part in np.array_split(some, 1 + len(some) * own // 2_000_000):
                whole = self.flat[self.at[rows[part]][:, None] + np.arange(own)]
                out[part] = np.bitwise_xor.reduce(whole.reshape(len(part), -1, words), axis=1)
        return out


def _can_link(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of n and m shingles with these bitmaps can reach the similarity."""
    differ = np.maximum(np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64), np.abs(n - m))
    return (den + num) * differ <= (den - num) * (n + m)


def _may_link(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those (v, w) that their bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, w = Bitmaps(batch.column("bits_v")), Bitmaps(batch.column("bits_w"))
            n, m = (batch.column(c).to_numpy() for c in ("n_v", "n_w"))
            keep = np.zeros(batch.num_rows, bool)
            words = np.minimum(v.words, w.words)
            for size in np.unique(words).tolist():
                own = np.flatnonzero(words == size)
                for rows in np.array_split(own, 1 + len(own) * size // 2_000_000):
                    keep[rows] = _can_link(v.folded(rows, size), w.folded(rows, size), n[rows], m[rows], num, den)
            yield batch.select(["v", "w"]).filter(pa.array(keep))

    sides = [sets.select(F.col("v").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "vw"]
    return pairs.join(sides[0], "v").join(sides[1], "w").select("v", "w", "n_v", "n_w", "bits_v", "bits_w").mapInArrow(run, "v long, w long")


def _meetings(c: np.ndarray, part: np.ndarray, split: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of a tile that meet: each two of different components (and, in a tile of two parts, of different parts) once."""
    names, of, counts = np.unique(c, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return
    largest = of == counts.argmax()
    rest = np.flatnonzero(~largest)
    rows = np.concatenate([rest, np.flatnonzero(largest)])
    for i, row in enumerate(rest.tolist()):
        other = rows[i + 1 :]
        other = other[(of[other] != of[row]) & ((part[other] != part[row]) | (not split))]
        if len(other):
            yield np.full(len(other), row), other


def _tiles(table: pa.Table, reach: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """(v, w, cut) of the rows of whole tiles (sign, i, j, part, v, n, c, bits): of each row up to `reach` partners that its bitmap does not rule out, the most alike first; cut where there were more."""
    table = table.combine_chunks()
    sign, i, j, part, v, n, c = (table.column(x).to_numpy() for x in ("sign", "i", "j", "part", "v", "n", "c"))
    bits = Bitmaps(table.column("bits"))
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(sign) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)])) if len(sign) else np.zeros(0, np.int64)
    ends = np.append(begins[1:], len(sign))
    for low, high in zip(begins.tolist(), ends.tolist(), strict=True):
        own = np.arange(low, high)
        words = int(bits.words[low:high].min())
        maps = None
        found: list[tuple[np.ndarray, np.ndarray]] = []
        cut = False
        for left, right in _meetings(c[low:high], part[low:high], bool(i[low] != j[low])):
            maps = bits.folded(own, words) if maps is None else maps
            differ = np.bitwise_count(maps[left] ^ maps[right]).sum(axis=1, dtype=np.int64)
            a, b = n[low + left], n[low + right]
            good = np.flatnonzero((den + num) * np.maximum(differ, np.abs(a - b)) <= (den - num) * (a + b))
            if len(good) > reach:
                good, cut = good[np.argsort(differ[good], kind="stable")[:reach]], True
            if len(good):
                found.append((low + left[good], low + right[good]))
        if found:
            a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(v[a], v[b])), pa.array(np.minimum(v[a], v[b])), pa.array(np.full(len(a), cut))], ["v", "w", "cut"])


def _across(shared: DataFrame, sets: DataFrame, found: DataFrame, scratch: Scratch, num: int = NUM, den: int = DEN) -> DataFrame:
    """Components after the links that the comparisons with the hubs have missed.

    Only signatures whose members lie in several components count.  Their members meet in tiles of up to two parts of
    TILE rows (and TILE_SHINGLES shingles), as parity bitmaps; pairs that the bitmaps do not rule out are verified on the
    whole sets.  A row names at most `reach` partners in a tile; while some had more, the members that are still in
    different components meet again with a larger reach, so no link is lost.
    """
    reach = REACH
    while True:
        labelled = shared.select("sign", "v", "n").join(found.withColumnRenamed("component", "c"), "v", "left").withColumn("c", F.coalesce("c", "v"))
        groups = labelled.groupBy("sign").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")).where("low != high")
        parts = F.ceil(F.greatest(F.col("rows") / TILE, F.col("shingles") / TILE_SHINGLES)).cast("int")
        dealt = labelled.join(groups.select("sign", parts.alias("parts")), "sign").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
        tiled = dealt.select("sign", "v", "c", "part", other).select("sign", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "v", "c")
        filled = tiled.join(sets.select("v", "n", "bits"), "v").select("sign", "i", "j", "part", "v", "n", "c", "bits")

        def run(batches: Iterator[pa.RecordBatch], reach: int = reach) -> Iterator[pa.RecordBatch]:
            open_rows: pa.Table | None = None
            for batch in batches:
                rows = pa.Table.from_batches([batch])
                rows = pa.concat_tables([open_rows, rows]) if open_rows is not None else rows
                if not rows.num_rows:
                    continue
                last = np.ones(rows.num_rows, bool)
                for name in ("sign", "i", "j"):
                    column = rows.column(name).to_numpy()
                    last &= column == column[-1]
                whole = rows.num_rows - int(last[::-1].cumprod().sum())
                yield from _tiles(rows.slice(0, whole), reach, num, den)
                open_rows = rows.slice(whole)
            if open_rows is not None:
                yield from _tiles(open_rows, reach, num, den)

        pairs = scratch.keep(filled.repartition("sign", "i", "j").sortWithinPartitions("sign", "i", "j").mapInArrow(run, "v long, w long, cut boolean").groupBy("v", "w").agg(F.max("cut").alias("cut")))
        scratch.tidy()
        if pairs.limit(1).count() == 0:
            return found
        links = scratch.keep(_similar(pairs.select("v", "w"), sets, num, den))
        if links.limit(1).count():
            found = components(found.select("v", F.col("component").alias("w")).unionByName(links), scratch)
        if pairs.where("cut").limit(1).count() == 0:
            return found
        reach *= 16


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, num: int = NUM, den: int = DEN, band: float = BAND, weak: int = WEAK, passes: int = 1) -> DataFrame:
    """key long, n_shingles long, component_id long (smallest key reachable by links, its own included); one row a row of `docs`.

    A null or empty text, or one without words, has an empty set and links with nothing.  Rows of one key count as one
    document; a row with a null key keeps a null component.  Other columns are ignored; an empty table gives an empty
    result.  With `passes` the signatures are dealt out by their value, and each pass makes and shuffles its share only.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "partenum")
    sizes = scratch.keep(_sets(docs, key, text, width, "_vx_doc long, n long, a long, b long", _sizes))
    known = sizes.where("_vx_doc is not null and n > 0")
    repeated = scratch.keep(known.groupBy("a", "b").agg(F.min("_vx_doc").alias("v"), F.count(F.lit(1)).alias("rows")).where("rows > 1"))
    # of equal sets only the smallest document is signed
    copies = scratch.keep(known.join(small(repeated, repeated.count()), ["a", "b"]).where("_vx_doc != v").select("_vx_doc", "a", "b").distinct())
    n_copies = copies.count()
    twice = known.groupBy("_vx_doc", "a", "b").count().where("count > 1").limit(1).count() > 0
    by_sign = Window.partitionBy("sign").orderBy("v")
    parts = []
    for share in range(passes):
        make = functools.partial(_signed, share=share, passes=passes, num=num, den=den, band=band, weak=weak)
        signed = _sets(docs, key, text, width, "_vx_doc long, n long, a long, b long, signs array<bigint>", make).where("_vx_doc is not null and n > 0").join(small(copies, n_copies), ["_vx_doc", "a", "b"], "left_anti")
        vertices = signed.dropDuplicates(["_vx_doc", "a", "b"]) if twice else signed
        ranked = vertices.select(F.col("_vx_doc").alias("v"), "n", F.explode("signs").alias("sign")).select(
            "sign", "v", "n", F.row_number().over(by_sign).alias("rank"), F.first(F.struct("v", "n")).over(by_sign.rowsBetween(Window.unboundedPreceding, 0)).alias("hub"), F.lead("v").over(by_sign).alias("next")
        )
        parts.append(scratch.keep(ranked.where("rank > 1 or next is not null").select("sign", "v", "n", "rank", F.col("hub.v").alias("w"), F.col("hub.n").alias("m"))))
        scratch.tidy()
    shared = functools.reduce(DataFrame.unionByName, parts)
    close = (num * F.greatest("n", "m") <= den * F.least("n", "m")) & (F.col("v") != F.col("w"))
    pairs = scratch.keep(shared.where("rank > 1").where(close).select("v", "w").distinct())
    wanted = scratch.keep(shared.select("v").distinct())
    n_wanted = wanted.count()
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), text)
    chosen = rows.join(small(wanted.withColumnRenamed("v", key), n_wanted), key, "left_semi")
    sets = _sets(chosen, key, text, width, "v long, a long, n long, bits binary, shingles array<bigint>", _whole)
    if sizes.where("_vx_doc is not null").groupBy("_vx_doc").count().where("count > 1").limit(1).count():
        sets = sets.dropDuplicates(["v", "a"])
    sets = scratch.keep(sets)
    scratch.drop(wanted)
    scratch.tidy()
    links = _similar(scratch.keep(_may_link(pairs, sets, num, den)), sets, num, den)
    found = components(links, scratch)
    found = _across(shared, sets, found, scratch, num, den)
    keys = sizes.where("_vx_doc is not null and n > 0").groupBy("a", "b").agg(F.min("_vx_doc").alias("v"))
    labelled = keys.join(found, "v", "left").select("a", "b", F.coalesce("component", "v").alias("c"))
    result = sizes.join(labelled, ["a", "b"], "left").select(F.col("_vx_doc").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("_vx_doc").isNotNull(), F.coalesce("c", "_vx_doc")).alias("component_id"))
    return scratch.last(result)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
                                    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingles FROM w),
f AS (SELECT doc_id, len(shingles)::BIGINT AS n, list_sort(shingles) AS shingles FROM s),
g AS (SELECT shingles, n, min(doc_id) AS v FROM f WHERE n > 0 GROUP BY shingles, n),
e AS (SELECT v, n, unnest(shingles) AS shingle FROM g),
o AS (SELECT shingle FROM e GROUP BY shingle HAVING count(*) > 1),
x AS (SELECT a.v AS v, b.v AS w, a.n AS n, b.n AS m, count(*) AS shared FROM e a JOIN e b ON a.shingle = b.shingle AND a.v < b.v AND 90 * greatest(a.n, b.n) <= 100 * least(a.n, b.n)
      WHERE a.shingle IN (SELECT shingle FROM o) GROUP BY a.v, b.v, a.n, b.n),
l AS (SELECT v, w FROM x WHERE 100 * shared >= 90 * (n + m - shared)),
u AS (SELECT v, w FROM l UNION SELECT w, v FROM l),
r AS (SELECT v AS root, v FROM g UNION SELECT r.root, u.w FROM r JOIN u ON r.v = u.v),
c AS (SELECT v, min(root) AS component FROM r GROUP BY v)
SELECT f.doc_id, f.n AS n_shingles, coalesce(c.component, f.doc_id) AS component_id
FROM f LEFT JOIN g ON f.shingles = g.shingles AND f.n > 0 LEFT JOIN c ON g.v = c.v
"""
