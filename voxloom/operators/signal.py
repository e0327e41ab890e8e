"""Arrays and signals: padding, overlap-add, ensembling, metrics, note decoding.

Row forms work on long tables (track, i, v) and are aggregations by key; array forms work on one array column and serve
production, where a track's chunk is one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
SDR_DELTA = 1e-7
SI_EPS = 1e-7
EXACT = "decimal(28,16)"


# padding and shapes


def pad_to(a: Column, n: Column | int, value: float = 0.0) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.concat(a, F.array_repeat(F.lit(value).cast("double"), F.greatest(n - F.size(a), F.lit(0))))


def crop_to(a: Column, n: Column | int) -> Column:
    return F.slice(a, 1, n)


def collate(rows: DataFrame, array: str, value: float = 0.0) -> DataFrame:
    """Pads all arrays to the longest one."""
    longest = rows.agg(F.coalesce(F.max(F.size(array)), F.lit(0))).first()[0]
    return rows.withColumn(array, pad_to(F.col(array), longest, value))


def padding(left: int, window: int, roi: Column) -> Column:
    """struct(left, right): zeros in front and behind so that regions of interest tile the length `roi`."""
    step = window - 2 * left
    return F.struct(F.lit(left).alias("left"), (step - F.pmod(roi, F.lit(step)) + left).cast("int").alias("right"))


def batch_by_size(rows: DataFrame, key: str, frames: str, max_frames: int = 80_000, max_rows: int = 48, parts: int = 1) -> DataFrame:
    """(key, part, batch): rows in order of length, each batch of at most max_rows rows and rows x longest <= max_frames.

    The fold keeps only a count and a length; it runs over each of `parts` length ranges by itself.  A row longer than
    max_frames is an error.
    """
    spread = rows.select(key, F.col(frames).cast("long").alias("_n")).repartitionByRange(parts, "_n", key).sortWithinPartitions("_n", key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, count, longest = 0, 0, 0
        for pdf in batches:
            out = []
            for n in pdf["_n"]:
                if n > max_frames:
                    raise ValueError(f"a row of {n} frames is over {max_frames}")
                if count and (count == max_rows or (count + 1) * max(longest, n) > max_frames):
                    number, count, longest = number + 1, 0, 0
                count, longest = count + 1, max(longest, n)
                out.append(number)
            yield pd.DataFrame({key: pdf[key], "batch": out})

    return spread.mapInPandas(run, rows.select(key).schema.add("batch", "integer")).withColumn("part", F.spark_partition_id()).select(key, "part", "batch")


# overlap-add


def fade_window(size: int, fade: int) -> np.ndarray:
    window = np.ones(size)
    window[:fade], window[size - fade :] = np.linspace(0, 1, fade), np.linspace(1, 0, fade)
    return window


def overlap_add(samples: DataFrame, size: int, step: int, weight: Column, model: Column | None = None) -> DataFrame:
    """(track, i, v): every sample as the weighted mean over the chunks that hold it; `weight` and `model` are expressions of place (0 .. size - 1) and v."""
    first = F.greatest(F.ceil((F.col("i") - size + 1) / step), F.lit(0))
    spread = samples.withColumn("chunk", F.explode(F.sequence(first, F.floor(F.col("i") / step)))).withColumn("place", F.col("i") - F.col("chunk") * step)
    out = F.col("v") if model is None else model
    return spread.groupBy("track", "i").agg((F.sum(weight * out) / F.sum(weight)).alias("v"))


def demix(tracks: DataFrame, model: Callable[[np.ndarray], np.ndarray], chunk: int, overlaps: int = 4, fade: int | None = None, array: str = "samples") -> DataFrame:
    """The array column through a model chunk by chunk, weighted and overlap-added; all-zero chunks skip the model, NaN becomes 0.  The chunks reflect at both ends where the signal is long enough."""
    step, edge = chunk // overlaps, chunk - chunk // overlaps
    window = fade_window(chunk, fade if fade is not None else chunk // 10)

    def one(x: np.ndarray) -> np.ndarray:
        n = len(x)
        padded = np.pad(x, edge, mode="reflect") if n > 2 * edge and edge > 0 else np.pad(x, edge)
        total, weight = np.zeros(len(padded) + chunk), np.zeros(len(padded) + chunk)
        for at in range(0, len(padded), step):
            part = padded[at : at + chunk]
            full = np.pad(part, (0, chunk - len(part)), mode="reflect" if len(part) > chunk // 2 + 1 else "constant")
            total[at : at + chunk] += window * (model(full) if full.any() else full)
            weight[at : at + chunk] += window
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.nan_to_num(total / weight)[edge : edge + n]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{array: [one(np.asarray(x, float)) for x in pdf[array]]})

    return tracks.mapInPandas(run, tracks.schema)


def test_time_average(rows: DataFrame, key: str, left: str, right: str, model: Callable[[Column, Column], tuple[Column, Column]]) -> DataFrame:
    """Mean of the model's answers to the pair, the swapped pair and the negated pair, each undone."""
    a, b = F.col(left), F.col(right)
    straight, swapped, negated = model(a, b), model(b, a), model(-a, -b)
    return rows.select(key, ((straight[0] + swapped[1] - negated[0]) / 3).alias(left), ((straight[1] + swapped[0] - negated[1]) / 3).alias(right))


def residual(mix: Column, target: Column) -> Column:
    return F.zip_with(mix, target, lambda a, b: a - b)


# ensembling: long rows (key, src, v[, w])


def ensemble(rows: DataFrame, key: list[str], how: str, src: str = "src", value: str = "v", weight: Column | None = None) -> DataFrame:
    """avg, median, min or max (by absolute value, sign kept, the first source at a tie)."""
    v = F.col(value)
    if how == "avg":
        w = F.lit(1.0) if weight is None else weight
        out = F.sum(v * w) / F.sum(w)
    elif how == "median":
        out = F.median(v)
    elif how == "min":
        out = F.min_by(v, F.struct(F.abs(v), F.col(src)))
    elif how == "max":
        out = F.max_by(v, F.struct(F.abs(v), -F.col(src)))
    else:
        raise ValueError(how)
    return rows.groupBy(*key).agg(out.alias(value))


def spectral_fold(rows: DataFrame, key: list[str], how: str, src: str = "src", value: str = "v") -> DataFrame:
    """min or max magnitude, the last source at a tie."""
    order = F.struct(F.abs(value), -F.col(src)) if how == "min" else F.struct(F.abs(value), F.col(src))
    return rows.groupBy(*key).agg((F.min_by if how == "min" else F.max_by)(F.col(value), order).alias(value))


def quietest_parts(rows: DataFrame, parts: int) -> DataFrame:
    """(track, part, src): of each of `parts` equal parts of a track the source of least mean magnitude.  Parts follow from i and the length (the first n mod parts are one longer), without a window."""
    n = rows.groupBy("track").agg((F.max("i") + 1).alias("_n"))
    size, more = F.floor(F.col("_n") / parts), F.pmod(F.col("_n"), F.lit(parts))
    edge = more * (size + 1)
    part = F.when(F.col("i") < edge, F.floor(F.col("i") / (size + 1))).otherwise(more + F.floor((F.col("i") - edge) / F.greatest(size, F.lit(1))))
    means = rows.join(n, "track").groupBy("track", part.cast("int").alias("part"), "src").agg(F.avg(F.abs("v")).alias("_m"))
    return means.groupBy("track", "part").agg(F.min_by("src", F.struct("_m", "src")).alias("src"))


def padded_average(rows: DataFrame, key: list[str], sources: int, value: str = "v") -> DataFrame:
    """Mean over all sources, those that have ended counting as zero."""
    return rows.groupBy(*key).agg((F.sum(value) / sources).alias(value))


def zero_fill_sum(rows: DataFrame, key: list[str], value: str = "v") -> DataFrame:
    return rows.groupBy(*key).agg(F.sum(value).alias(value))


def stft_ensemble(rows: DataFrame, how: str, n_fft: int = 2048, hop: int = 1024, weights: dict | None = None) -> DataFrame:
    """(track, samples) from (track, src, samples) by min or max magnitude in the short-time spectrum, or its mean (weighted by `weights`, src -> weight, 1 where not given) or median; one track's sources are one group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("src")
        waves = [np.asarray(x, float) for x in pdf["samples"]]
        n = max(map(len, waves))
        spectra = np.array([stft(np.pad(x, (0, n - len(x))), n_fft, hop) for x in waves])
        if how in ("min", "max"):
            pick = (np.abs(spectra).argmin if how == "min" else np.abs(spectra).argmax)(axis=0)
            out = np.take_along_axis(spectra, pick[None], axis=0)[0]
        else:
            share = [(weights or {}).get(s, 1.0) for s in pdf["src"]]
            out = np.tensordot(share, spectra, 1) / sum(share) if how == "avg" else np.median(spectra.real, axis=0) + 1j * np.median(spectra.imag, axis=0)
        return pd.DataFrame({"track": [pdf["track"].iloc[0]], "samples": [istft(out, n, n_fft, hop)]})

    return rows.groupBy("track").applyInPandas(run, rows.select("track", "samples").schema)


def stft(x: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    """Frames x bins, Hann window, centred with zeros."""
    padded = np.pad(x, n_fft // 2)
    padded = np.pad(padded, (0, -(len(padded) - n_fft) % hop))
    frames = np.lib.stride_tricks.sliding_window_view(padded, n_fft)[::hop]
    return np.fft.rfft(frames * np.hanning(n_fft + 1)[:-1], axis=1)


def istft(spectrum: np.ndarray, n: int, n_fft: int, hop: int) -> np.ndarray:
    window = np.hanning(n_fft + 1)[:-1]
    total = np.zeros((len(spectrum) - 1) * hop + n_fft)
    weight = np.zeros_like(total)
    for i, frame in enumerate(np.fft.irfft(spectrum, n_fft, axis=1)):
        total[i * hop : i * hop + n_fft] += frame * window
        weight[i * hop : i * hop + n_fft] += window * window
    return (total / np.maximum(weight, 1e-8))[n_fft // 2 : n_fft // 2 + n]


# metrics: long rows with reference r and estimate e


def sdr(r: Column, e: Column, delta: float = SDR_DELTA) -> Column:
    return 10 * F.log10((F.sum(r * r) + delta) / (F.sum((r - e) * (r - e)) + delta))


def si_sdr(rows: DataFrame, keys: list[str], r: str, e: str, eps: float = SI_EPS) -> DataFrame:
    """Scale-invariant SDR from four sums: no second pass."""
    sums = rows.groupBy(*keys).agg(
        F.sum(F.col(e) * F.col(r)).alias("er"), F.sum(F.col(r) * F.col(r)).alias("rr"), F.sum(F.col(e) * F.col(e)).alias("ee"), F.count(F.lit(1)).alias("n")
    )
    k = (F.col("er") + F.col("n") * eps) / (F.col("rr") + F.col("n") * eps)
    noise = k * k * F.col("rr") - 2 * k * F.col("er") + F.col("ee")
    return sums.select(*keys, (10 * F.log10(k * k * F.col("rr") / (noise + eps) + eps)).alias("si_sdr"))


def channel_sdr(rows: DataFrame, keys: list[str], channel: str, r: str, e: str) -> DataFrame:
    """SDR of each channel to four places, then their mean."""
    return rows.groupBy(*keys, channel).agg(F.round(sdr(F.col(r), F.col(e)), 4).alias("_s")).groupBy(*keys).agg(F.avg("_s").alias("sdr"))


def chunk_median(rows: DataFrame, item: str, place: str, size: int, value: Column, least: int | None = None) -> DataFrame:
    """(item, median): the lower median over chunks of `size` rows of an aggregate; short chunks and results that are not finite are left out."""
    chunks = rows.groupBy(item, F.floor(F.col(place) / size).alias("_c")).agg(value.alias("_v"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= (least or size))
    finite = chunks.where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") != float("inf")))
    return finite.groupBy(item).agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY _v)").alias("median"))


def masked_loss(rows: DataFrame, item: str, r: str, e: str, q: float) -> DataFrame:
    """One row: mean over all items of the squared error of those below the quantile, the others counting as zero."""
    per_item = rows.groupBy(item).agg(F.avg((F.col(r) - F.col(e)) * (F.col(r) - F.col(e))).alias("mse"))
    limit = per_item.agg(F.percentile("mse", F.lit(q)).alias("limit"))
    return per_item.join(F.broadcast(limit)).agg((F.sum(F.when(F.col("mse") < F.col("limit"), F.col("mse")).otherwise(0.0)) / F.count(F.lit(1))).alias("loss"))


def metric_summary(rows: DataFrame, metric: str = "metric", instr: str = "instr", value: str = "value") -> DataFrame:
    """Mean and population deviation by metric and instrument, and the macro mean over instruments (instrument null)."""
    by = rows.groupBy(metric, instr).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    macro = by.groupBy(metric).agg(F.avg("mean").alias("mean"), F.avg("std").alias("std")).withColumn(instr, F.lit(None).cast(by.schema[instr].dataType))
    return by.unionByName(macro)


def best_so_far(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows that beat all before them."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_best", F.max(value).over(w)).where(f"_best is null or {value} > _best").drop("_best")


def l1_spectral_score(spectra: Column, other: Column) -> Column:
    """100 / (1 + 10 x mean absolute difference) of two magnitude arrays."""
    return 100 / (1 + 10 * F.aggregate(F.zip_with(spectra, other, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: s + x) / F.size(spectra))


def bleed_and_fullness(diff_db: Column) -> tuple[Column, Column]:
    """(bleedless, fullness) aggregates of mel level differences in dB."""
    return 100 / (1 + F.coalesce(F.avg(F.when(diff_db > 0, diff_db)), F.lit(0.0))), 100 / (1 + F.coalesce(-F.avg(F.when(diff_db < 0, diff_db)), F.lit(0.0)))


# notes and pitch


def note_bounds(rows: DataFrame, keys: list[str], order: str, bound: str) -> DataFrame:
    """Adds item: frames of one note share a number, a new one begins where the rounded running sum of bounds rises.

    The sum is one of decimals: a running sum of doubles drifts along a track until halves no longer round to even.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    stepped = rows.withColumn("_step", F.bround(F.round(F.sum(F.col(bound).cast(EXACT)).over(w), 9)).cast("long"))
    rises = (F.col("_step") - F.lag("_step", 1, -1).over(w) > 0).cast("long")
    return stepped.withColumn("_rise", rises).withColumn("item", F.sum("_rise").over(w)).drop("_step", "_rise")


def note_values(frames: DataFrame, keys: list[str], threshold: float = 0.5) -> DataFrame:
    """(keys, item, value, frames, unmasked) from frames (keys, item, v, mask): the commonest rounded pitch, the smallest at a tie, then the mean of the frames within half of it."""
    counts = frames.groupBy(*keys, "item").agg(F.count(F.lit(1)).alias("frames"), F.avg(F.col("mask").cast("int")).alias("_share"))
    votes = frames.where("mask").groupBy(*keys, "item", F.bround("v").cast("long").alias("_q")).agg(F.count(F.lit(1)).alias("_votes"))
    modes = votes.groupBy(*keys, "item").agg(F.max_by("_q", F.struct("_votes", -F.col("_q"))).alias("_mode"))
    near = frames.where("mask").join(modes, [*keys, "item"]).where(F.col("v").between(F.col("_mode") - 0.5, F.col("_mode") + 0.5)).groupBy(*keys, "item").agg(F.avg("v").alias("value"))
    return counts.join(near, [*keys, "item"], "left").select(*keys, "item", F.coalesce("value", F.lit(0.0)).alias("value"), "frames", (F.col("_share") >= threshold).alias("unmasked"))


def note_ticks(notes: DataFrame, keys: list[str], order: str, dur: str, offset: str, rest: str, tempo: float = 120.0) -> DataFrame:
    """Ticks of notes in chunks: (.., start, end, delta) with ends cut at the next chunk's offset; rests and empty notes go; delta counts from the last note's end."""
    per_chunk = Window.partitionBy(*keys).orderBy(order)
    ends = F.bround(F.round(F.sum(dur).over(per_chunk) * (tempo * 8), 6)).cast("long")
    timed = notes.withColumn("_begin", F.bround(F.col(offset) * tempo * 8).cast("long")).withColumn("_rel", ends).withColumn("_from", F.coalesce(F.lag("_rel").over(per_chunk), F.lit(0)))
    chunks = timed.select(*keys, "_begin").distinct().withColumn("_cut", F.lead("_begin").over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1])))
    cut = timed.drop("_begin").join(chunks, keys)
    limit = lambda c: F.least(c, F.coalesce("_cut", c))
    placed = cut.withColumn("start", limit(F.col("_begin") + F.col("_from"))).withColumn("end", limit(F.col("_begin") + F.col("_rel")))
    heard = placed.where((F.col("start") < F.col("end")) & ~F.col(rest))
    before = F.lag("end", 1, 0).over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1], order))
    return heard.withColumn("delta", F.col("start") - before).drop("_rel", "_from", "_begin", "_cut")


def interpolate_pitch(rows: DataFrame, keys: list[str], order: str, f0: str) -> DataFrame:
    """f0 with unvoiced (zero) stretches filled, linear in octaves between their voiced ends, constant beyond the first and last."""
    log = F.when(F.col(f0) > 0, F.log2(f0))
    w = Window.partitionBy(*keys).orderBy(order)
    # both frames grow from their first row on; one that shrinks to the last row would be computed anew for each row
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    future = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    voiced = F.when(F.col(f0) > 0, F.struct(F.col(order).alias("t"), log.alias("y")))
    ends = rows.withColumn("_a", F.last(voiced, ignorenulls=True).over(past)).withColumn("_b", F.last(voiced, ignorenulls=True).over(future))
    a, b = F.col("_a"), F.col("_b")
    share = (F.col(order) - a["t"]) / F.greatest(b["t"] - a["t"], F.lit(1))
    y = F.when(a.isNull(), b["y"]).when(b.isNull(), a["y"]).otherwise(a["y"] + (b["y"] - a["y"]) * share)
    return ends.withColumn(f0, F.coalesce(F.pow(F.lit(2.0), y), F.lit(0.0))).drop("_a", "_b")


def resample_curve(curve: Column, old: float, new: float, length: int) -> Column:
    """An array at another time step by linear interpolation, cut or continued by its last value."""
    steps = F.least(F.ceil((F.size(curve) - 1) * old / new).cast("int"), F.lit(length))
    at = lambda i: i * new / old
    low = lambda i: F.floor(at(i)).cast("int")
    point = lambda i: F.get(curve, low(i)) + (F.get(curve, F.least(low(i) + 1, F.size(curve) - 1)) - F.get(curve, low(i))) * (at(i) - low(i))
    inner = F.when(steps > 0, F.transform(F.sequence(F.lit(0), steps - 1), point)).otherwise(F.slice(curve, 1, 0))
    return F.concat(inner, F.array_repeat(F.element_at(inner, -1), F.lit(length) - steps))


def peak_expectation(probs: Column, low: float, high: float, deviation: float, threshold: float, bins: int) -> Column:
    """struct(value, rest): the probability-weighted value within three deviations of the largest bin; rest if that is under the threshold."""
    step = (high - low) / (bins - 1)
    width = int(3 * deviation / step)
    centre = F.array_position(probs, F.array_max(probs)).cast("int") - 1
    near = F.transform(probs, lambda p, i: F.when(F.abs(i - centre) <= width, p).otherwise(0.0))
    total = F.aggregate(near, F.lit(0.0), lambda s, x: s + x)
    moment = F.aggregate(F.transform(near, lambda p, i: p * (i * step + low)), F.lit(0.0), lambda s, x: s + x)
    return F.struct((moment / F.when(total == 0, 1.0).otherwise(total)).alias("value"), (F.array_max(probs) < threshold).alias("rest"))


def peak_normalize(a: Column, limit: float = 1.0) -> Column:
    peak = F.array_max(F.transform(a, lambda x: F.abs(x)))
    return F.when(peak > limit, F.transform(a, lambda x: limit * x / peak)).otherwise(a)


def mid_side(left: Column, right: Column) -> tuple[Column, Column]:
    return F.zip_with(left, right, lambda a, b: (a + b) / 2), F.zip_with(left, right, lambda a, b: a - b)


def band_checks(bands: DataFrame, order: str, low: str, high: str) -> DataFrame:
    """Bands with a fault: zero_width, overlap or gap against the one before (a list of at most a few hundred rows)."""
    before = F.lag(high).over(Window.orderBy(order))
    fault = F.when(F.col(high) <= F.col(low), "zero_width").when(F.col(low) < before, "overlap").when(F.col(low) > before, "gap")
    return bands.withColumn("fault", fault).where("fault is not null")
