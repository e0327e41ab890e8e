"""Whole waveforms as one array column: sample rates, phase shifts, alignment, pitch from salience.

Each function maps rows to rows in Arrow batches; no row needs another one, so nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The resampler's width and roll-off, the salience bins (20 cents each) and the reach of their transitions.
SINC_WIDTH, ROLLOFF = 6, 0.99
BIN_CENTS, FIRST_CENTS, BASE_HZ = 20, 1997.3794084376191, 10.0
NEAR_BINS, LEAST_SALIENCE, TRANSITION_BINS = 4, 0.03, 30
EMPTY, EMPTY_AFTER_TRIM = "empty_signal", "empty_after_trim"


def resample(x: np.ndarray, old: int, new: int) -> np.ndarray:
    """x at another rate: a bank of Hann-windowed sinc filters, one for each phase of the new rate; ceil(n * new / old) samples."""
    if old == new or not len(x):
        return np.asarray(x, float)
    common = math.gcd(old, new)
    step, phases = old // common, new // common
    cutoff = min(step, phases) * ROLLOFF
    half = math.ceil(SINC_WIDTH * step / cutoff)
    taps = np.arange(-half, half + step) / step
    t = np.clip((taps[None, :] - np.arange(phases)[:, None] / phases) * cutoff, -SINC_WIDTH, SINC_WIDTH)
    bank = np.sinc(t) * np.cos(t * np.pi / SINC_WIDTH / 2) ** 2 * cutoff / step
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(np.asarray(x, float), (half, half + step)), len(taps))[::step]
    return (frames @ bank.T).ravel()[: -(-len(x) * phases // step)]


def embedding_input(rows: DataFrame, rate: str, array: str = "samples", new_rate: int = 16_000, most: int = 160_000) -> DataFrame:
    """`array` at new_rate and cut to its first `most` samples, and `reason`: empty_signal for a null or empty array, empty_after_trim where the cut leaves nothing, else null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            new = [None if x is None else resample(x, int(r), new_rate)[:most] if len(x) else x for x, r in zip(pdf[array], pdf[rate], strict=True)]
            reason = [EMPTY if x is None or not len(x) else None if len(y) else EMPTY_AFTER_TRIM for x, y in zip(pdf[array], new, strict=True)]
            yield pdf.assign(**{array: new, "reason": reason})

    rows = rows.drop("reason").withColumn(array, F.col(array).cast("array<double>"))
    return rows.mapInPandas(run, rows.withColumn("reason", F.lit(None).cast("string")).schema)


def shifted_phase(x: np.ndarray, degrees: float) -> np.ndarray:
    """x with the phase of all its frequencies moved, by its analytic signal."""
    n = len(x)
    gain = np.zeros(n)
    gain[0] = 1
    gain[1 : (n + 1) // 2] = 2
    if n % 2 == 0:
        gain[n // 2] = 1
    analytic = np.fft.ifft(np.fft.fft(x) * gain)
    angle = np.radians(degrees)
    return np.cos(angle) * analytic.real - np.sin(angle) * analytic.imag


def phase_degrees(step: int) -> list[int]:
    """The shifts that are tried: none, the negated signal, then each multiple of step below 180 both ways."""
    return [0, 180, *(sign * d for d in range(step, 180, step) for sign in (1, -1))]


def phase_shifts(rows: DataFrame, step: int, array: str = "samples") -> DataFrame:
    """Each row once for every shift, with `degrees`; a null or empty array stays as it is."""
    rows = rows.drop("degrees").withColumn(array, F.col(array).cast("array<double>"))
    spread = rows.withColumn("degrees", F.explode(F.array(*map(F.lit, phase_degrees(step)))))

    def moved(x: np.ndarray | None, d: int) -> np.ndarray | None:
        if x is None or not len(x) or not d:
            return x
        return -x if d == 180 else shifted_phase(x, d)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{array: [moved(x, d) for x, d in zip(pdf[array], pdf["degrees"], strict=True)]})

    return spread.mapInPandas(run, spread.schema)


def best_lag(a: np.ndarray, b: np.ndarray) -> int:
    """Samples by which b must be delayed to agree best with a: the peak of their cross-correlation, the smallest lag of equal peaks; 0 if one is empty."""
    if not len(a) or not len(b):
        return 0
    size = 1 << (len(a) + len(b) - 1).bit_length()
    product = np.fft.irfft(np.fft.rfft(a, size) * np.conj(np.fft.rfft(b, size)), size)
    lags = np.concatenate([product[size - len(b) + 1 :], product[: len(a)]])
    return int(np.flatnonzero(lags >= lags.max() - 1e-9 * max(1.0, np.abs(lags).max()))[0]) - (len(b) - 1)


def quick_alignment(rows: DataFrame, reference: str, other: str, rate: int = 44_100) -> DataFrame:
    """`other` delayed by zeros or cut in front, and `lag`, so that it agrees best with `reference` in the second one of both; tracks that end before it, and nulls, keep lag 0."""
    rows = rows.drop("lag").withColumn(other, F.col(other).cast("array<double>"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lags = [0 if a is None or b is None else best_lag(np.asarray(a[rate : 2 * rate], float), b[rate : 2 * rate]) for a, b in zip(pdf[reference], pdf[other], strict=True)]
            moved = [b if not n else np.concatenate([np.zeros(n), b]) if n > 0 else b[-n:] for b, n in zip(pdf[other], lags, strict=True)]
            yield pdf.assign(**{other: moved, "lag": lags})

    return rows.mapInPandas(run, rows.withColumn("lag", F.lit(0)).schema)


def best_path(salience: np.ndarray) -> np.ndarray:
    """The likeliest bins of frames (frames x bins): shares of salience as probabilities, triangular transitions, any first bin alike (Viterbi)."""
    n = salience.shape[1]
    steps = np.maximum(TRANSITION_BINS - np.abs(np.arange(n)[:, None] - np.arange(n)), 0.0)
    tiny = np.finfo(float).tiny
    moves = np.log(steps / steps.sum(axis=1, keepdims=True) + tiny)
    total = salience.sum(axis=1, keepdims=True)
    seen = np.log(np.divide(salience, total, out=np.full(salience.shape, 1 / n), where=total > 0) + tiny)
    value = seen[0] - np.log(n)
    came = np.zeros(salience.shape, np.int64)
    for t in range(1, len(salience)):
        reached = value[:, None] + moves
        came[t] = reached.argmax(axis=0)
        value = reached[came[t], np.arange(n)] + seen[t]
    path = np.empty(len(salience), np.int64)
    path[-1] = value.argmax()
    for t in range(len(salience) - 1, 0, -1):
        path[t - 1] = came[t, path[t]]
    return path


def pitch_of(salience: np.ndarray, viterbi: bool = False, least: float = LEAST_SALIENCE) -> np.ndarray:
    """Hz of each frame: the mean cents of the bins near the largest bin, or near the best path, weighted by salience; 0 where no bin reaches `least`."""
    if not salience.size:
        return np.zeros(len(salience))
    centre = best_path(salience) if viterbi else salience.argmax(axis=1)
    bins = np.arange(salience.shape[1])
    weight = np.where(np.abs(bins - centre[:, None]) <= NEAR_BINS, salience, 0.0)
    total = weight.sum(axis=1)
    cents = weight @ (bins * BIN_CENTS + FIRST_CENTS) / np.where(total == 0, 1, total)
    return np.where(salience.max(axis=1) < least, 0.0, BASE_HZ * 2 ** (cents / 1200))


def salience_pitch(rows: DataFrame, salience: str = "salience", out: str = "f0", viterbi: bool = False, least: float = LEAST_SALIENCE) -> DataFrame:
    """Adds `out`, the pitch of every frame of a track's salience (array of arrays, one a frame); null stays null, a track without frames gets an empty array."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: [None if s is None else pitch_of(np.array([*s], float).reshape(len(s), -1), viterbi, least) if len(s) else [] for s in pdf[salience]]})

    rows = rows.drop(out)
    return rows.mapInPandas(run, rows.withColumn(out, F.lit(None).cast("array<double>")).schema)
