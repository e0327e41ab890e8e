"""Scalar column functions of signal work."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SILENCE_FLOOR = 1e-10
F0_BINS = 256
F0_LOW, F0_HIGH = 50.0, 1100.0


def to_db(c: Column) -> Column:
    return 20 * F.log10(F.abs(c) + F.lit(SILENCE_FLOOR))


def from_db(c: Column) -> Column:
    return F.pow(F.lit(10.0), c / 20)


def clamp(c: Column, low: float = -1.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def mel(c: Column) -> Column:
    return 1127 * F.log(1 + c / 700)


def coarse_pitch(f0: Column) -> Column:
    """Pitch bin 1..255 on the mel scale, halves to even."""
    low, high = (1127 * math.log(1 + f / 700) for f in (F0_LOW, F0_HIGH))
    scaled = F.when(mel(f0) > 0, (mel(f0) - low) * (F0_BINS - 2) / (high - low) + 1).otherwise(mel(f0))
    return F.bround(clamp(scaled, 1.0, F0_BINS - 1.0)).cast("int")


def frequency_bin(hz: Column, rate: int, n_fft: int) -> Column:
    return F.bround(hz * n_fft / rate).cast("int")


def bin_frequency(number: Column, rate: int, n_fft: int) -> Column:
    return number * (rate / n_fft)


def batch_size(base: Column, current: Column, most: Column, cpu: Column, ram: Column, gpu: Column, vram: Column) -> Column:
    """The number of parallel items that measured pressure allows: down at once, up one step a probe.  Null gpu or vram are not looked at."""
    one = F.lit(1)
    base, current, most = F.greatest(one, base), F.greatest(one, current), F.greatest(one, most)

    def beyond(cpu_at: float, ram_below: float, gpu_at: float, vram_below: int) -> Column:
        return (cpu >= cpu_at) | (ram < ram_below) | F.coalesce(gpu >= gpu_at, F.lit(False)) | F.coalesce(vram < vram_below, F.lit(False))

    def within(cpu_at: float, ram_from: float, gpu_at: float, vram_from: int) -> Column:
        return (cpu <= cpu_at) & (ram >= ram_from) & F.coalesce(gpu <= gpu_at, F.lit(True)) & F.coalesce(vram >= vram_from, F.lit(True))

    # Hard and soft limits, then very relaxed and relaxed ones (cpu %, RAM GB, GPU %, VRAM MB).
    target = (
        F.when(beyond(90.0, 6.0, 95.0, 3072), one)
        .when(beyond(80.0, 10.0, 90.0, 6144), F.greatest(one, F.least(base, current)))
        .when(within(60.0, 24.0, 70.0, 12288), F.least(most, F.greatest(base, F.lit(4))))
        .when(within(75.0, 12.0, 85.0, 8192), F.least(most, F.greatest(base, F.lit(2))))
        .otherwise(current)
    )
    return F.greatest(one, F.least(most, target, current + 1)).cast("int")
