"""Bins, masks and blends of spectra and sources in long form, by expressions and joins on bin numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.manifest import first_by

# File name marks of the roles.
ROLE_MARKS = (("reference", "%\\_(Vocals).wav"), ("target", "%\\_RVC\\_%"), ("reverb", "%reverbed\\_stem.wav"), ("inst", "%\\_(Instrumental).wav"))
PHASE_SAMPLES = 1000
REST_CLASS = 128


def low_pass_gain(bin_: Column, start: int, stop: int) -> Column:
    """1 below start, falling in equal steps to 0 at stop."""
    return F.when(bin_ < start, 1.0).when(bin_ < stop, 1.0 - (bin_ - start + 1) / float(stop - start)).otherwise(0.0)


def high_pass_gain(bin_: Column, start: int, stop: int) -> Column:
    """0 up to stop, rising in equal steps to 1 above start."""
    return F.when(bin_ <= stop, 0.0).when(bin_ <= start, 1.0 - (start - bin_ + 1) / float(start - stop)).otherwise(1.0)


def aggressive_mask(mask: Column, bin_: Column, split: int, value: float, non_accompaniment: bool = False, correction: float = 0.0) -> Column:
    """A mask raised to a power: a third of the aggressiveness below the split bin, all of it from there on."""
    if value == 0:
        return mask
    power = (1 - 2 * value if non_accompaniment else 2 * value) + correction
    return F.pow(mask, F.when(bin_ < split, 1 + power / 3).otherwise(1 + power))


def blend(a: Column, b: Column, share: float) -> Column:
    """share of a and the rest of b; a sample that one side lacks counts as zero."""
    return F.coalesce(a, F.lit(0.0)) * share + F.coalesce(b, F.lit(0.0)) * (1 - share)


def reduced_mix(instruments: Column, vocals: Column, rate: float = 0.9) -> Column:
    return F.coalesce(instruments, F.lit(0.0)) * (1 - rate) + F.coalesce(vocals, F.lit(0.0))


def input_roles(files: DataFrame, name: str = "name", order: str = "pos") -> DataFrame:
    """(role, name): of each role the last file in order whose name bears its mark."""
    role = F.lit(None).cast("string")
    for known, mark in reversed(ROLE_MARKS):
        role = F.when(F.col(name).like(mark), known).otherwise(role)
    return first_by(files.withColumn("role", role).where("role is not null"), ["role"], F.desc(order)).select("role", name)


def phase_inverted(rows: DataFrame, keys: list[str], place: str, a: str, b: str, samples: int = PHASE_SAMPLES) -> DataFrame:
    """(keys, inverted): whether the first samples of two tracks correlate negatively."""
    return rows.where(F.col(place) < samples).groupBy(*keys).agg((F.corr(a, b) < 0).alias("inverted"))


def pooled(rows: DataFrame, keys: list[str], value: str, how: str = "mean") -> DataFrame:
    """(keys, value) over time: mean, mean+max, std (unbiased, 1e-7 under the root) or both mean and std."""
    mean, std = F.avg(value), F.sqrt(F.var_samp(value) + 1e-7)
    columns = {"mean": [mean.alias("value")], "mean+max": [(F.max(value) + mean).alias("value")], "std": [std.alias("value")], "mean,std": [mean.alias("mean"), std.alias("std")]}
    return rows.groupBy(*keys).agg(*columns[how])


def in_bands(rows: DataFrame, bands: DataFrame, bin_: str = "bin") -> DataFrame:
    """Rows with the band (band, low, high: bins low to high - 1) of their bin, once for each; bands may overlap.  Bands are laid out by bin first, so the join is one on equal bins."""
    laid = bands.where("high > low").select("band", F.explode(F.sequence("low", F.col("high") - 1)).alias(bin_))
    return rows.join(laid, bin_)


def quantised_frame(classes: Column, mask: Column) -> Column:
    """struct(v, mask): the likeliest class of a frame as a note number, and whether it is heard (class 128 is a rest)."""
    best = F.array_position(classes, F.array_max(classes)) - 1
    return F.struct(F.least(best, F.lit(REST_CLASS - 1)).cast("double").alias("v"), ((best != REST_CLASS) & mask).alias("mask"))
