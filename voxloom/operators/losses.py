"""Training losses and the metric table, from long rows with reference r and estimate e: sums by key, no pass over a track in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators import signal as G

# Fixed values.
RATIO_EPS, SCALE_EPS, NEGATIVE_EPS = 1e-3, 1e-8, 1e-8


def p_norm_ratio(rows: DataFrame, keys: list[str], r: str, e: str, p: int = 1, scale_invariant: bool = False, log: bool = True, eps: float = RATIO_EPS) -> DataFrame:
    """(keys, loss): mean p-norm error over mean p-norm of the reference, in dB unless `log` is off; the reference is first scaled to the estimate if asked for."""
    if p not in (1, 2):
        raise ValueError(p)
    size = F.abs if p == 1 else (lambda c: c * c)
    target = F.col(r)
    if scale_invariant:
        scale = rows.groupBy(*keys).agg(((F.sum(F.col(e) * F.col(r)) + SCALE_EPS) / (F.sum(F.col(r) * F.col(r)) + SCALE_EPS)).alias("_k"))
        rows, target = rows.join(scale, keys), F.col(r) * F.col("_k")
    error, level = F.avg(size(F.col(e) - target)) + eps, F.avg(size(target)) + eps
    return rows.groupBy(*keys).agg((10 * (F.log10(error) - F.log10(level)) if log else error / level).alias("loss"))


def negative_sdr(rows: DataFrame, keys: list[str], r: str, e: str, kind: str = "sisdr", zero_mean: bool = True, log: bool = True, eps: float = NEGATIVE_EPS) -> DataFrame:
    """(keys, loss): minus the signal-to-noise ratio of kind snr, sisdr or sdsdr, from six sums."""
    if kind not in ("snr", "sisdr", "sdsdr"):
        raise ValueError(kind)
    a, b = F.col(r), F.col(e)
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(a).alias("a"), F.sum(b).alias("b"), F.sum(a * a).alias("aa"), F.sum(b * b).alias("bb"), F.sum(a * b).alias("ab"))
    centred = lambda x, y, z: F.col(x) - F.col(y) * F.col(z) / F.col("n") if zero_mean else F.col(x)
    aa, bb, ab = centred("aa", "a", "a"), centred("bb", "b", "b"), centred("ab", "a", "b")
    k = F.lit(1.0) if kind == "snr" else ab / (aa + eps)
    against = k if kind == "sisdr" else F.lit(1.0)
    ratio = k * k * aa / (bb - 2 * against * ab + against * against * aa + eps)
    return sums.select(*keys, (-(10 * F.log10(ratio + eps) if log else ratio)).alias("loss"))


def time_frequency_loss(time: DataFrame, frequency: DataFrame, keys: list[str], time_weight: float = 1.0, frequency_weight: float = 1.0) -> DataFrame:
    """(keys, loss): weighted sum of two losses (keys, stem, loss), each summed over the stems."""
    both = time.withColumn("loss", F.col("loss") * time_weight).unionByName(frequency.withColumn("loss", F.col("loss") * frequency_weight))
    return both.groupBy(*keys).agg(F.sum("loss").alias("loss"))


#: Metrics that the dispatcher knows by name: aggregates of (reference, estimate) columns.
METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "sdr": G.sdr,
    "l1": lambda r, e: F.avg(F.abs(r - e)),
    "l2": lambda r, e: F.avg((r - e) * (r - e)),
    "correlation": F.corr,
}


def metric_values(rows: DataFrame, keys: list[str], r: str, e: str, names: list[str]) -> DataFrame:
    """(keys, metric, value) of the metrics asked for, all in one aggregation; an unknown name is an error."""
    if unknown := sorted(set(names) - set(METRICS)):
        raise ValueError(f"unknown metrics: {', '.join(unknown)}")
    wide = rows.groupBy(*keys).agg(*[METRICS[n](F.col(r), F.col(e)).alias(f"_m_{n}") for n in names])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"_m_{n}").alias("value")) for n in names])).alias("m")
    return wide.select(*keys, each).select(*keys, "m.metric", "m.value")


def safe_mean(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value): mean of what is finite, NaN where nothing is."""
    good = F.when(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(F.col(value)) != float("inf")), F.col(value))
    return values.groupBy(*keys).agg(F.coalesce(F.avg(good), F.lit(float("nan"))).alias(value))
