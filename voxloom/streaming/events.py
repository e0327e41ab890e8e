"""Structured Streaming forms of batch operators: an extension, the batch forms define the results."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def loud_sessions(events: DataFrame, gap: str = "1 second", late: str = "10 minutes") -> DataFrame:
    """(track, start, end, n) of loud events (track, ts, loud) no more than `gap` apart, emitted when the watermark has passed."""
    loud = events.where("loud").withWatermark("ts", late)
    grouped = loud.groupBy(F.session_window("ts", gap), "track").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("end"))
    return grouped.select("track", F.col("session_window.start").alias("start"), "end", "n")


def windowed_energy(events: DataFrame, size: str = "6 seconds", hop: str = "3 seconds", late: str = "10 minutes") -> DataFrame:
    """(track, start, energy, n) by sliding windows of events (track, ts, v)."""
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", size, hop), "track").agg(F.sum(F.col("v") * F.col("v")).alias("energy"), F.count(F.lit(1)).alias("n"))
    return grouped.select("track", F.col("window.start").alias("start"), "energy", "n")


def latest_assignments(changes: DataFrame) -> DataFrame:
    """Stream of (filename, cluster_dir, mtime) that replace what was known of a file: newest mtime, then larger name; state is one row a file."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = state.get if state.exists else None
        best = known
        for batch in batches:
            for mtime, cluster in zip(batch["mtime"], batch["cluster_dir"], strict=True):
                if best is None or (mtime, cluster) > best:
                    best = (float(mtime), str(cluster))
        if best is not None and best != known:
            state.update(best)
            yield pd.DataFrame({"filename": [key[0]], "cluster_dir": [best[1]], "mtime": [best[0]]})

    return changes.groupBy("filename").applyInPandasWithState(
        update, "filename string, cluster_dir string, mtime double", "mtime double, cluster_dir string", "update", GroupStateTimeout.NoTimeout
    )
