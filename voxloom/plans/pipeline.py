"""Stages of the speech-corpus pipeline as one plan each, and their providers.

A provider is any callable that the stage's operator takes: an embedder and a separator map batches of frames, a
recogniser hears samples, a codec maps bytes.  Neural models themselves are outside of this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions import text as X
from voxloom.operators import manifest as M
from voxloom.operators import segments as S
from voxloom.operators import vectors as V
from voxloom.sources import subtitles

Embedder = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


@dataclass
class Providers:
    """Registered providers by kind and name."""

    known: dict[tuple[str, str], Callable] = field(default_factory=dict)

    def register(self, kind: str, name: str) -> Callable[[Callable], Callable]:
        def put(f: Callable) -> Callable:
            if (kind, name) in self.known:
                raise ValueError(f"{kind} {name} is there already")
            self.known[kind, name] = f
            return f

        return put

    def get(self, kind: str, name: str) -> Callable:
        if (kind, name) not in self.known:
            raise KeyError(f"no {kind} {name}")
        return self.known[kind, name]


PROVIDERS = Providers()


def subtitle_slices(files: DataFrame, audio: DataFrame, auto_filter: bool = True) -> DataFrame:
    """Manifest rows of subtitle files (name, text) that have audio (name): the best variant of each base, filtered, numbered over all."""
    chosen = M.subtitle_variants(files).select("name")
    rows = subtitles.parse(files.join(chosen, "name", "left_semi"))
    rows = rows.join(audio.select(X.stem(F.col("name")).alias("base")).distinct(), "base", "left_semi")
    rows = S.adaptive_filter(rows) if auto_filter else rows
    return subtitles.slice_manifest(S.duration_filter(rows))


def missing_audio(files: DataFrame, audio: DataFrame) -> DataFrame:
    """Bases with subtitles but no audio."""
    return M.subtitle_variants(files).select("base").join(audio.select(X.stem(F.col("name")).alias("base")), "base", "left_anti")


def sync_store(files: DataFrame, store: DataFrame, embed: Embedder) -> DataFrame:
    """The store (filename, embedding, status) after vectors of the missing files (filename, ...) are computed."""
    todo = files.join(store.select("filename"), "filename", "left_anti")
    return V.upsert_store(store, todo.mapInPandas(embed, "filename string, embedding array<float>"))


def cluster_manifest(store: DataFrame, metadata: DataFrame, gate: float = V.NOISE_GATE, min_files: int = M.MIN_FILES) -> DataFrame:
    """Cluster manifest of a store: clustering, pruning of small clusters, export."""
    labels = V.recluster(store, "filename", "embedding", gate=gate)
    named = labels.select("filename", V.cluster_name(F.col("label")).alias("cluster_dir"), F.lit(0.0).alias("mtime"))
    return M.export_manifest(M.prune_small(named, min_files), metadata)


Step = Callable[[DataFrame], tuple[DataFrame, dict[str, DataFrame]]]


def chain(start: DataFrame, steps: list[Step]) -> tuple[DataFrame, list[dict[str, DataFrame]]]:
    """A preset flow: each step gives the next one's input and named side outputs."""
    now, side = start, []
    for step in steps:
        now, more = step(now)
        side.append(more)
    return now, side
