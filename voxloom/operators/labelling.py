"""The labelling session: which cluster comes next, recommendations with their early exits, confirmation of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import text as X
from voxloom.operators import manifest as M
from voxloom.operators import vectors as V

# What the reference tells the user.
NO_SAMPLE, NO_TRANSCRIPT, NO_AUDIO = "샘플 없음", "(전사 없음)", "\n오디오: 없음"
NO_TARGET = "대상 클러스터 임베딩이 없어 자동 추천을 생성할 수 없습니다."
NO_LABEL = "라벨 후보 클러스터가 없어 자동 추천을 생성할 수 없습니다."
NO_VALID_LABEL = "유효 임베딩 라벨 후보가 없어 자동 추천을 생성할 수 없습니다."


def pick(ordered: DataFrame, skipped: DataFrame, excluded: DataFrame, current: str = "", prefer_current: bool = False) -> DataFrame:
    """One row (cluster_dir, remaining): the current cluster if it is wanted and open, else the first open one in order; none is the empty string and 0."""
    named = lambda df: df.select(X.blank(F.col("cluster_dir")).alias("cluster_dir"))
    closed = named(skipped).unionByName(named(excluded)).distinct()
    left = ordered.where("n > 0").join(closed, "cluster_dir", "left_anti")
    rank = F.struct((F.col("cluster_dir") != F.lit(current if prefer_current else "")).alias("other"), "place")
    return left.agg(F.coalesce(F.min_by("cluster_dir", rank), F.lit("")).alias("cluster_dir"), F.count(F.lit(1)).alias("remaining"))


def recommend_all(targets: DataFrame, clusters: DataFrame, choices: DataFrame, **limits) -> DataFrame:
    """(target, label, score, gap, warning, reason) of every target (cluster_dir): a target without vectors, and a session without labels or without labels with vectors, get a row that says so.

    `clusters` is the centroid table (cluster_dir, n, mean_vec, centroid), `choices` the labels (label).
    """
    wanted = targets.select("cluster_dir").distinct()
    labels = clusters.join(choices.select(F.col("label").alias("cluster_dir")).distinct(), "cluster_dir", "left_semi").where("centroid is not null")
    found = V.recommend(clusters.join(wanted, "cluster_dir", "left_semi").where("centroid is not null"), labels, **limits)
    state = choices.agg(F.count(F.lit(1)).alias("_labels"))
    known = clusters.where("centroid is not null").select("cluster_dir", F.lit(True).alias("_known"))
    joined = wanted.join(known, "cluster_dir", "left").join(found.withColumnRenamed("target", "cluster_dir"), "cluster_dir", "left").join(F.broadcast(state))  # one row
    reason = F.when(F.col("_known").isNull(), NO_TARGET).when(F.col("_labels") == 0, NO_LABEL).when(F.col("label").isNull(), NO_VALID_LABEL).otherwise(F.col("reason"))
    return joined.select(F.col("cluster_dir").alias("target"), F.coalesce("label", F.lit("")).alias("label"), "score", "gap", F.coalesce("warning", F.lit(True)).alias("warning"), reason.alias("reason"))


def skip(skipped: DataFrame, current: DataFrame) -> DataFrame:
    """The skipped clusters and the current one."""
    return skipped.select("cluster_dir").unionByName(current.select("cluster_dir")).select(X.blank(F.col("cluster_dir")).alias("cluster_dir")).where("cluster_dir != ''").distinct()


def skipped_after(skipped: DataFrame, applied: DataFrame) -> DataFrame:
    """The skipped clusters without those whose decision was applied."""
    return skip(skipped, skipped.limit(0)).join(applied.select(F.col("source_cluster").alias("cluster_dir")), "cluster_dir", "left_anti")


def accept(pending: DataFrame, current: DataFrame) -> DataFrame:
    """Pending decisions (seq, source_cluster, target_label) with the current ones upserted, a manual label before a recommended one where both are given."""
    chosen = current.select("seq", "source_cluster", F.coalesce(F.nullif(X.blank(F.col("manual_label")), F.lit("")), X.blank(F.col("recommended_label"))).alias("target_label"))
    return M.upsert_pending(M.normalize_pending(pending), M.normalize_pending(chosen)).drop("late")


def invalid(pending: DataFrame) -> DataFrame:
    """(source_cluster, target_label, reason) of decisions whose label may not be given."""
    checked = pending.withColumn("_c", X.label_check(F.col("target_label")))
    return checked.where("not _c.ok").select("source_cluster", "target_label", F.col("_c.reason").alias("reason"))


def confirm(assignments: DataFrame, pending: DataFrame, order: str = "seq") -> DataFrame:
    """Assignments after all decisions: files of each source move to its label, and a moved file replaces one of its name there, a later decision's an earlier one's.

    All labels are checked first, so a bad one changes nothing (the reference applies those before it); it raises.
    """
    decisions = M.normalize_pending(pending, order)
    if bad := invalid(decisions).limit(1).collect():
        raise ValueError(f"{bad[0][0]} -> {bad[0][1]}: {bad[0][2]}")
    to = decisions.select(F.col("source_cluster").alias("cluster_dir"), X.blank(F.col("target_label")).alias("_to"), F.col(order).alias("_order"))
    moved = assignments.join(to, "cluster_dir", "left").withColumn("cluster_dir", F.coalesce("_to", "cluster_dir"))
    return M.first_by(moved, ["filename", "cluster_dir"], F.desc_nulls_last("_order"), F.desc("mtime")).select(*assignments.columns)


def sample_card(cluster: Column, filename: Column, start: Column, end: Column, duration: Column, transcript: Column, has_audio: Column) -> Column:
    """A sample as text; no file name means no sample."""
    text = F.coalesce(F.nullif(transcript, F.lit("")), F.lit(NO_TRANSCRIPT))
    empty = lambda c: F.coalesce(c, F.lit(""))
    card = F.concat(
        F.format_string("클러스터: `%s`\n파일: `%s`\n구간: %s ~ %s (%.2fs)\n대사: %s", empty(cluster), filename, empty(start), empty(end), F.coalesce(duration.cast("double"), F.lit(0.0)), text),
        F.when(F.coalesce(has_audio, F.lit(False)), "").otherwise(NO_AUDIO),
    )
    return F.coalesce(card, F.lit(NO_SAMPLE))


def models_on_disk(registry: DataFrame, files: DataFrame, name: str = "name") -> DataFrame:
    """One row: how many registry models have a file."""
    return registry.select(name).distinct().join(files.select(name), name, "left_semi").agg(F.count(F.lit(1)).alias("present"))


def audio_paths(paths: DataFrame, existing: DataFrame, path: str = "path") -> DataFrame:
    """Distinct WAV paths that exist, without doubled separators or `.` steps."""
    clean = F.regexp_replace(F.regexp_replace(X.strip(F.col(path)), r"/(\./)+", "/"), "/{2,}", "/")
    return paths.select(clean.alias(path)).where(F.lower(path).endswith(".wav")).distinct().join(existing.select(path), path, "left_semi")


def named_vectors(names: DataFrame, rows: DataFrame, place: str = "i") -> DataFrame:
    """(filename, embedding): names and vectors at one place meet, the longer side's rest and vectors without direction go."""
    both = names.join(rows, place).withColumn("embedding", V.unit(F.col("embedding")))
    return both.where("embedding is not null and filename != ''").select("filename", "embedding")
