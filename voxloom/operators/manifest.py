"""Manifest algebra: joins, latest-wins, precedence, upserts, relabelling and labelling-session change lists.

All operators take and give DataFrames; sides that are small by nature (label choices, change lists) join without hints,
so that the planner broadcasts them by their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import text as X

COLUMNS = ("filename", "index", "timestamp_start", "timestamp_end", "transcript")
MIN_FILES = 10


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def media_jobs(files: DataFrame, name: str = "name") -> DataFrame:
    """(output, input, accepted, previous_input): the first media file of a stem converts, later ones are collisions with the one before them in name order."""
    media = files.where(X.is_media(F.col(name))).select(F.col(name).alias("input")).distinct()
    jobs = media.withColumn("output", F.concat(X.stem(F.col("input")), F.lit(".wav")))
    w = Window.partitionBy("output").orderBy("input")
    first = F.first("input").over(w)
    return jobs.select("output", "input", (F.row_number().over(w) == 1).alias("accepted"), F.when(F.col("input") != first, first).alias("previous_input"))


def subtitle_variants(files: DataFrame, name: str = "name") -> DataFrame:
    """(base, name, format): of each base the best format (ass, srt, smi), then the first name."""
    named = files.select(F.col(name).alias("name")).withColumn("format", X.extension(F.col("name"))).where(F.col("format").isin(*X.SUBTITLE_RANK))
    ranked = named.withColumn("base", X.stem(F.col("name")))
    rank = F.when(F.col("format") == "ass", 0).when(F.col("format") == "srt", 1).otherwise(2)
    return first_by(ranked, ["base"], rank, F.col("name")).select("base", "name", "format")


def merge_metadata(*sources: DataFrame, order: str = "row_no") -> DataFrame:
    """Slice metadata by filename: a later source and, in one, a later row wins; blank names go."""
    ranked = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    both = ranked[0]
    for other in ranked[1:]:
        both = both.unionByName(other, allowMissingColumns=True)
    both = both.withColumn("filename", X.blank(F.col("filename"))).where("filename != ''")
    return first_by(both, ["filename"], F.desc("_src"), F.desc(order)).drop("_src", order)


def latest_assignment(assignments: DataFrame) -> DataFrame:
    """One cluster a file: the newest mtime, ties by the larger cluster name."""
    return first_by(assignments, ["filename"], F.desc("mtime"), F.desc("cluster_dir"))


def export_manifest(assignments: DataFrame, metadata: DataFrame, include: DataFrame | None = None) -> DataFrame:
    """Assigned files with their metadata, missing values as empty strings; `include` (filename) restricts them."""
    latest = latest_assignment(assignments).select("filename", "cluster_dir")
    if include is not None:
        latest = latest.join(include.select("filename").distinct(), "filename", "left_semi")
    joined = latest.join(metadata, "filename", "left")
    return joined.select("filename", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in COLUMNS[1:]], "cluster_dir")


def refresh_manifest(manifest: DataFrame, assignments: DataFrame, metadata: DataFrame) -> DataFrame:
    """The manifest with current clusters (empty where a file is gone) and unseen files added; status is kept, changed, missing or added.

    `changed` and `missing` are flags as well: a missing file whose row named a cluster counts as both.  Names match
    without white space at their ends; a row without a name stays as it is.  Extra columns stay, empty in added rows.
    One full outer join on the name gives both sides.
    """
    now = latest_assignment(assignments).select(F.col("filename").alias("_name"), F.col("cluster_dir").alias("_now"))
    told = [c for c in metadata.columns if c not in ("filename", "cluster_dir")]
    now = now.join(metadata.select(F.col("filename").alias("_name"), *[F.col(c).alias(f"_of_{c}") for c in told]), "_name", "left")
    kept = [c for c in manifest.columns if c not in ("filename", "cluster_dir")]
    listed = manifest.withColumn("_row", F.lit(True)).withColumn("_key", F.nullif(X.blank(F.col("filename")), F.lit("")))
    both = listed.join(now, F.col("_key") == F.col("_name"), "full_outer")
    added, named = F.col("_row").isNull(), F.col("_key").isNotNull()
    old, found = X.blank(F.col("cluster_dir")), F.coalesce("_now", F.lit(""))
    changed, missing = ~added & named & (old != found), ~added & named & (found == "")

    def other(c: str) -> Column:
        new = F.col(f"_of_{c}") if c in told else F.lit(None)
        if c not in kept:
            return F.when(added, new).alias(c)
        kind = manifest.schema[c].dataType
        new = new.cast(kind)
        return F.when(added, F.coalesce(new, F.lit("")) if kind.simpleString() == "string" else new).otherwise(F.col(c)).alias(c)

    return both.select(
        F.when(added, F.col("_name")).otherwise(F.col("filename")).alias("filename"),
        F.when(added | named, found).otherwise(F.col("cluster_dir")).alias("cluster_dir"),
        *[other(c) for c in dict.fromkeys([*kept, *told])],
        F.when(added, "added").when(missing, "missing").when(changed, "changed").otherwise("kept").alias("status"),
        changed.alias("changed"),
        missing.alias("missing"),
    )


def refresh_counts(refreshed: DataFrame) -> DataFrame:
    """One row of counts; a missing file may count as changed, too."""
    return refreshed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("changed").alias("changed"), F.count_if(F.col("status") == "added").alias("added"), F.count_if("missing").alias("missing"))


def relabel(assignments: DataFrame, source: str, target: str) -> DataFrame:
    """Moves all files of `source` to `target`; a moved file replaces one of its name there."""
    moved = F.col("cluster_dir") == source
    to = assignments.withColumn("_moved", moved).withColumn("cluster_dir", F.when(moved, F.lit(target)).otherwise(F.col("cluster_dir")))
    return first_by(to, ["filename", "cluster_dir"], F.desc("_moved"), F.desc("mtime")).drop("_moved")


def relabel_counts(assignments: DataFrame, source: str, target: str) -> DataFrame:
    per_file = assignments.where(F.col("cluster_dir").isin(source, target)).groupBy("filename").agg(F.max((F.col("cluster_dir") == source).cast("int")).alias("s"), F.max((F.col("cluster_dir") == target).cast("int")).alias("t"))
    return per_file.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("moved"), F.coalesce(F.sum(F.col("s") * F.col("t")), F.lit(0)).alias("overwritten"))


def prune_small(assignments: DataFrame, min_files: int = MIN_FILES, protect_labeled: bool = False) -> DataFrame:
    """Drops clusters of at most `min_files` files, noise and labelled ones too unless protected; sizes are pre-aggregated, so a huge cluster needs no window."""
    sizes = assignments.groupBy("cluster_dir").agg(F.count(F.lit(1)).alias("_n"))
    keep = F.col("_n") > min_files
    if protect_labeled:
        keep = keep | ~(X.is_unlabeled(F.col("cluster_dir")) | X.is_noise(F.col("cluster_dir")))
    return assignments.join(sizes.where(keep).select("cluster_dir"), "cluster_dir", "left_semi")


def cluster_sizes(rows: DataFrame) -> DataFrame:
    return rows.where(X.blank(F.col("cluster_dir")) != "").groupBy("cluster_dir").agg(F.count(F.lit(1)).alias("n"))


def unlabeled_order(rows: DataFrame) -> DataFrame:
    """Unlabelled clusters by size, number and name, with their place (a list of clusters, not of rows)."""
    sized = cluster_sizes(rows.where(X.is_unlabeled(F.col("cluster_dir")))).withColumn("number", X.cluster_number(F.col("cluster_dir")))
    return sized.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "number", "cluster_dir")))


def next_unlabeled(ordered: DataFrame, skipped: DataFrame) -> DataFrame:
    """The first cluster in order that is not skipped, and how many remain."""
    left = ordered.where("n > 0").join(skipped, "cluster_dir", "left_anti")
    return left.agg(F.min_by("cluster_dir", "place").alias("cluster_dir"), F.count(F.lit(1)).alias("remaining"))


def label_choices(clusters: DataFrame, folders: DataFrame) -> DataFrame:
    both = clusters.select(X.blank(F.col("cluster_dir")).alias("label")).unionByName(folders.select(X.blank(F.col("cluster_dir")).alias("label")))
    return both.distinct().where((F.col("label") != "") & ~X.is_unlabeled(F.col("label")) & ~X.is_noise(F.col("label")))


def normalize_pending(pending: DataFrame, order: str = "seq") -> DataFrame:
    """Well-formed decisions, the first one of each source."""
    clean = pending.select(order, X.blank(F.col("source_cluster")).alias("source_cluster"), X.blank(F.col("target_label")).alias("target_label")).where("source_cluster != '' and target_label != ''")
    return first_by(clean, ["source_cluster"], F.col(order))


def upsert_pending(pending: DataFrame, changes: DataFrame, order: str = "seq") -> DataFrame:
    """The last decision of each source, at the place where the source first came."""
    both = pending.withColumn("_late", F.lit(0)).unionByName(changes.withColumn("_late", F.lit(1)))
    arrived = F.struct("_late", order)
    latest = both.groupBy("source_cluster").agg(F.max_by("target_label", arrived).alias("target_label"), F.min(arrived).alias("_place"))
    return latest.select("source_cluster", "target_label", F.col("_place._late").alias("late"), F.col(f"_place.{order}").alias(order))


def remove_pending(pending: DataFrame, source: str) -> DataFrame:
    return pending.where(F.col("source_cluster") != source)


def progress(ordered: DataFrame, skipped: DataFrame, pending: DataFrame) -> DataFrame:
    """Counters of a labelling session."""
    marks = ordered.join(skipped.withColumn("_s", F.lit(1)), "cluster_dir", "left").join(pending.select(F.col("source_cluster").alias("cluster_dir"), F.lit(1).alias("_p")).distinct(), "cluster_dir", "left")
    of = lambda c: F.count_if(c)
    s, p = F.col("_s").isNotNull(), F.col("_p").isNotNull()
    return marks.agg(F.count(F.lit(1)).alias("unlabeled"), of(~s & ~p).alias("remaining"), of(s).alias("skipped"), of(p).alias("pending"))


def missing(expected: DataFrame, store: DataFrame, key: str = "filename") -> DataFrame:
    return expected.select(key).distinct().join(store.select(key), key, "left_anti")


def registry_lookup(wanted: DataFrame, official: DataFrame, own: DataFrame, key: str = "name") -> DataFrame:
    """Registry rows of the wanted names, official ones first; a name that neither has gets nulls."""
    both = official.withColumn("_rank", F.lit(0)).unionByName(own.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    return wanted.select(key).distinct().join(first_by(both, [key], F.col("_rank")), key, "left").drop("_rank")


def register(registry: DataFrame, new: DataFrame, key: str = "name") -> DataFrame:
    """The registry and those new rows whose key it lacks."""
    return registry.unionByName(new.join(registry.select(key), key, "left_anti"), allowMissingColumns=True)


def retained_logs(files: DataFrame, keep: int, name: str = "name") -> DataFrame:
    """The newest `keep` log files by the date in their names (a top-k)."""
    day = F.try_to_timestamp(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd"))
    return files.withColumn("day", F.to_date(day)).orderBy(F.desc_nulls_last("day"), name).limit(keep)


def matched_texts(texts: DataFrame, audio: DataFrame) -> DataFrame:
    """(name, target_stem, action): transcripts move beside the WAV of their stem, others are marked for deletion."""
    stems = audio.select(X.stem(F.col("name")).alias("target_stem")).distinct()
    named = texts.withColumn("_stem", X.stem(F.col("name")))
    return named.join(stems, F.col("_stem") == F.col("target_stem"), "left").select("name", "target_stem", F.when(F.col("target_stem").isNull(), "delete").otherwise("move").alias("action"))
