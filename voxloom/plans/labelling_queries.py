"""Catalogue queries on the labelling session."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import labelling as S
from voxloom.operators import manifest as M
from voxloom.operators import vectors as V
from voxloom.plans.manifest_queries import _ASSIGN, _CLUSTERS, _assignments, _clusters
from voxloom.plans.registry import query, table


def _names(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "cluster_dir string")


@query(f"WITH c AS ({_CLUSTERS}), o AS (SELECT cluster_dir, count(*) AS n FROM c WHERE cluster_dir LIKE 'clustering_%' AND cluster_dir NOT IN ('clustering_0', 'clustering_7', 'clustering_9') GROUP BY cluster_dir) SELECT 'clustering_8' AS cluster_dir, count(*)::BIGINT AS remaining FROM o")
def q_pick_current(spark, sf_dir):
    return S.pick(M.unlabeled_order(_clusters(spark, sf_dir)), _names(spark, "clustering_0 ", "clustering_7"), _names(spark, "clustering_9"), "clustering_8", True)


@query(f"WITH c AS ({_CLUSTERS}), o AS (SELECT cluster_dir, count(*) AS n FROM c WHERE cluster_dir LIKE 'clustering_%' AND cluster_dir NOT IN ('clustering_0', 'clustering_7') GROUP BY cluster_dir) SELECT (SELECT cluster_dir FROM o ORDER BY n DESC, substr(cluster_dir, 12)::INT LIMIT 1) AS cluster_dir, count(*)::BIGINT AS remaining FROM o")
def q_pick_next(spark, sf_dir):
    """The current cluster is skipped, so the first open one comes."""
    return S.pick(M.unlabeled_order(_clusters(spark, sf_dir)), _names(spark, "clustering_0", "clustering_7"), _names(spark), "clustering_7", True)


_DECISIONS = "SELECT user_id % 12 AS seq, 'clustering_' || user_id % 12 AS source_cluster, 'speaker' || (user_id % 12) // 3 AS target_label FROM events WHERE user_id % 12 < 6 GROUP BY ALL"


@query(
    f"WITH a AS ({_ASSIGN}), d AS ({_DECISIONS}), m AS (SELECT filename, coalesce(target_label, cluster_dir) AS cluster_dir, mtime, seq FROM a LEFT JOIN d ON cluster_dir = source_cluster) "
    "SELECT filename, cluster_dir, mtime FROM m QUALIFY row_number() OVER (PARTITION BY filename, cluster_dir ORDER BY seq DESC NULLS LAST, mtime DESC) = 1"
)
def q_confirm_batch(spark, sf_dir):
    k = F.col("user_id") % 12
    d = table(spark, sf_dir, "events").where(k < 6).select(k.alias("seq"), F.concat(F.lit("clustering_"), k.cast("string")).alias("source_cluster"), F.concat(F.lit(" speaker"), F.floor(k / 3).cast("string")).alias("target_label")).distinct()
    return S.confirm(_assignments(spark, sf_dir), d)


@query(
    f"WITH c AS ({_CLUSTERS}) SELECT 'clustering_' || k AS target, CASE WHEN k = 77 THEN '{S.NO_TARGET}' WHEN k >= 0 THEN '{S.NO_LABEL}' END AS reason, '' AS label, true AS warning FROM (SELECT unnest([0, 1, 77]) AS k)"
)
def q_recommend_exits(spark, sf_dir):
    """No labels: every target gets a row that says why; one target has no vectors."""
    e = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("clustering_"), F.col("label").cast("string")).alias("cluster_dir"), "embedding")
    none = _names(spark).select(F.col("cluster_dir").alias("label"))
    return S.recommend_all(_names(spark, "clustering_0", "clustering_1", "clustering_77"), V.centroids(e), none).select("target", "reason", "label", "warning")


@query("SELECT DISTINCT 'clustering_' || doc_id AS cluster_dir FROM (SELECT doc_id FROM labels WHERE quality = 0 UNION SELECT doc_id FROM labels WHERE toxic = 1) WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def q_skipped_after(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    name = F.concat(F.lit("clustering_"), F.col("doc_id").cast("string"))
    both = S.skip(labels.where("quality = 0").select(F.concat(F.lit(" "), name).alias("cluster_dir")), labels.where("toxic = 1").select(name.alias("cluster_dir")))
    return S.skipped_after(both, labels.where("quality = 1").select(name.alias("source_cluster")))


@query("SELECT count(*)::BIGINT AS present FROM (SELECT DISTINCT p_name FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_partkey % 3 = 0))")
def q_models_on_disk(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), "p_partkey")
    return S.models_on_disk(p, p.where("p_partkey % 3 = 0"))


@query("SELECT DISTINCT '/data/' || s_nationkey || '/' || s_suppkey || '.WAV' AS path FROM supplier WHERE s_suppkey % 4 < 2 AND s_suppkey % 3 > 0")
def q_audio_paths(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    path = F.concat(F.lit("/data/"), F.col("s_nationkey").cast("string"), F.when(k % 2 == 0, "//").otherwise("/./"), k.cast("string"), F.when(k % 4 < 2, ".WAV\n").otherwise(".mp3"))
    there = s.where("s_suppkey % 3 > 0").select(F.concat(F.lit("/data/"), F.col("s_nationkey").cast("string"), F.lit("/"), k.cast("string"), F.when(k % 4 < 2, ".WAV").otherwise(".mp3")).alias("path"))
    return S.audio_paths(s.select(path.alias("path")).unionByName(s.select(path.alias("path"))), there)


@query("SELECT 'v' || vec_id || '.wav' AS filename, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS length FROM embeddings WHERE vec_id % 7 > 0")
def q_named_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    zero = F.transform("embedding", lambda x: x * 0)
    names = e.select(F.col("vec_id").alias("i"), F.concat(F.lit("v"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("filename"))
    rows = e.select(F.col("vec_id").alias("i"), F.when(F.col("vec_id") % 7 == 0, zero).otherwise(F.col("embedding")).alias("embedding"))
    return S.named_vectors(names, rows).select("filename", F.round(V.norm(F.col("embedding")), 6).alias("length"))


@query("SELECT conv_id, turn, '클러스터: `' || role || '`' || chr(10) || '파일: `' || conv_id || '.wav`' || chr(10) || '구간: ' || turn || ' ~  (' || printf('%.2f', turn / 4.0) || 's)' || chr(10) || '대사: ' || CASE WHEN text = '' OR text IS NULL THEN '(전사 없음)' ELSE text END || CASE WHEN turn % 2 = 0 THEN '' ELSE chr(10) || '오디오: 없음' END AS card FROM conversations")
def q_sample_card(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    card = S.sample_card(F.col("role"), F.concat(F.col("conv_id").cast("string"), F.lit(".wav")), F.col("turn").cast("string"), F.lit(None).cast("string"), F.col("turn") / 4, F.col("text"), F.col("turn") % 2 == 0)
    return c.select("conv_id", "turn", card.alias("card"))
