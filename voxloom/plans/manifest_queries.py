"""Catalogue queries on manifests, assignments and labelling sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import text as X
from voxloom.operators import manifest as M
from voxloom.plans.registry import query, table

_NAME = "regexp_extract(url, '([^/\\\\]*)$', 1)"


def _media(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    return p.select(F.concat(F.lit("ep"), F.floor(k / 3).cast("string"), F.when(k % 3 == 0, ".mkv").when(k % 3 == 1, ".MP4").otherwise(".txt")).alias("name"))


_MEDIA = "SELECT DISTINCT 'ep' || page_id // 3 || CASE page_id % 3 WHEN 0 THEN '.mkv' WHEN 1 THEN '.MP4' END AS input, 'ep' || page_id // 3 || '.wav' AS output FROM pages WHERE page_id % 3 < 2"


@query(f"WITH m AS ({_MEDIA}) SELECT output, min(input) AS input FROM m GROUP BY output")
def q_media_jobs(spark, sf_dir):
    return M.media_jobs(_media(spark, sf_dir)).where("accepted").select("output", "input")


@query(f"WITH m AS ({_MEDIA}), r AS (SELECT *, row_number() OVER w AS rn, first_value(input) OVER w AS f FROM m WINDOW w AS (PARTITION BY output ORDER BY input)) SELECT output, input, f AS previous_input FROM r WHERE rn > 1")
def q_media_collisions(spark, sf_dir):
    return M.media_jobs(_media(spark, sf_dir)).where("not accepted").select("output", "input", "previous_input")


@query(
    "WITH f AS (SELECT 'b' || doc_id % 400 || CASE lang WHEN 'en' THEN '.ass' WHEN 'de' THEN '.srt' WHEN 'fr' THEN '.smi' ELSE '.txt' END AS name, 'b' || doc_id % 400 AS base, CASE lang WHEN 'en' THEN 'ass' WHEN 'de' THEN 'srt' WHEN 'fr' THEN 'smi' END AS format, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS rank FROM documents) "
    "SELECT base, name, format FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY rank, name) AS rn FROM f WHERE format IS NOT NULL) WHERE rn = 1"
)
def q_variant_choice(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    ext = F.when(F.col("lang") == "en", ".ass").when(F.col("lang") == "de", ".srt").when(F.col("lang") == "fr", ".smi").otherwise(".txt")
    return M.subtitle_variants(d.select(F.concat(F.lit("b"), (F.col("doc_id") % 400).cast("string"), ext).alias("name")))


@query(
    "WITH s AS (SELECT 'f' || o_orderkey AS filename, o_orderkey AS row_no, 0 AS src, o_orderpriority AS transcript FROM orders UNION ALL SELECT CASE WHEN l_orderkey % 10 = 0 THEN ' ' ELSE ' f' || l_orderkey || ' ' END, l_orderkey * 10 + l_linenumber, 1, max(l_returnflag) || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber) "
    "SELECT filename, transcript FROM (SELECT trim(filename) AS filename, transcript, row_number() OVER (PARTITION BY trim(filename) ORDER BY src DESC, row_no DESC) AS rn FROM s WHERE trim(filename) <> '') WHERE rn = 1"
)
def q_metadata_precedence(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("filename"), F.col("o_orderkey").alias("row_no"), F.col("o_orderpriority").alias("transcript"))
    name = F.when(F.col("l_orderkey") % 10 == 0, " ").otherwise(F.concat(F.lit(" f"), F.col("l_orderkey").cast("string"), F.lit(" ")))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("l_returnflag"))
    rows = lines.select(name.alias("filename"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("transcript"))
    return M.merge_metadata(o, rows).select("filename", "transcript")


def _assignments(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("w"), (F.col("event_id") % 3000).cast("string"), F.lit(".wav")).alias("filename"), F.concat(F.lit("clustering_"), (F.col("user_id") % 12).cast("string")).alias("cluster_dir"), F.floor("value").cast("double").alias("mtime"))


_ASSIGN = "SELECT 'w' || event_id % 3000 || '.wav' AS filename, 'clustering_' || user_id % 12 AS cluster_dir, floor(value)::DOUBLE AS mtime FROM events"
_LATEST = f"SELECT filename, cluster_dir, mtime FROM (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY mtime DESC, cluster_dir DESC) AS rn FROM ({_ASSIGN})) WHERE rn = 1"


@query(_LATEST)
def q_latest_assignment(spark, sf_dir):
    return M.latest_assignment(_assignments(spark, sf_dir))


def _metadata(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("text", "turn").alias("transcript"))
    return c.select(F.concat(F.lit("w"), F.col("conv_id").cast("string"), F.lit(".wav")).alias("filename"), F.col("conv_id").cast("string").alias("index"), X.fixed6(F.col("n") * 0.5).alias("timestamp_start"), X.fixed6(F.col("n") * 0.75).alias("timestamp_end"), "transcript")


_META = "SELECT 'w' || conv_id || '.wav' AS filename, conv_id::VARCHAR AS \"index\", printf('%.6f', count(*) * 0.5) AS timestamp_start, printf('%.6f', count(*) * 0.75) AS timestamp_end, arg_min(text, turn) AS transcript FROM conversations GROUP BY conv_id"


@query(
    f"WITH a AS ({_LATEST}), m AS ({_META}) SELECT a.filename, coalesce(m.\"index\", '') AS \"index\", coalesce(timestamp_start, '') AS timestamp_start, coalesce(timestamp_end, '') AS timestamp_end, coalesce(transcript, '') AS transcript, cluster_dir FROM a LEFT JOIN m ON a.filename = m.filename WHERE a.filename IN (SELECT 'w' || doc_id || '.wav' FROM labels)"
)
def q_manifest_export(spark, sf_dir):
    include = table(spark, sf_dir, "labels").select(F.concat(F.lit("w"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("filename"))
    return M.export_manifest(_assignments(spark, sf_dir), _metadata(spark, sf_dir), include)


def _refreshed(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old = o.select(F.concat(F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise(""), F.lit("w"), F.col("o_orderkey").cast("string"), F.lit(".wav")).alias("filename"), F.col("o_orderpriority").alias("note"), F.concat(F.lit("clustering_"), (F.col("o_orderkey") % 12).cast("string")).alias("cluster_dir"))
    return M.refresh_manifest(old, _assignments(spark, sf_dir), _metadata(spark, sf_dir))


_REFRESH = (
    f"WITH a AS ({_LATEST}), o AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE '' END || 'w' || o_orderkey || '.wav' AS filename, o_orderpriority AS note, 'clustering_' || o_orderkey % 12 AS old FROM orders), "
    "k AS (SELECT o.filename, note, coalesce(a.cluster_dir, '') AS cluster_dir, CASE WHEN a.cluster_dir IS NULL THEN 'missing' WHEN a.cluster_dir <> old THEN 'changed' ELSE 'kept' END AS status, coalesce(a.cluster_dir, '') <> old AS changed, a.cluster_dir IS NULL AS missing FROM o LEFT JOIN a ON trim(o.filename) = a.filename), "
    "n AS (SELECT filename, '' AS note, cluster_dir, 'added' AS status, false AS changed, false AS missing FROM a WHERE filename NOT IN (SELECT trim(filename) FROM o)), r AS (SELECT * FROM k UNION ALL SELECT * FROM n) "
)


@query(_REFRESH + "SELECT filename, note, cluster_dir, status, changed, missing FROM r")
def q_manifest_refresh(spark, sf_dir):
    return _refreshed(spark, sf_dir).select("filename", "note", "cluster_dir", "status", "changed", "missing")


@query(_REFRESH + "SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (WHERE changed)::BIGINT AS changed, count(*) FILTER (WHERE status = 'added')::BIGINT AS added, count(*) FILTER (WHERE missing)::BIGINT AS missing FROM r")
def q_manifest_refresh_counts(spark, sf_dir):
    return M.refresh_counts(_refreshed(spark, sf_dir))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_missing_vectors(spark, sf_dir):
    return M.missing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    f"WITH a AS ({_LATEST}), r AS (SELECT filename, CASE WHEN cluster_dir = 'clustering_3' THEN 'clustering_4' ELSE cluster_dir END AS cluster_dir, mtime FROM (SELECT *, cluster_dir = 'clustering_3' AS m FROM (SELECT DISTINCT * FROM ({_ASSIGN}))) "
    "QUALIFY row_number() OVER (PARTITION BY filename, CASE WHEN cluster_dir = 'clustering_3' THEN 'clustering_4' ELSE cluster_dir END ORDER BY m DESC, mtime DESC) = 1) SELECT * FROM r"
)
def q_relabel_overwrite(spark, sf_dir):
    return M.relabel(_assignments(spark, sf_dir), "clustering_3", "clustering_4")


@query(
    f"WITH a AS ({_ASSIGN}), f AS (SELECT filename, max((cluster_dir = 'clustering_3')::INT) AS s, max((cluster_dir = 'clustering_4')::INT) AS t FROM a WHERE cluster_dir IN ('clustering_3', 'clustering_4') GROUP BY filename) SELECT coalesce(sum(s), 0)::BIGINT AS moved, coalesce(sum(s * t), 0)::BIGINT AS overwritten FROM f"
)
def q_relabel_counts(spark, sf_dir):
    return M.relabel_counts(_assignments(spark, sf_dir), "clustering_3", "clustering_4")


@query("SELECT event_id, user_id FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE n > 60")
def q_prune_small(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.concat(F.lit("clustering_"), F.col("user_id").cast("string")).alias("cluster_dir"))
    return M.prune_small(e, 60).select("event_id", "user_id")


_CLUSTERS = "SELECT vec_id, CASE label WHEN 3 THEN 'noise' WHEN 4 THEN 'alice' ELSE 'clustering_' || label END AS cluster_dir FROM embeddings"


def _clusters(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    return v.select("vec_id", F.when(F.col("label") == 3, F.lit("noise")).when(F.col("label") == 4, F.lit("alice")).otherwise(F.concat(F.lit("clustering_"), F.col("label").cast("string"))).alias("cluster_dir"))


@query(f"WITH c AS ({_CLUSTERS}) SELECT cluster_dir, count(*)::BIGINT AS n, substr(cluster_dir, 12)::INT AS number, row_number() OVER (ORDER BY count(*) DESC, substr(cluster_dir, 12)::INT, cluster_dir)::INT AS place FROM c WHERE cluster_dir LIKE 'clustering_%' GROUP BY cluster_dir")
def q_unlabeled_order(spark, sf_dir):
    return M.unlabeled_order(_clusters(spark, sf_dir))


@query(f"WITH c AS ({_CLUSTERS}), o AS (SELECT cluster_dir, count(*) AS n FROM c WHERE cluster_dir LIKE 'clustering_%' AND cluster_dir NOT IN ('clustering_0', 'clustering_7') GROUP BY cluster_dir) SELECT (SELECT cluster_dir FROM o ORDER BY n DESC, substr(cluster_dir, 12)::INT LIMIT 1) AS cluster_dir, count(*)::BIGINT AS remaining FROM o")
def q_next_unlabeled(spark, sf_dir):
    skipped = spark.range(2).select(F.when(F.col("id") == 0, "clustering_0").otherwise("clustering_7").alias("cluster_dir"))
    return M.next_unlabeled(M.unlabeled_order(_clusters(spark, sf_dir)), skipped)


@query("SELECT DISTINCT trim(x) AS label FROM (SELECT p_name AS x FROM part UNION ALL SELECT CASE s_suppkey % 3 WHEN 0 THEN 'noise' WHEN 1 THEN 'clustering_' || s_suppkey ELSE s_name END FROM supplier) WHERE trim(x) <> '' AND lower(trim(x)) <> 'noise' AND NOT regexp_full_match(lower(trim(x)), 'clustering_\\d+')")
def q_label_choices(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    folders = s.select(F.when(k % 3 == 0, F.lit("noise")).when(k % 3 == 1, F.concat(F.lit("clustering_"), k.cast("string"))).otherwise(F.col("s_name")).alias("cluster_dir"))
    return M.label_choices(table(spark, sf_dir, "part").select(F.col("p_name").alias("cluster_dir")), folders)


def _pending(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_id").alias("seq"), F.when(F.col("event_id") % 50 == 0, " ").otherwise(F.concat(F.lit("c"), (F.col("user_id") % 40).cast("string"))).alias("source_cluster"), F.col("event_type").alias("target_label"))
    return M.normalize_pending(rows.where("seq % 2 = 0")), rows.where("seq % 2 = 1")


_PENDING = (
    "WITH r AS (SELECT event_id AS seq, CASE WHEN event_id % 50 = 0 THEN '' ELSE 'c' || user_id % 40 END AS source_cluster, event_type AS target_label FROM events), "
    "p AS (SELECT * FROM r WHERE seq % 2 = 0 AND source_cluster <> '' QUALIFY row_number() OVER (PARTITION BY source_cluster ORDER BY seq) = 1), c AS (SELECT * FROM r WHERE seq % 2 = 1) "
)


@query(_PENDING + "SELECT seq, source_cluster, target_label FROM p")
def q_pending_normalize(spark, sf_dir):
    return _pending(spark, sf_dir)[0].select("seq", "source_cluster", "target_label")


@query(_PENDING + ", b AS (SELECT *, 0 AS late FROM p UNION ALL SELECT *, 1 FROM c) SELECT source_cluster, last(target_label ORDER BY late, seq) AS target_label, min(late)::INT AS late, first(seq ORDER BY late, seq)::BIGINT AS seq FROM b GROUP BY source_cluster")
def q_pending_upsert(spark, sf_dir):
    return M.upsert_pending(*_pending(spark, sf_dir))


@query(
    "WITH u AS (SELECT DISTINCT 'clustering_' || doc_id AS c, doc_id FROM documents), s AS (SELECT 'clustering_' || doc_id AS c FROM labels WHERE quality = 0), p AS (SELECT 'clustering_' || doc_id AS c FROM labels WHERE toxic = 1) "
    "SELECT count(*)::BIGINT AS unlabeled, count(*) FILTER (WHERE c NOT IN (SELECT c FROM s) AND c NOT IN (SELECT c FROM p))::BIGINT AS remaining, count(*) FILTER (WHERE c IN (SELECT c FROM s))::BIGINT AS skipped, count(*) FILTER (WHERE c IN (SELECT c FROM p))::BIGINT AS pending FROM u"
)
def q_progress(spark, sf_dir):
    name = F.concat(F.lit("clustering_"), F.col("doc_id").cast("string"))
    labels = table(spark, sf_dir, "labels")
    ordered = table(spark, sf_dir, "documents").select(name.alias("cluster_dir"))
    return M.progress(ordered, labels.where("quality = 0").select(name.alias("cluster_dir")), labels.where("toxic = 1").select(name.alias("source_cluster")))


@query(
    "WITH o AS (SELECT p_name AS name, p_size AS v FROM part WHERE p_partkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1), u AS (SELECT p_name AS name, -p_size AS v FROM part WHERE p_partkey % 3 = 0 QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1), "
    "w AS (SELECT DISTINCT p_name AS name FROM part) SELECT w.name, coalesce(o.v, u.v)::VARCHAR AS v FROM w LEFT JOIN o ON w.name = o.name LEFT JOIN u ON w.name = u.name"
)
def q_registry_lookup(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    one = lambda rows, v: M.first_by(rows, ["p_name"], F.col("p_partkey")).select(F.col("p_name").alias("name"), v.cast("string").alias("v"))
    return M.registry_lookup(p.select(F.col("p_name").alias("name")), one(p.where("p_partkey % 2 = 0"), F.col("p_size")), one(p.where("p_partkey % 3 = 0"), -F.col("p_size")))


@query("SELECT o_orderpriority AS stage, count(*)::BIGINT AS files, round(sum(o_totalprice), 2) AS elapsed_s, round(avg(o_totalprice), 4) AS avg_s, max(o_orderdate) AS last FROM orders GROUP BY o_orderpriority")
def q_stage_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("stage")).agg(F.count(F.lit(1)).alias("files"), F.round(F.sum("o_totalprice"), 2).alias("elapsed_s"), F.round(F.avg("o_totalprice"), 4).alias("avg_s"), F.max("o_orderdate").alias("last"))
