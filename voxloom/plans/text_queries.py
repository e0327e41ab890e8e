"""Catalogue queries on text, names and subtitle cues."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voxloom.functions import text as X
from voxloom.operators import segments as S
from voxloom.plans.registry import query, table
from voxloom.sources import subtitles

_NUMBERED = "SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, row_number() OVER (ORDER BY lpad(conv_id::VARCHAR, 8, '0'), turn) - 1 AS g FROM conversations"


def _dialogues(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select(F.lpad(F.col("conv_id").cast("string"), 8, "0").alias("base"), F.col("turn").alias("seq"), F.col("turn").cast("double").alias("start"), (F.col("turn") + 0.5).alias("end"), F.lit("").alias("actor"), F.concat(F.lit("s-"), F.col("role")).alias("style"), "text")


@query(f"WITH n AS ({_NUMBERED}) SELECT lpad(conv_id::VARCHAR, 8, '0') || '_' || lpad(i::VARCHAR, 6, '0') || '.wav' AS filename, i::VARCHAR AS \"index\", printf('%.6f', turn::DOUBLE) AS timestamp_start, printf('%.6f', turn + 0.5) AS timestamp_end, text AS transcript FROM n")
def q_slice_names_local(spark, sf_dir):
    return subtitles.slice_manifest(_dialogues(spark, sf_dir), "local")


@query(f"WITH n AS ({_NUMBERED}) SELECT lpad(conv_id::VARCHAR, 8, '0') || '__' || lpad(g::VARCHAR, 6, '0') || '.wav' AS filename, g::VARCHAR AS \"index\", printf('%.6f', turn::DOUBLE) AS timestamp_start, printf('%.6f', turn + 0.5) AS timestamp_end, '[' || role || '] ' || text AS transcript FROM n")
def q_slice_names_global(spark, sf_dir):
    return subtitles.slice_manifest(_dialogues(spark, sf_dir), "global")


@query(
    "WITH c AS (SELECT conv_id, turn, text, CASE WHEN turn % 4 = 0 THEN '' ELSE role END AS actor, CASE turn % 3 WHEN 0 THEN 'Default' WHEN 1 THEN '12-' || role ELSE 'style ' || role END AS style FROM conversations) "
    "SELECT conv_id, turn, '[' || CASE WHEN actor <> '' THEN actor WHEN style LIKE '%-%' AND trim(substr(style, strpos(style, '-') + 1)) <> '' THEN trim(substr(style, strpos(style, '-') + 1)) WHEN lower(style) <> 'default' AND style <> '' THEN style ELSE 'Unknown' END || '] ' || text AS line FROM c"
)
def q_actor_line(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    actor = F.when(F.col("turn") % 4 == 0, "").otherwise(F.col("role"))
    style = F.when(F.col("turn") % 3 == 0, F.lit("Default")).when(F.col("turn") % 3 == 1, F.concat(F.lit("12-"), F.col("role"))).otherwise(F.concat(F.lit("style "), F.col("role")))
    return c.select("conv_id", "turn", X.transcript_line(X.actor(actor, style), F.col("text")).alias("line"))


def _clean_sql(c: str) -> str:
    c = f"regexp_replace(coalesce({c}, ''), '\\r\\n?', chr(10), 'g')"
    c = f"regexp_replace({c}, '\\\\[Nn]', ' ', 'g')"
    c = f"regexp_replace({c}, '(?i)<br\\s*/?>', ' ', 'g')"
    c = f"regexp_replace({c}, '\\{{[^}}\\n]*\\}}', '', 'g')"
    c = f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"
    for entity, char in X.ENTITIES:
        char = char.replace("'", "''")
        c = f"replace({c}, '{entity}', '{char}')"
    return f"trim(regexp_replace({c}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


@query(f"SELECT page_id AS id, 'page' AS kind, {_clean_sql('html')} AS text FROM pages UNION ALL SELECT doc_id, 'document', {_clean_sql('text')} FROM documents")
def q_text_normalize(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit("page").alias("kind"), X.clean_text(F.col("html")).alias("text"))
    return pages.unionByName(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), X.clean_text(F.col("text")).alias("text")))


_VARIANTS = (("smi", "<SAMI><SYNC Start=1>"), ("ass", "[Events]\nDialogue: "), ("srt", "0:00:01,000 --> 0:00:02,000\n"), ("none", ""))


@query(
    "WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '<SAMI><SYNC Start=1>' WHEN 1 THEN '[Events]' || chr(10) || 'Dialogue: ' WHEN 2 THEN '0:00:01,000 --> 0:00:02,000' || chr(10) ELSE '' END || text AS text, 'f' || doc_id || CASE WHEN doc_id % 8 = 3 THEN '.SRT' ELSE '.txt' END AS name FROM documents), "
    "h AS (SELECT doc_id, name, lower(substr(text, 1, 20000)) AS h FROM t) SELECT doc_id, CASE WHEN contains(h, '<sync') OR contains(h, '<sami') THEN 'smi' WHEN contains(h, 'dialogue:') AND contains(h, '[events]') THEN 'ass' WHEN contains(h, '-->') AND regexp_matches(h, '\\d+:\\d{2}:\\d{2}[,.]\\d+') THEN 'srt' WHEN name LIKE '%.SRT' THEN 'srt' END AS format FROM h"
)
def q_format_sniff(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lead = F.when(F.col("doc_id") % 4 == 0, _VARIANTS[0][1]).when(F.col("doc_id") % 4 == 1, _VARIANTS[1][1]).when(F.col("doc_id") % 4 == 2, _VARIANTS[2][1]).otherwise("")
    name = F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 8 == 3, ".SRT").otherwise(".txt"))
    return d.select("doc_id", X.subtitle_format(F.concat(lead, F.col("text")), name).alias("format"))


@query(
    "WITH s AS (SELECT event_id, event_id % 86400 AS s, event_id % 1000 AS ms FROM events) SELECT event_id, round(s + (ms // 10) / 100.0, 6)::DOUBLE AS ass, round(s + CASE event_id % 3 WHEN 0 THEN ms / 1000.0 WHEN 1 THEN (ms // 10) / 100.0 ELSE (ms // 100) / 10.0 END, 6)::DOUBLE AS srt, 0.0::DOUBLE AS bad FROM s"
)
def q_time_parse(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    s, ms = F.col("event_id") % 86400, F.col("event_id") % 1000
    clock = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    ass = F.concat(clock, F.lit("."), F.lpad(F.floor(ms / 10).cast("string"), 2, "0"), F.lit(" tail"))
    digits = F.lpad(ms.cast("string"), 3, "0")
    srt = F.concat(clock, F.lit(","), F.when(F.col("event_id") % 3 == 0, digits).when(F.col("event_id") % 3 == 1, F.substring(digits, 1, 2)).otherwise(F.substring(digits, 1, 1)))
    return e.select("event_id", F.round(X.ass_seconds(ass), 6).alias("ass"), F.round(X.srt_seconds(srt), 6).alias("srt"), X.ass_seconds(clock).alias("bad"))


@query(
    "WITH c AS (SELECT conv_id, turn, turn * 1500 + conv_id % 7 AS ms, CASE WHEN turn % 3 = 1 THEN '&nbsp;' ELSE text END AS text FROM conversations), "
    f"n AS (SELECT *, lead(ms) OVER (PARTITION BY conv_id ORDER BY turn) AS nx, {_clean_sql('text')} AS clean FROM c) "
    "SELECT conv_id, turn, (ms / 1000.0)::DOUBLE AS start, (nx / 1000.0)::DOUBLE AS \"end\", clean AS text FROM n WHERE nx > ms AND clean <> ''"
)
def q_sami_cues(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    cues = c.select("conv_id", "turn", (F.col("turn") * 1500 + F.col("conv_id") % 7).alias("ms"), F.when(F.col("turn") % 3 == 1, "&nbsp;").otherwise(F.col("text")).alias("text"))
    return S.sami_cues(cues, ["conv_id"], "ms", "text", "turn").select("conv_id", "turn", "start", "end", "text")


@query(
    "WITH r AS (SELECT conv_id % 5 AS base, conv_id, turn, CASE WHEN role = 'user' AND conv_id % 5 = 4 THEN 'Talk' WHEN role = 'user' THEN 'Default' WHEN role = 'system' THEN 'Red' ELSE (turn % 100)::VARCHAR || '-voice' END AS style, text FROM conversations), "
    "p AS (SELECT *, style = 'Default' OR regexp_matches(style, '^\\d+-') AS p1 FROM r), n AS (SELECT *, count(*) FILTER (WHERE p1) OVER (PARTITION BY base) >= 80 AS first FROM p) "
    "SELECT base, conv_id, turn, CASE WHEN first THEN 'phase1' ELSE 'phase2' END AS mode FROM n WHERE CASE WHEN first THEN p1 ELSE NOT regexp_matches(style, '(?i)(op|ed|title|sign|kara|lyric|gasa|ruby|cell|mail|phone|cm|preview)') AND NOT regexp_matches(text, '♪|♬') END"
)
def q_adaptive_filter(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    style = F.when((F.col("role") == "user") & (F.col("conv_id") % 5 == 4), F.lit("Talk")).when(F.col("role") == "user", F.lit("Default")).when(F.col("role") == "system", F.lit("Red")).otherwise(F.concat((F.col("turn") % 100).cast("string"), F.lit("-voice")))
    rows = c.select((F.col("conv_id") % 5).alias("base"), "conv_id", "turn", style.alias("style"), "text")
    return S.adaptive_filter(rows).select("base", "conv_id", "turn", "mode")


@query(
    "SELECT event_id, value AS seconds, CASE WHEN event_id % 17 = 0 THEN 'invalid_sample_rate' WHEN NOT value BETWEEN 0.5 AND 10.0 THEN 'out_of_range' WHEN event_id % 13 = 0 THEN 'empty_signal' ELSE '' END AS reason, value BETWEEN 0.3 AND 15.0 AS slice FROM events"
)
def q_duration_filter(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rate, n = F.when(F.col("event_id") % 17 == 0, 0).otherwise(16000), F.when(F.col("event_id") % 13 == 0, 0).otherwise(100)
    return e.select("event_id", F.col("value").alias("seconds"), S.audio_reason(rate, F.col("value"), n).alias("reason"), F.col("value").between(*S.SLICE_SECONDS).alias("slice"))


@query(
    "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' ' WHEN 1 THEN 'noise ' WHEN 2 THEN 'Clustering_' || p_partkey WHEN 3 THEN p_name || '/x' ELSE ' ' || p_name END AS raw, "
    "CASE p_partkey % 6 WHEN 0 THEN 'empty' WHEN 1 THEN 'noise' WHEN 2 THEN 'reserved' WHEN 3 THEN 'separator' ELSE '' END AS reason, p_partkey % 6 >= 4 AS ok FROM part"
)
def q_label_validate(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    raw = F.when(k % 6 == 0, F.lit(" ")).when(k % 6 == 1, F.lit("noise ")).when(k % 6 == 2, F.concat(F.lit("Clustering_"), k.cast("string"))).when(k % 6 == 3, F.concat("p_name", F.lit("/x"))).otherwise(F.concat(F.lit(" "), "p_name"))
    checked = p.select("p_partkey", raw.alias("raw")).withColumn("c", X.label_check(F.col("raw")))
    return checked.select("p_partkey", "raw", F.col("c.reason").alias("reason"), F.col("c.ok").alias("ok"))


@query(
    "SELECT event_id, coalesce(TRY_CAST(user_id || CASE WHEN event_id % 2 = 0 THEN '' ELSE 'x' END AS INTEGER), 0) AS i, coalesce(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'n/a' ELSE user_id::VARCHAR END AS DOUBLE), -1.0)::DOUBLE AS f, CASE WHEN TRY_CAST(CASE WHEN event_id % 5 = 0 THEN '0' ELSE user_id::VARCHAR END AS INTEGER) >= 1 THEN user_id::INTEGER ELSE -1 END AS p FROM events"
)
def q_safe_casts(spark, sf_dir):
    e, u, k = table(spark, sf_dir, "events"), F.col("user_id").cast("string"), F.col("event_id")
    return e.select(
        "event_id",
        X.safe_int(F.concat(u, F.when(k % 2 == 0, "").otherwise("x"))).alias("i"),
        X.safe_float(F.when(k % 3 == 0, F.lit("n/a")).otherwise(u), -1.0).alias("f"),
        F.coalesce(X.positive_int(F.when(k % 5 == 0, F.lit("0")).otherwise(u)), F.lit(-1)).alias("p"),
    )


@query("SELECT conv_id, count(*)::BIGINT AS n_turns, sum(length(text))::BIGINT AS chars, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def q_episode_summary(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    roles = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda s: s["role"]), ",")
    return c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.sum(F.length("text")).alias("chars"), roles.alias("roles"))


@query("SELECT page_id, regexp_extract(url, '([^/\\\\]*)$', 1) AS name, regexp_replace(regexp_extract(url, '([^/\\\\]*)$', 1), '(.)\\.[^.]*$', '\\1') AS stem FROM pages")
def q_path_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    name = X.file_name(F.col("url"))
    return p.select("page_id", name.alias("name"), X.stem(name).alias("stem"))


@query(
    "WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, 'app_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || o_orderkey || '.log' AS name FROM orders) SELECT name, day FROM o ORDER BY day DESC, name LIMIT 50"
)
def q_log_retention(spark, sf_dir):
    from voxloom.operators.manifest import retained_logs

    o = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("app_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".log"))
    return retained_logs(o.select(name.alias("name")), 50).select("name", F.col("day").cast("string").alias("day"))


@query("SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text FROM conversations")
def q_next_turn(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.lead("text").over(w).alias("next_text"))
