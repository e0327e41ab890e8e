"""Catalogue queries on losses, spectral bins and training chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import losses as L
from voxloom.operators import spectral as P
from voxloom.operators import training as T
from voxloom.plans.registry import query, table
from voxloom.plans.segment_queries import _SAMPLES, _samples
from voxloom.plans.signal_queries import _PAIRS, _SDR, _pairs

_KEYS = ["track", "stem"]


@query(f"WITH p AS ({_PAIRS}) SELECT track, stem, round(10 * (log10(avg(abs(e - r)) + 1e-3) - log10(avg(abs(r)) + 1e-3)), 6) AS loss FROM p GROUP BY track, stem")
def q_p_norm_ratio(spark, sf_dir):
    return L.p_norm_ratio(_pairs(spark, sf_dir), _KEYS, "r", "e").select(*_KEYS, F.round("loss", 6).alias("loss"))


@query(
    f"WITH p AS ({_PAIRS}), k AS (SELECT track, stem, (sum(e * r) + 1e-8) / (sum(r * r) + 1e-8) AS k FROM p GROUP BY track, stem) "
    "SELECT p.track, p.stem, round((avg((e - k * r) * (e - k * r)) + 1e-3) / (avg(k * r * k * r) + 1e-3), 6) AS loss FROM p JOIN k ON p.track = k.track AND p.stem = k.stem GROUP BY p.track, p.stem"
)
def q_p_norm_ratio_scaled(spark, sf_dir):
    return L.p_norm_ratio(_pairs(spark, sf_dir), _KEYS, "r", "e", 2, True, False).select(*_KEYS, F.round("loss", 6).alias("loss"))


_CENTRED = f"p AS ({_PAIRS}), m AS (SELECT track, stem, r - avg(r) OVER w AS r, e - avg(e) OVER w AS e FROM p WINDOW w AS (PARTITION BY track, stem)), k AS (SELECT track, stem, sum(e * r) / (sum(r * r) + 1e-8) AS k FROM m GROUP BY track, stem)"


@query(
    f"WITH {_CENTRED} SELECT m.track, m.stem, round(-10 * log10(sum(r * r) / (sum((e - r) * (e - r)) + 1e-8) + 1e-8), 3) AS snr, round(-10 * log10(sum(k * r * k * r) / (sum((e - k * r) * (e - k * r)) + 1e-8) + 1e-8), 3) AS sisdr, "
    "round(-10 * log10(sum(k * r * k * r) / (sum((e - r) * (e - r)) + 1e-8) + 1e-8), 3) AS sdsdr FROM m JOIN k ON m.track = k.track AND m.stem = k.stem GROUP BY m.track, m.stem HAVING count(*) > 2"
)
def q_negative_sdr(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    enough = p.groupBy(*_KEYS).count().where("count > 2")
    out = enough.select(*_KEYS)
    for kind in ("snr", "sisdr", "sdsdr"):
        out = out.join(L.negative_sdr(p, _KEYS, "r", "e", kind).select(*_KEYS, F.round("loss", 3).alias(kind)), _KEYS)
    return out


@query(f"WITH p AS ({_PAIRS}), w AS (SELECT track, stem, {_SDR} AS sdr, avg(abs(r - e)) AS l1, avg((r - e) * (r - e)) AS l2, corr(r, e) AS correlation FROM p GROUP BY track, stem HAVING count(*) > 2) SELECT track, stem, metric, round(value, 5) AS value FROM w UNPIVOT (value FOR metric IN (sdr, l1, l2, correlation))")
def q_metric_values(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    found = L.metric_values(p.join(p.groupBy(*_KEYS).count().where("count > 2"), _KEYS), _KEYS, "r", "e", ["sdr", "l1", "l2", "correlation"])
    return found.select(*_KEYS, "metric", F.round("value", 5).alias("value"))


@query(f"WITH p AS ({_PAIRS}), t AS (SELECT track, stem, avg(abs(r - e)) AS loss FROM p GROUP BY ALL), f AS (SELECT track, stem, avg((r - e) * (r - e)) AS loss FROM p GROUP BY ALL), b AS (SELECT track, stem, 0.75 * loss AS loss FROM t UNION ALL SELECT track, stem, 0.25 * loss FROM f) SELECT track, round(sum(loss), 6) AS loss FROM b GROUP BY track")
def q_time_frequency_loss(spark, sf_dir):
    p, d = _pairs(spark, sf_dir), F.col("r") - F.col("e")
    time, frequency = (p.groupBy(*_KEYS).agg(F.avg(c).alias("loss")) for c in (F.abs(d), d * d))
    return L.time_frequency_loss(time, frequency, ["track"], 0.75, 0.25).select("track", F.round("loss", 6).alias("loss"))


@query(
    "WITH b AS (SELECT event_id, event_id % 1025 AS b, value / 100 AS m FROM events) SELECT event_id, round(CASE WHEN b < 300 THEN 1.0 WHEN b < 500 THEN 1 - (b - 299) / 200.0 ELSE 0.0 END, 6)::DOUBLE AS low, "
    "round(CASE WHEN b <= 300 THEN 0.0 WHEN b <= 500 THEN 1 - (501 - b) / 200.0 ELSE 1.0 END, 6)::DOUBLE AS high, round(power(m, CASE WHEN b < 85 THEN 1 + 0.6 / 3 ELSE 1.6 END), 6) AS mask FROM b"
)
def q_bin_masks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 1025).alias("bin"), (F.col("value") / 100).alias("m"))
    masks = {"low": P.low_pass_gain(F.col("bin"), 300, 500), "high": P.high_pass_gain(F.col("bin"), 500, 300), "mask": P.aggressive_mask(F.col("m"), F.col("bin"), 85, 0.3)}
    return e.select("event_id", *[F.round(c, 6).alias(n) for n, c in masks.items()])


_BANDS = (("sub", 0, 40), ("low", 30, 120), ("mid", 100, 500), ("high", 480, 1025))


@query(
    f"WITH b AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {a}, {z})" for n, a, z in _BANDS)}) t(band, low, high)), e AS (SELECT event_id % 1025 AS bin, value FROM events) SELECT band, count(*)::BIGINT AS n, round(avg(value), 6) AS mean, round(sqrt(var_samp(value) + 1e-7), 6) AS std, round(max(value) + avg(value), 6) AS peak FROM e JOIN b ON bin >= low AND bin < high GROUP BY band"
)
def q_band_pooling(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("event_id") % 1025).cast("int").alias("bin"), "value")
    rows = P.in_bands(e, spark.createDataFrame(list(_BANDS), "band string, low int, high int"))
    counts = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    found = counts.join(P.pooled(rows, ["band"], "value", "mean,std"), "band").join(P.pooled(rows, ["band"], "value", "mean+max").withColumnRenamed("value", "peak"), "band")
    return found.select("band", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "peak")])


@query("SELECT o_custkey, o_orderkey, round(0.3 * o_totalprice + 0.7 * coalesce(q, 0), 4) AS blended, round(0.1 * o_totalprice + coalesce(q, 0), 4) AS reduced FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey")
def q_dual_blend(spark, sf_dir):
    q = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q"))
    o = table(spark, sf_dir, "orders").join(q, "o_orderkey", "left")
    a, b = F.col("o_totalprice"), F.col("q")
    return o.select("o_custkey", "o_orderkey", F.round(P.blend(a, b, 0.3), 4).alias("blended"), F.round(P.reduced_mix(a, b), 4).alias("reduced"))


@query("SELECT event_id % 8 AS track, corr(value, user_id) < 0 AS inverted FROM events WHERE event_id // 8 < 1000 GROUP BY event_id % 8")
def q_phase_inverted(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("event_id") % 8).alias("track"), F.floor(F.col("event_id") / 8).alias("i"), "value", "user_id")
    return P.phase_inverted(e, ["track"], "i", "value", "user_id")


_INPUTS = "SELECT doc_id, 'f' || doc_id || CASE doc_id % 5 WHEN 0 THEN '_(Vocals).wav' WHEN 1 THEN '_RVC_x.wav' WHEN 2 THEN '_reverbed_stem.wav' WHEN 3 THEN '_(Instrumental).wav' ELSE '.wav' END AS name FROM documents"


@query(f"WITH f AS ({_INPUTS}), r AS (SELECT *, CASE doc_id % 5 WHEN 0 THEN 'reference' WHEN 1 THEN 'target' WHEN 2 THEN 'reverb' WHEN 3 THEN 'inst' END AS role FROM f WHERE doc_id % 5 < 4) SELECT role, arg_max(name, doc_id) AS name FROM r GROUP BY role")
def q_input_roles(spark, sf_dir):
    k = F.col("doc_id") % 5
    mark = F.when(k == 0, "_(Vocals).wav").when(k == 1, "_RVC_x.wav").when(k == 2, "_reverbed_stem.wav").when(k == 3, "_(Instrumental).wav").otherwise(".wav")
    return P.input_roles(table(spark, sf_dir, "documents").select(F.concat(F.lit("f"), F.col("doc_id").cast("string"), mark).alias("name"), F.col("doc_id").alias("pos")))


@query("SELECT l_orderkey AS track, min(l_quantity) AS n, min(l_quantity) <> max(l_quantity) AS mismatch FROM lineitem GROUP BY l_orderkey")
def q_track_lengths(spark, sf_dir):
    return T.track_lengths(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("track"), F.col("l_quantity").alias("n")))


@query("SELECT vec_id, list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))) / len(embedding) >= 0.1 AS loud FROM embeddings")
def q_loud_chunks(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", T.loud_enough(F.col("embedding"), 0.1).alias("loud"))


@query('WITH n AS (SELECT count(*) AS n FROM supplier), c AS (SELECT unnest(range(0, 7)) AS chunk) SELECT chunk * n + s_suppkey AS item, s_suppkey AS "index", chunk::INT AS chunk, chunk * 300 AS start, chunk * 300 + 1000 AS "end" FROM supplier, n, c')
def q_chunk_items(spark, sf_dir):
    return T.chunk_items(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("index")), 7, 1000, 300)


@query(f"WITH s AS ({_SAMPLES}), m AS (SELECT i, track % 3 AS song, sum(v * (1 + track / 10.0)) AS v FROM s GROUP BY ALL), k AS (SELECT song, max(abs(v)) AS k FROM m GROUP BY song) SELECT m.song, i, round(CASE WHEN k > 0.5 THEN v * 0.5 / k ELSE v END, 6) + 0.0 AS v FROM m JOIN k ON m.song = k.song")
def q_mixture(spark, sf_dir):
    s = _samples(spark, sf_dir).select((F.col("track") % 3).alias("song"), "i", "v", (1 + F.col("track") / 10).alias("gain"))
    return T.clip_scale(T.mixture(s, ["song", "i"], "v", "gain"), ["song"], "v", 0.5).select("song", "i", (F.round("v", 6) + 0.0).alias("v"))
