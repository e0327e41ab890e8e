"""Catalogue queries on signals: lineitem as reference/estimate pairs, events as sample tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import signal as G
from voxloom.plans.registry import query, table
from voxloom.plans.segment_queries import _SAMPLES, _samples


def _pairs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("track"), F.col("l_returnflag").alias("stem"), F.col("l_linenumber").alias("channel"), (F.col("l_extendedprice") / 1000).alias("r"), (F.col("l_extendedprice") / 1000 * (1 - F.col("l_discount")) + F.col("l_tax")).alias("e"), "l_orderkey")


_PAIRS = "SELECT l_suppkey AS track, l_returnflag AS stem, l_linenumber AS channel, l_extendedprice / 1000 AS r, l_extendedprice / 1000 * (1 - l_discount) + l_tax AS e, l_orderkey FROM lineitem"
_SDR = "10 * log10((sum(r * r) + 1e-7) / (sum((r - e) * (r - e)) + 1e-7))"


@query(f"WITH p AS ({_PAIRS}) SELECT track, stem, round({_SDR}, 6) AS sdr FROM p GROUP BY track, stem")
def q_sdr(spark, sf_dir):
    return _pairs(spark, sf_dir).groupBy("track", "stem").agg(F.round(G.sdr(F.col("r"), F.col("e")), 6).alias("sdr"))


@query(
    f"WITH p AS ({_PAIRS}), k AS (SELECT track, stem, (sum(e * r) + count(*) * 1e-7) / (sum(r * r) + count(*) * 1e-7) AS k FROM p GROUP BY track, stem) "
    "SELECT p.track, p.stem, round(10 * log10(sum(k * r * k * r) / (sum((k * r - e) * (k * r - e)) + 1e-7) + 1e-7), 4) AS si_sdr FROM p JOIN k ON p.track = k.track AND p.stem = k.stem GROUP BY p.track, p.stem"
)
def q_si_sdr(spark, sf_dir):
    return G.si_sdr(_pairs(spark, sf_dir), ["track", "stem"], "r", "e").select("track", "stem", F.round("si_sdr", 4).alias("si_sdr"))


@query(f"WITH p AS ({_PAIRS}), c AS (SELECT track, channel, round({_SDR}, 4) AS s FROM p GROUP BY track, channel) SELECT track, round(avg(s), 6) AS sdr FROM c GROUP BY track")
def q_sdr_channel(spark, sf_dir):
    return G.channel_sdr(_pairs(spark, sf_dir), ["track"], "channel", "r", "e").select("track", F.round("sdr", 6).alias("sdr"))


@query(
    f"WITH p AS ({_PAIRS}), c AS (SELECT track, l_orderkey // 500 AS c, {_SDR} AS s, count(*) AS n FROM p GROUP BY ALL) SELECT track, round(quantile_disc(s, 0.5), 6) AS median FROM c WHERE n >= 5 AND isfinite(s) GROUP BY track"
)
def q_chunk_median(spark, sf_dir):
    found = G.chunk_median(_pairs(spark, sf_dir), "track", "l_orderkey", 500, G.sdr(F.col("r"), F.col("e")), 5)
    return found.select("track", F.round("median", 6).alias("median"))


@query(f"WITH p AS ({_PAIRS}), m AS (SELECT track, avg((r - e) * (r - e)) AS mse FROM p GROUP BY track), q AS (SELECT quantile_cont(mse, 0.9) AS q FROM m) SELECT round(sum(CASE WHEN mse < q THEN mse ELSE 0.0 END) / count(*), 6) AS loss FROM m, q")
def q_masked_loss(spark, sf_dir):
    return G.masked_loss(_pairs(spark, sf_dir), "track", "r", "e", 0.9).select(F.round("loss", 6).alias("loss"))


@query(
    f"WITH p AS ({_PAIRS}), v AS (SELECT 'sdr' AS metric, stem AS instr, track, {_SDR} AS value FROM p GROUP BY stem, track), b AS (SELECT metric, instr, avg(value) AS mean, stddev_pop(value) AS std FROM v GROUP BY metric, instr) "
    "SELECT metric, instr, round(mean, 6) AS mean, round(std, 6) AS std FROM b UNION ALL SELECT metric, NULL, round(avg(mean), 6), round(avg(std), 6) FROM b GROUP BY metric"
)
def q_metric_summary(spark, sf_dir):
    v = _pairs(spark, sf_dir).groupBy(F.col("stem").alias("instr"), "track").agg(G.sdr(F.col("r"), F.col("e")).alias("value")).withColumn("metric", F.lit("sdr"))
    return G.metric_summary(v).select("metric", "instr", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_SOURCES = "SELECT l_orderkey AS k, l_linenumber AS src, l_extendedprice / 1000 - 40 AS v, l_quantity AS w FROM lineitem"


def _sources(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("src"), (F.col("l_extendedprice") / 1000 - 40).alias("v"), F.col("l_quantity").alias("w"))
    return rows.groupBy("k", "src").agg(F.min("v").alias("v"), F.min("w").alias("w"))


_ONE = f"SELECT k, src, min(v) AS v, min(w) AS w FROM ({_SOURCES}) GROUP BY k, src"


@query(f"WITH s AS ({_ONE}) SELECT k, round(sum(v * w) / sum(w) + 1e-9, 6) + 0.0 AS v FROM s GROUP BY k")
def q_ensemble_avg(spark, sf_dir):
    return G.ensemble(_sources(spark, sf_dir), ["k"], "avg", weight=F.col("w")).select("k", (F.round(F.col("v") + 1e-9, 6) + 0.0).alias("v"))


@query(f"WITH s AS ({_ONE}) SELECT k, round(median(v), 6) + 0.0 AS v FROM s GROUP BY k")
def q_ensemble_median(spark, sf_dir):
    return G.ensemble(_sources(spark, sf_dir), ["k"], "median").select("k", (F.round("v", 6) + 0.0).alias("v"))


@query(f"WITH s AS ({_ONE}) SELECT k, round(v, 6) + 0.0 AS v FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY abs(v), src) = 1")
def q_ensemble_min(spark, sf_dir):
    return G.ensemble(_sources(spark, sf_dir), ["k"], "min").select("k", (F.round("v", 6) + 0.0).alias("v"))


@query(f"WITH s AS ({_ONE}) SELECT k, round(v, 6) + 0.0 AS v FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY abs(v) DESC, src) = 1")
def q_ensemble_max(spark, sf_dir):
    return G.ensemble(_sources(spark, sf_dir), ["k"], "max").select("k", (F.round("v", 6) + 0.0).alias("v"))


@query(f"WITH s AS ({_ONE}) SELECT k, round(v, 6) + 0.0 AS v FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY abs(v) DESC, src DESC) = 1")
def q_spectral_fold(spark, sf_dir):
    return G.spectral_fold(_sources(spark, sf_dir), ["k"], "max").select("k", (F.round("v", 6) + 0.0).alias("v"))


@query(f"WITH s AS ({_ONE}) SELECT k, round(sum(v) / 7, 6) + 0.0 AS v FROM s GROUP BY k")
def q_padded_average(spark, sf_dir):
    return G.padded_average(_sources(spark, sf_dir), ["k"], 7).select("k", (F.round("v", 6) + 0.0).alias("v"))


@query(
    f"WITH s AS (SELECT track // 4 AS track, track % 4 AS src, i, v FROM ({_SAMPLES})), n AS (SELECT DISTINCT track, i FROM s), t AS (SELECT track, i, ntile(7) OVER (PARTITION BY track ORDER BY i) - 1 AS part FROM n), "
    "m AS (SELECT s.track, part, src, avg(abs(v)) AS m FROM s JOIN t ON s.track = t.track AND s.i = t.i GROUP BY ALL) SELECT track, part::INT AS part, src FROM m QUALIFY row_number() OVER (PARTITION BY track, part ORDER BY m, src) = 1"
)
def q_segment_argmin(spark, sf_dir):
    s = _samples(spark, sf_dir).select(F.floor(F.col("track") / 4).alias("track"), (F.col("track") % 4).alias("src"), "i", "v")
    return G.quietest_parts(s, 7)


@query(
    f"WITH s AS ({_SAMPLES}), c AS (SELECT track, i, v, unnest(range(greatest(ceil((i - 31) / 8.0)::BIGINT, 0), i // 8 + 1)) AS c FROM s) SELECT track, i, round(sum((1 + i - c * 8) * (0.5 * v)) / sum(1 + i - c * 8), 6) + 0.0 AS v FROM c GROUP BY track, i"
)
def q_overlap_add(spark, sf_dir):
    found = G.overlap_add(_samples(spark, sf_dir), 32, 8, 1 + F.col("place"), 0.5 * F.col("v"))
    return found.select("track", "i", (F.round("v", 6) + 0.0).alias("v"))


def _bounds(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select((F.col("event_id") % 6).alias("track"), F.col("event_id").alias("i"), F.when(F.col("event_id") % 12 < 6, F.col("value") / 200).otherwise(0.0).alias("bound"))


@query(
    "WITH b AS (SELECT event_id % 6 AS track, event_id AS i, CASE WHEN event_id % 12 < 6 THEN value / 200 ELSE 0.0 END AS bound FROM events), s AS (SELECT *, round_even(round(sum(bound) OVER (PARTITION BY track ORDER BY i), 9), 0)::BIGINT AS step FROM b), "
    "r AS (SELECT *, CASE WHEN step - coalesce(lag(step) OVER (PARTITION BY track ORDER BY i), -1) > 0 THEN 1 ELSE 0 END AS rise FROM s) SELECT track, i, sum(rise) OVER (PARTITION BY track ORDER BY i)::BIGINT AS item FROM r"
)
def q_note_bounds(spark, sf_dir):
    return G.note_bounds(_bounds(spark, sf_dir), ["track"], "i", "bound").select("track", "i", "item")


@query(
    "WITH f AS (SELECT event_id % 6 AS track, event_id // 60 AS item, 40 + value / 20 AS v, event_id % 7 > 0 AS mask FROM events), q AS (SELECT track, item, round_even(v, 0)::BIGINT AS q, count(*) AS n FROM f WHERE mask GROUP BY ALL), m AS (SELECT track, item, q FROM q QUALIFY row_number() OVER (PARTITION BY track, item ORDER BY n DESC, q) = 1), "
    "a AS (SELECT f.track, f.item, avg(v) AS value FROM f JOIN m ON f.track = m.track AND f.item = m.item WHERE mask AND v BETWEEN q - 0.5 AND q + 0.5 GROUP BY ALL), c AS (SELECT track, item, count(*)::BIGINT AS frames, avg(mask::INT) >= 0.5 AS unmasked FROM f GROUP BY ALL) "
    "SELECT c.track, c.item, round(coalesce(value, 0.0), 6) AS value, frames, unmasked FROM c LEFT JOIN a ON c.track = a.track AND c.item = a.item"
)
def q_note_values(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    f = e.select((F.col("event_id") % 6).alias("track"), F.floor(F.col("event_id") / 60).alias("item"), (40 + F.col("value") / 20).alias("v"), (F.col("event_id") % 7 > 0).alias("mask"))
    return G.note_values(f, ["track"]).select("track", "item", F.round("value", 6).alias("value"), "frames", "unmasked")


@query(
    "WITH n AS (SELECT event_id % 6 AS track, event_id // 120 AS chunk, event_id AS i, value / 100 AS dur, event_id // 120 * 1.5 AS offs, event_id % 5 = 0 AS rest FROM events), t AS (SELECT *, round_even(offs * 960, 0)::BIGINT AS b, round_even(round(sum(dur) OVER (PARTITION BY track, chunk ORDER BY i) * 960, 6), 0)::BIGINT AS rel FROM n), "
    "u AS (SELECT *, coalesce(lag(rel) OVER (PARTITION BY track, chunk ORDER BY i), 0) AS f FROM t), c AS (SELECT DISTINCT track, chunk, b FROM t), d AS (SELECT track, chunk, lead(b) OVER (PARTITION BY track ORDER BY chunk) AS cut FROM c), "
    "p AS (SELECT u.track, u.chunk, u.i, rest, least(u.b + f, coalesce(cut, u.b + f)) AS start, least(u.b + rel, coalesce(cut, u.b + rel)) AS \"end\" FROM u JOIN d ON u.track = d.track AND u.chunk = d.chunk), h AS (SELECT * FROM p WHERE start < \"end\" AND NOT rest) "
    "SELECT track, chunk, i, start, \"end\", start - coalesce(lag(\"end\") OVER (PARTITION BY track ORDER BY chunk, i), 0) AS delta FROM h"
)
def q_note_ticks(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    chunk = F.floor(F.col("event_id") / 120)
    n = e.select((F.col("event_id") % 6).alias("track"), chunk.alias("chunk"), F.col("event_id").alias("i"), (F.col("value") / 100).alias("dur"), (chunk * 1.5).alias("offs"), (F.col("event_id") % 5 == 0).alias("rest"))
    return G.note_ticks(n, ["track", "chunk"], "i", "dur", "offs", "rest").select("track", "chunk", "i", "start", "end", "delta")


@query(
    "WITH f AS (SELECT event_id % 6 AS track, event_id AS i, CASE WHEN event_id % 30 < 12 THEN 0.0 ELSE 50 + value END AS f FROM events), v AS (SELECT *, max(CASE WHEN f > 0 THEN i END) OVER (PARTITION BY track ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a, min(CASE WHEN f > 0 THEN i END) OVER (PARTITION BY track ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM f) "
    "SELECT v.track, v.i, round(power(2, CASE WHEN v.a IS NULL THEN log2(y.f) WHEN v.b IS NULL THEN log2(x.f) ELSE log2(x.f) + (log2(y.f) - log2(x.f)) * (v.i - v.a) / greatest(v.b - v.a, 1) END), 6) AS f0 FROM v LEFT JOIN f x ON v.track = x.track AND v.a = x.i LEFT JOIN f y ON v.track = y.track AND v.b = y.i"
)
def q_f0_interp(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    f = e.select((F.col("event_id") % 6).alias("track"), F.col("event_id").alias("i"), F.when(F.col("event_id") % 30 < 12, 0.0).otherwise(50 + F.col("value")).alias("f0"))
    return G.interpolate_pitch(f, ["track"], "i", "f0").select("track", "i", F.round("f0", 6).alias("f0"))


@query()
def q_batch_by_size(spark, sf_dir):
    return G.batch_by_size(table(spark, sf_dir, "documents"), "doc_id", "n_chars", 200_000, 48, 8)


@query("SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM orders) WHERE best IS NULL OR o_totalprice > best")
def q_best_so_far(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("_t", F.struct("o_orderdate", "o_orderkey"))
    return G.best_so_far(o, ["o_custkey"], "_t", "o_totalprice").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
