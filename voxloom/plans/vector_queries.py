"""Catalogue queries on embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import vectors as V
from voxloom.plans.registry import query, table

#: Gate of the catalogue: at the default of 0.2 every stand-in vector would be noise.
GATE = 0.35

_UNIT = "SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS u FROM embeddings"
_LONG = f"u AS ({_UNIT}), l AS (SELECT vec_id, label, generate_subscripts(u, 1) AS i, unnest(u) AS x FROM u)"
_MEANS = f"{_LONG}, m AS (SELECT label, i, avg(x) AS m, count(*) AS n FROM l GROUP BY label, i), c AS (SELECT label, i, n, m, m / sqrt(sum(m * m) OVER (PARTITION BY label)) AS c FROM m)"


def _rows(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


@query(f"WITH {_LONG} SELECT vec_id, round(sqrt(sum(x * x)), 6) AS norm, round(min(x), 6) + 0.0 AS low, round(max(x), 6) + 0.0 AS high FROM l GROUP BY vec_id")
def q_l2_norm(spark, sf_dir):
    u = _rows(spark, sf_dir).select("vec_id", V.unit(F.col("embedding")).alias("u"))
    return u.select("vec_id", F.round(V.norm(F.col("u")), 6).alias("norm"), (F.round(F.array_min("u"), 6) + 0.0).alias("low"), (F.round(F.array_max("u"), 6) + 0.0).alias("high"))


@query(f"WITH u AS ({_UNIT}) SELECT a.vec_id, b.vec_id AS other, round(list_sum(list_transform(range(1, 65), lambda i: a.u[i] * b.u[i])), 6) + 0.0 AS similarity FROM u a, u b WHERE a.vec_id % 50 = 0")
def q_cosine_pairs(spark, sf_dir):
    e = _rows(spark, sf_dir)
    return V.blocked_similarity(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", digits=6)


@query(f"WITH {_MEANS} SELECT vec_id, l.label, round((1 - least(greatest(sum(x * c), -1.0), 1.0)) / 2, 5) AS distance FROM l JOIN c ON l.label = c.label AND l.i = c.i GROUP BY vec_id, l.label")
def q_half_cosine(spark, sf_dir):
    """Every vector's half-cosine distance to the centroid of its label."""
    rows = _rows(spark, sf_dir)
    means = V.centroids(rows, "label").select("label", "centroid")
    u = rows.select("vec_id", "label", V.unit(F.col("embedding")).alias("u")).where("u is not null")
    return u.join(means, "label").select("vec_id", "label", F.round(V.half_cosine(V.dot(F.col("u"), F.col("centroid"))), 5).alias("distance"))


@query(f"WITH {_MEANS} SELECT label, i::INT AS i, n::BIGINT AS n, round(m, 6) + 0.0 AS mean, round(c, 6) + 0.0 AS centroid FROM c")
def q_centroids(spark, sf_dir):
    c = V.centroids(_rows(spark, sf_dir), "label")
    long = c.select("label", "n", F.posexplode(F.arrays_zip("mean_vec", "centroid")).alias("i", "z"))
    return long.select("label", (F.col("i") + 1).cast("int").alias("i"), "n", (F.round("z.mean_vec", 6) + 0.0).alias("mean"), (F.round("z.centroid", 6) + 0.0).alias("centroid"))


_PAIRS = (
    f"WITH {_MEANS}, p AS (SELECT a.label AS target, b.label AS label, sum(a.c * b.c) AS near, sum(a.m * b.m) AS score FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY a.label, b.label), "
    "s AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY target ORDER BY near DESC, label::VARCHAR) <= 8), r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY score DESC, label::VARCHAR) AS place FROM s)"
)


def _recommended(spark, sf_dir):
    c = V.centroids(_rows(spark, sf_dir).select(F.col("label").cast("string").alias("cluster_dir"), "embedding")).cache()
    return V.recommend(c, c)


@query(
    f"{_PAIRS}, b AS (SELECT a.target, a.label, a.score, a.score - n.score AS gap FROM r a LEFT JOIN r n ON a.target = n.target AND n.place = 2 WHERE a.place = 1) "
    "SELECT target::VARCHAR AS target, label::VARCHAR AS label, round(score, 6) AS score, round(gap, 6) AS gap, score < 0.35 OR coalesce(gap < 0.03, false) AS warning FROM b"
)
def q_recommend(spark, sf_dir):
    return _recommended(spark, sf_dir).select("target", "label", F.round("score", 6).alias("score"), F.round("gap", 6).alias("gap"), "warning")


@query(
    f"{_PAIRS}, b AS (SELECT a.target, a.score, a.score - n.score AS gap FROM r a LEFT JOIN r n ON a.target = n.target AND n.place = 2 WHERE a.place = 1) "
    "SELECT target::VARCHAR AS target, concat_ws(' / ', CASE WHEN score < 0.35 THEN printf('top1=%.4f < 0.35', score) END, CASE WHEN gap < 0.03 THEN printf('top1-top2=%.4f < 0.03', gap) END) AS reason FROM b"
)
def q_confidence(spark, sf_dir):
    return _recommended(spark, sf_dir).select("target", "reason")


@query(f"{_PAIRS} SELECT target::VARCHAR AS target, place::INT AS place, label::VARCHAR AS label, round(score, 6) AS score FROM r WHERE place <= 3")
def q_label_scores(spark, sf_dir):
    r = _recommended(spark, sf_dir).select("target", F.posexplode("candidates").alias("place", "c"))
    return r.select("target", (F.col("place") + 1).cast("int").alias("place"), "c.label", F.round("c.score", 6).alias("score"))


@query(f"{_PAIRS} SELECT target::VARCHAR AS target, string_agg(place || '. ' || label || ' (' || printf('%.4f', score) || ')', chr(10) ORDER BY place) AS shown FROM r WHERE place <= 3 GROUP BY target")
def q_candidate_list(spark, sf_dir):
    return _recommended(spark, sf_dir).select("target", V.render_candidates(F.col("candidates")).alias("shown"))


@query(
    f"WITH {_MEANS}, d AS (SELECT l.vec_id, l.label, sum(l.x * c.c) AS s FROM l JOIN c ON l.label = c.label AND l.i = c.i WHERE l.vec_id % 9 > 0 GROUP BY l.vec_id, l.label), "
    "q AS (SELECT label, i, avg(x) AS m FROM l WHERE vec_id % 9 > 0 GROUP BY label, i), q2 AS (SELECT label, i, m / sqrt(sum(m * m) OVER (PARTITION BY label)) AS c FROM q), d2 AS (SELECT l.vec_id, sum(l.x * q2.c) AS s FROM l JOIN q2 ON l.label = q2.label AND l.i = q2.i WHERE l.vec_id % 9 > 0 GROUP BY l.vec_id) "
    "SELECT label, vec_id, round(coalesce(s, -2.0), 6)::DOUBLE AS score, place::INT AS place FROM (SELECT e.label, e.vec_id, d2.s, row_number() OVER (PARTITION BY e.label ORDER BY coalesce(d2.s, -2.0) DESC, e.vec_id % 13 DESC, e.vec_id) AS place FROM embeddings e LEFT JOIN d2 ON e.vec_id = d2.vec_id) WHERE place <= 5"
)
def q_representatives(spark, sf_dir):
    e = _rows(spark, sf_dir).select("label", "vec_id", F.when(F.col("vec_id") % 9 > 0, F.col("embedding")).alias("embedding"), (F.col("vec_id") % 13).alias("duration"))
    return V.representatives(e, 5, "label", "vec_id").select("label", "vec_id", F.round("score", 6).alias("score"), F.col("place").cast("int").alias("place"))


@query(
    "WITH o AS (SELECT vec_id FROM embeddings WHERE vec_id % 3 > 0), n AS (SELECT vec_id FROM embeddings WHERE vec_id % 2 = 0) SELECT CASE WHEN o.vec_id IS NULL THEN 'added' WHEN n.vec_id IS NULL THEN 'kept' ELSE 'updated' END AS status, count(*)::BIGINT AS n FROM o FULL JOIN n ON o.vec_id = n.vec_id GROUP BY ALL"
)
def q_vector_upsert(spark, sf_dir):
    e = _rows(spark, sf_dir)
    return V.upsert_store(e.where("vec_id % 3 > 0"), e.where("vec_id % 2 = 0"), True, "vec_id").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _seeds(spark, sf_dir):
    """A centre a label; labels whose vectors cancel out have none."""
    return [(r["label"], r["centroid"]) for r in V.centroids(_rows(spark, sf_dir), "label").select("label", "centroid").where("centroid is not null").collect()]


_STEP = f"WITH {_MEANS}, s AS (SELECT l.vec_id, c.label, sum(l.x * c.c) AS s FROM l JOIN c ON l.i = c.i GROUP BY l.vec_id, c.label), b AS (SELECT vec_id, label, s FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) = 1)"


@query(f"{_STEP}, q AS (SELECT b.label, l.i, avg(l.x) AS m, count(*) AS n FROM l JOIN b ON l.vec_id = b.vec_id GROUP BY b.label, l.i) SELECT label::INT AS label, i::INT AS i, n::BIGINT AS n, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 6) + 0.0 AS centroid FROM q")
def q_kmeans_step(spark, sf_dir):
    found = V.kmeans_step(_rows(spark, sf_dir), _seeds(spark, sf_dir))
    long = found.select("label", "n", F.posexplode("centroid").alias("i", "x"))
    return long.select("label", (F.col("i") + 1).cast("int").alias("i"), "n", (F.round("x", 6) + 0.0).alias("centroid"))


@query(f"{_STEP} SELECT vec_id, CASE WHEN (1 - least(greatest(s, -1.0), 1.0)) / 2 > {GATE} THEN -1 ELSE label END::INT AS label FROM b")
def q_noise_gate(spark, sf_dir):
    return V.noise_gate(V.assign(_rows(spark, sf_dir), _seeds(spark, sf_dir)), GATE).select("vec_id", "label")


@query()
def q_kmeans_full(spark, sf_dir):
    assigned, _ = V.spherical_kmeans(_rows(spark, sf_dir), _seeds(spark, sf_dir))
    return assigned.select("vec_id", "label", F.round("similarity", 6).alias("similarity"))


@query()
def q_hdbscan(spark, sf_dir):
    return V.hdbscan(_rows(spark, sf_dir))


@query()
def q_recluster(spark, sf_dir):
    return V.recluster(_rows(spark, sf_dir), gate=GATE).withColumn("cluster_dir", V.cluster_name(F.col("label")))


@query(f"WITH {_LONG}, a AS (SELECT vec_id, i // 2 AS pair, x FROM l WHERE i % 2 = 1), b AS (SELECT vec_id, i // 2 - 1 AS pair, x FROM l WHERE i % 2 = 0) SELECT a.vec_id, a.pair::INT AS pair, round((0.8 * a.x + 0.2 * b.x + 0.8 * a.x + 0.2 * b.x + 0.8 * a.x + 0.2 * b.x) / 3, 6) + 0.0 AS \"left\", round((0.8 * b.x + 0.2 * a.x + 0.8 * b.x + 0.2 * a.x + 0.8 * b.x + 0.2 * a.x) / 3, 6) + 0.0 AS \"right\" FROM a JOIN b ON a.vec_id = b.vec_id AND a.pair = b.pair")
def q_tta_average(spark, sf_dir):
    from voxloom.operators.signal import test_time_average

    long = _rows(spark, sf_dir).select("vec_id", F.posexplode(V.unit(F.col("embedding"))).alias("i", "x")).withColumn("pair", F.floor(F.col("i") / 2).cast("int"))
    u = long.groupBy("vec_id", "pair").agg(F.max(F.when(F.col("i") % 2 == 0, F.col("x"))).alias("left"), F.max(F.when(F.col("i") % 2 == 1, F.col("x"))).alias("right"))
    u = u.withColumn("row", F.concat_ws("/", "vec_id", "pair"))
    found = test_time_average(u, "row", "left", "right", lambda a, b: (0.8 * a + 0.2 * b, 0.8 * b + 0.2 * a))
    found = found.select(F.split("row", "/")[0].cast("long").alias("vec_id"), F.split("row", "/")[1].cast("int").alias("pair"), "left", "right")
    return found.select("vec_id", "pair", (F.round("left", 6) + 0.0).alias("left"), (F.round("right", 6) + 0.0).alias("right"))
