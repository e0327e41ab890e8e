"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Each document is repeated n times, n drawn by inverting the Poisson distribution whose mean is its source's target
repetition rate, at a uniform number hashed from seed and doc_id.  Copies then get a hashed key, are dealt by it and
sorted by it inside each partition: a global shuffle in which no partition depends on a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.llm.common import numbered, only_new, small, table

SEED = 20_231
#: Target weights follow count ** TEMPERATURE when none are given.
TEMPERATURE = 0.5
#: Probabilities that count as one row when the table of distributions is tried for broadcast: 2,000,000 of them at most, 16 MB.
ENTRIES = 10


def _uniform(*parts: Column) -> Column:
    """(0, 1), from the first 52 bits of an MD5."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, source: str = "source") -> DataFrame:
    """(source, rate): documents wanted of a source over those there, the mixture as large as the input.  A source that `weights` leaves out gets rate 0."""
    counts = docs.groupBy(F.col(source).alias("_vx_source")).agg(F.count(F.lit(1)).alias("_vx_n"))
    if weights is None:
        wanted = F.pow(F.col("_vx_n").cast("double"), F.lit(temperature))
    else:
        wanted = F.lit(0.0)
        for name, weight in weights.items():
            wanted = F.when(F.col("_vx_source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(wanted)
    weighed = counts.withColumn("_vx_w", wanted)
    total = weighed.agg(F.sum("_vx_n"), F.sum(F.round("_vx_w", 9).cast("decimal(30,9)")).cast("double")).first()
    n, w = (total[0] or 0), (total[1] or 0.0)
    return weighed.select("_vx_source", (F.col("_vx_w") * F.lit(float(n)) / F.lit(w or 1.0) / F.col("_vx_n")).alias("rate"))


def distributions(rate: DataFrame) -> DataFrame:
    """(source, rate, cdf): the cumulative Poisson probabilities of 0, 1, ... as an array that reaches 12 deviations above the mean."""
    top = (F.col("rate") + 12 * F.sqrt("rate") + 30).cast("long")
    steps = rate.select("_vx_source", "rate", F.explode(F.sequence(F.lit(0).cast("long"), top)).alias("k"))
    so_far = Window.partitionBy("_vx_source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(so_far)
    log_mean = F.log(F.when(F.col("rate") > 0, F.col("rate")).otherwise(F.lit(1.0)))
    p = F.when(F.col("rate") > 0, F.exp(F.col("k") * log_mean - F.col("rate") - log_factorial)).otherwise((F.col("k") == 0).cast("double"))
    cdf = steps.withColumn("p", p).withColumn("cdf", F.sum("p").over(so_far))
    return cdf.groupBy("_vx_source", "rate").agg(F.array_sort(F.collect_list("cdf")).alias("_vx_cdf"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, seed: int = SEED, source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mixture: all columns of `docs` and rate double, copies long, copy long (from 1), shuffle_key string.

    A null source is a source of its own.  Rows without a key draw by their number among equal rows and, told apart by
    nothing but their other columns, by a hash of these; repeated rows with a key draw alike, as do ties.  Text of any
    length is only carried, or hashed where there is no key; an empty table gives an empty result.  Input columns named
    like the four new ones are replaced.
    """
    docs = only_new(docs, "rate", "copies", "copy", "shuffle_key", "_vx_ordinal")
    rate = rates(docs, weights, temperature, source)
    dist = distributions(rate)
    entries = rate.agg(F.sum(F.col("rate") + 12 * F.sqrt("rate") + 31)).first()[0] or 0
    dist = small(dist, int(entries) // ENTRIES)
    rest = [F.coalesce(F.col(c).cast("string"), F.lit("")) if kind != "string" else F.coalesce(c, F.lit("")) for c, kind in docs.dtypes if c != key and kind in ("string", "bigint", "int", "double", "boolean", "date")]
    ident = F.coalesce(F.col(key).cast("string"), F.concat_ws("/", F.lit("null"), F.md5(F.concat_ws("/", *rest)), F.col("_vx_ordinal").cast("string")))
    numbered_docs = numbered(docs, key)
    joined = numbered_docs.join(dist, numbered_docs[source].eqNullSafe(dist["_vx_source"]))
    draw = _uniform(F.lit(str(seed)), ident)
    counted = joined.withColumn("_vx_u", draw).withColumn("copies", F.size(F.filter("_vx_cdf", lambda c: c < F.col("_vx_u"))).cast("long"))
    copies = counted.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(str(seed)), ident, F.col("copy").cast("string"))))
    return keyed.select(*docs.columns, "rate", "copies", "copy", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the whole mixture of `documents`, texts included."""
    return mix(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


ORACLE_SQL = f"""
WITH n AS (SELECT source, count(*) AS n, power(count(*)::DOUBLE, {TEMPERATURE}) AS w FROM documents GROUP BY source),
t AS (SELECT sum(n)::DOUBLE AS n, sum(round(w, 9)::DECIMAL(30,9))::DOUBLE AS w FROM n),
r AS (SELECT n.source, n.w * t.n / t.w / n.n AS rate FROM n, t),
k AS (SELECT source, rate, unnest(range(0, floor(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM r),
f AS (SELECT source, rate, k, sum(ln(greatest(k, 1)::DOUBLE)) OVER (PARTITION BY source ORDER BY k) AS lf FROM k),
c AS (SELECT source, rate, k, sum(exp(k * ln(rate) - rate - lf)) OVER (PARTITION BY source ORDER BY k) AS cdf FROM f),
a AS (SELECT source, rate, list(cdf ORDER BY k) AS cdf FROM c GROUP BY source, rate),
i AS (SELECT *, coalesce(doc_id::VARCHAR, 'null/' || md5(coalesce(text, '') || '/' || coalesce(lang, '') || '/' || coalesce(source, '') || '/' || coalesce(n_chars::VARCHAR, '')) || '/' || row_number() OVER (PARTITION BY doc_id, text, lang, source, n_chars)) AS ident FROM documents),
u AS (SELECT d.*, a.rate, a.cdf, (('0x' || substr(md5('{SEED}|' || ident), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
      FROM i d JOIN a ON d.source IS NOT DISTINCT FROM a.source),
m AS (SELECT *, len(list_filter(cdf, lambda c: c < u))::BIGINT AS copies FROM u),
e AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM m)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, copies, copy,
       md5('{SEED}|' || ident || '|' || copy::VARCHAR) AS shuffle_key
FROM e
"""
