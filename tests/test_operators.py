"""Fixtures of the operators: hand-solved cases."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxloom.functions import numeric as N
from voxloom.functions import text as X
from voxloom.operators import labelling as B
from voxloom.operators import losses as L
from voxloom.operators import manifest as M
from voxloom.operators import segments as S
from voxloom.operators import signal as G
from voxloom.operators import spectral as SP
from voxloom.operators import training as T
from voxloom.operators import vectors as V
from voxloom.plans import pipeline as P
from voxloom.sources import files, subtitles


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def col(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_clean_text(spark):
    cases = {
        r"a\Nb\nc": "a b c", "x<br/>y": "x y", "<i><b>t</b></i>": "t", r"{\an8}up": "up", "a&nbsp;b": "a b", "&amp;lt;": "&lt;", "a b　c": "a b c", "a\r\nb": "a b", "<i> </i>": "",
    }
    df = spark.createDataFrame(list(cases.items()), "raw string, want string")
    for r in df.select("raw", "want", X.clean_text(F.col("raw")).alias("a"), X.clean_text_full(F.col("raw")).alias("b")).collect():
        assert r.a == r.want and r.b == r.want, r.raw


def test_times(spark):
    r = one(spark, *[X.srt_seconds(F.lit(x)) for x in ("0:00:01,5", "0:00:01,05", "0:01:01.005")], X.ass_seconds(F.lit("1:00:01.50x")), X.ass_seconds(F.lit("0:00:01")), X.ass_seconds(F.lit(None).cast("string")))
    assert list(r) == pytest.approx([1.5, 1.05, 61.005, 3601.5, 0.0, 0.0])


def test_label_names(spark):
    for name, ok in (("   ", False), ("noise", False), ("clustering_12", False), ("a/b", False), ("  오카베 린타로  ", True)):
        assert one(spark, X.label_check(F.lit(name)))[0].ok is ok
    assert one(spark, X.label_check(F.lit("  오카베 린타로  ")))[0].clean == "오카베 린타로"


ASS = "[Events]\nDialogue: 0,0:00:01.00,0:00:02.00,Default,,0,0,0,,line1, with comma\nDialogue: 0,0:00:03.00,0:00:02.00,Default,,0,0,0,,backwards\n"
SRT = "1\n00:00:01,000 --> 00:00:02,000\nhello\nthere\n\n2\n00:00:03,000 --> 00:00:04,500\n<i>you</i>\n"
SMI = "<SAMI><BODY>\n<SYNC Start=1000><P Class=KRCC>안녕\n<SYNC Start=2500><P Class=KRCC>&nbsp;\n<SYNC Start=4000><P Class=KRCC>a\n<SYNC Start=4000><P>b\n"


def test_subtitles(spark):
    df = spark.createDataFrame([("ep01.ass", ASS), ("ep01.smi", SMI), ("ep02.srt", SRT), ("ep03.smi", SMI)], "name string, text string")
    found = col(subtitles.parse(df), "base", "format", "start", "end", "text")
    assert ("ep01", "ass", 1.0, 2.0, "line1, with comma") in found and len([f for f in found if f[1] == "ass"]) == 1
    assert [f[2:] for f in found if f[1] == "srt"] == [(1.0, 2.0, "hello there"), (3.0, 4.5, "you")]
    assert [f[2:] for f in found if f[:2] == ("ep03", "smi")] == [(1.0, 2.5, "안녕")]
    assert col(M.subtitle_variants(df), "base", "format") == [("ep01", "ass"), ("ep02", "srt"), ("ep03", "smi")]
    audio = spark.createDataFrame([("ep01.wav",), ("ep02.wav",)], "name string")
    made = P.subtitle_slices(df, audio)
    assert col(made, "filename", "index", "timestamp_start") == [("ep01__000000.wav", "0", "1.000000"), ("ep02__000001.wav", "1", "1.000000"), ("ep02__000002.wav", "2", "3.000000")]
    assert col(P.missing_audio(df, audio), "base") == [("ep03",)]
    assert col(subtitles.shift(subtitles.parse(df).where("base = 'ep03'"), -1500), "start", "end") == [(0.0, 1.0)]


def test_subtitle_details(spark):
    ass = "[Events]\nDialogue: 0,0:00:01.00,0:00:02.00, Red ,\tBob ,0,0,0,,c"
    found = subtitles.parse_ass(spark.createDataFrame([("a", ass)], "base string, text string"))
    assert col(found, "style", "actor", "text") == [("Red", "Bob", "c")]
    assert tuple(one(spark, X.clean_text(F.lit("a<i\nx>b")), X.clean_text_full(F.lit("a<i\nx>b{\\an8}&amp;lt;")))) == ("a b", "a b&lt;")
    plain = spark.createDataFrame([("a", "Dialogue: 0,0:00:01.00,0:00:02.00,,,0,0,0,,x")], "base string, text string")
    assert col(subtitles.parse_ass(plain), "style") == [("Default",)]
    srt = "1\n0:0:1,000 --> 0:00:02,000\nbad\n\n2\n 0:00:01,000 --> 0:00:02,5 x\n good <b\n>text\n\n3\n--> 0:00:01,000\nbad"
    assert col(subtitles.parse_srt(spark.createDataFrame([("a", srt)], "base string, text string")), "text", "end") == [("good text", 2.5)]
    smi = "<SAMI><SYNC id=a\nStart = 1000><P Lang=x Class='KR'>one<SYNC Start=2000><SYNC Start=x><P>y"
    assert col(subtitles.parse_smi(spark.createDataFrame([("a", smi)], "base string, text string")), "start", "end", "style", "text") == [(1.0, 2.0, "KR", "one")]
    sniff = spark.createDataFrame([("1:2:3,4 -->", None), ("01:02:03.4 -->", "srt"), ("x", None)], "text string, want string")
    assert sniff.where(X.subtitle_format(F.col("text")).eqNullSafe(F.col("want"))).count() == 3
    names = spark.createDataFrame([("\tnoise\n", True), ("\u3000Noise ", True), ("noisy", False), (None, False)], "c string, want boolean")
    assert names.where(X.is_noise(F.col("c")) == F.col("want")).count() == 4


def test_slice_numbers(spark):
    """Over a million rows all names differ, and numbers go on in order of the bases."""
    many = spark.range(1_000_003).select(F.concat(F.lit("b"), (F.col("id") % 3).cast("string")).alias("base"), F.col("id").alias("seq"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), F.lit("").alias("actor"), F.lit("Default").alias("style"), F.lit("x").alias("text"))
    found = subtitles.slice_manifest(many)
    assert found.select("filename").distinct().count() == 1_000_003
    assert found.agg(F.max(F.col("index").cast("long"))).first()[0] == 1_000_002
    few = spark.createDataFrame([(b, i) for b in [f"n{k % 300:03d}" for k in range(700)] + [None] for i in range(2)], "base string, seq int").select("base", "seq", *[F.lit(v).alias(c) for c, v in (("start", 0.0), ("end", 1.0), ("actor", ""), ("style", ""), ("text", "t"))])
    rows = few.where("base is not null").withColumn("seq", F.monotonically_increasing_id())
    names = [r.filename for r in subtitles.slice_manifest(rows).orderBy(F.col("index").cast("int")).collect()]
    assert names == sorted(names) and len(set(names)) == 1400


def test_long_tracks_are_interpolated_in_proportion(spark):
    rows = spark.range(80_000).select(F.lit(0).alias("track"), "id", F.when(F.col("id") % 1000 == 0, 100.0).otherwise(0.0).alias("f0"))
    found = G.interpolate_pitch(rows, ["track"], "id", "f0")
    assert found.where("abs(f0 - 100) > 1e-9").count() == 0


def test_adaptive_filter_edge(spark):
    rows = [("a", "Default", "x")] * 80 + [("a", "Red", "x"), ("b", "Red", "x"), ("b", "Blue", "♪"), ("b", "Blue", "x")] + [("c", "Default", "x")] * 79
    found = S.adaptive_filter(spark.createDataFrame(rows, "base string, style string, text string")).groupBy("base", "mode").count()
    assert col(found, "base", "mode", "count") == [("a", "phase1", 80), ("b", "phase2", 1), ("c", "phase2", 79)]


def test_labelling_session(spark):
    pending = spark.createDataFrame([(0, "clustering_1", "amy"), (1, " ", "x"), (2, "clustering_2", "bob")], "seq long, source_cluster string, target_label string")
    current = spark.createDataFrame([(9, "clustering_1", " ", "eve"), (10, "clustering_3", "zoe", "eve")], "seq long, source_cluster string, manual_label string, recommended_label string")
    now = B.accept(pending, current)
    assert col(now, "source_cluster", "target_label") == [("clustering_1", "eve"), ("clustering_2", "bob"), ("clustering_3", "zoe")]
    files_ = spark.createDataFrame([("a", "clustering_1", 1.0), ("b", "clustering_1", 1.0), ("a", "clustering_2", 2.0), ("a", "eve", 9.0), ("c", "noise", 1.0)], "filename string, cluster_dir string, mtime double")
    assert col(B.confirm(files_, now), "filename", "cluster_dir", "mtime") == [("a", "bob", 2.0), ("a", "eve", 1.0), ("b", "eve", 1.0), ("c", "noise", 1.0)]
    bad = pending.withColumn("target_label", F.lit("clustering_9"))
    assert col(B.invalid(bad.where("seq = 0")), "reason") == [("reserved",)]
    with pytest.raises(ValueError, match="reserved"):
        B.confirm(files_, bad)
    assert B.confirm(files_.limit(0), now).count() == 0
    ordered = spark.createDataFrame([("clustering_4", 5, 1), ("clustering_5", 3, 2), ("clustering_6", 0, 3)], "cluster_dir string, n long, place int")
    none = ordered.select("cluster_dir").limit(0)
    assert tuple(B.pick(ordered, none, none, "clustering_5", True).first()) == ("clustering_5", 2)
    assert tuple(B.pick(ordered, none, none, "clustering_5").first()) == ("clustering_4", 2)
    assert tuple(B.pick(ordered, ordered.select("cluster_dir"), none).first()) == ("", 0)
    rows = spark.createDataFrame([("clustering_1", [1.0, 0.0]), ("amy", [1.0, 0.1]), ("bob", [0.0, 1.0])], "cluster_dir string, embedding array<double>")
    choices = spark.createDataFrame([("amy",), ("bob",)], "label string")
    found = B.recommend_all(spark.createDataFrame([("clustering_1",), ("clustering_2",)], "cluster_dir string"), V.centroids(rows), choices)
    assert col(found, "target", "label", "warning") == [("clustering_1", "amy", False), ("clustering_2", "", True)]
    only = spark.createDataFrame([("carl",)], "label string")
    assert col(B.recommend_all(rows.where("cluster_dir = 'clustering_1'"), V.centroids(rows), only), "label", "reason") == [("", B.NO_VALID_LABEL)]


def test_losses_and_chunks(spark):
    rows = spark.createDataFrame([("a", 1.0, 1.0), ("a", -1.0, -1.0), ("b", 1.0, 2.0), ("b", -1.0, -2.0)], "k string, r double, e double")
    assert [round(r.loss, 3) for r in L.negative_sdr(rows, ["k"], "r", "e").orderBy("k").collect()] == [-83.01, -89.031]  # 2 and 8 over 1e-8
    assert [round(r.loss, 2) for r in L.p_norm_ratio(rows, ["k"], "r", "e", log=False).orderBy("k").collect()] == [0.0, 1.0]
    with pytest.raises(ValueError):
        L.metric_values(rows, ["k"], "r", "e", ["nope"])
    odd = spark.createDataFrame([("a", 1.0), ("a", float("inf")), ("a", float("nan")), ("b", None)], "k string, v double")
    assert [str(r.v) for r in L.safe_mean(odd, ["k"], "v").orderBy("k").collect()] == ["1.0", "nan"]
    n = spark.range(200).select(T.chunk_offset(1, F.col("id"), F.lit(50), 20).alias("o"), T.chunk_offset(1, F.col("id"), F.lit(5), 20).alias("z"))
    assert n.agg(F.min("o"), F.max("o"), F.max("z")).first() == (0, 30, 0) and n.select("o").distinct().count() == 31
    rest = [0.0] * 128 + [1.0]
    note = [0.0] * 60 + [1.0] + [0.0] * 68
    frames = spark.createDataFrame([(0, rest, True), (1, note, True), (2, note, False)], "i int, p array<double>, m boolean").select("i", SP.quantised_frame(F.col("p"), F.col("m")).alias("f"))
    assert col(frames.select("i", "f.v", "f.mask"), "i", "v", "mask") == [(0, 127.0, False), (1, 60.0, True), (2, 60.0, False)]
    assert T.loud_enough(F.array().cast("array<double>"), 0.0) is not None and spark.range(1).select(T.loud_enough(F.lit(None).cast("array<double>"), 0.0)).first()[0] is False


def test_media_jobs(spark):
    jobs = M.media_jobs(spark.createDataFrame([("a.mkv",), ("a.mp4",), ("b.mkv",), ("c.txt",)], "name string"))
    assert col(jobs.where("accepted"), "input") == [("a.mkv",), ("b.mkv",)]
    assert col(jobs.where("not accepted"), "input", "previous_input") == [("a.mp4", "a.mkv")]


def test_manifest(spark):
    meta = spark.createDataFrame([("ep01.wav", "0", "1.0", "2.0", "hi"), ("ep02.wav", "1", "2.0", "3.0", "ho")], "filename string, index string, timestamp_start string, timestamp_end string, transcript string")
    assigned = spark.createDataFrame([("ep01.wav", "c1", 1.0), ("ep02.wav", "c2", 1.0), ("ep03.wav", "noise", 1.0), ("old.wav", "c1", 1.0), ("ep01.wav", "c0", 0.0)], "filename string, cluster_dir string, mtime double")
    include = spark.createDataFrame([("ep01.wav",), ("ep02.wav",), ("ep03.wav",)], "filename string")
    out = col(M.export_manifest(assigned, meta, include), "filename", "transcript", "cluster_dir")
    assert out == [("ep01.wav", "hi", "c1"), ("ep02.wav", "ho", "c2"), ("ep03.wav", "", "noise")]
    old = spark.createDataFrame([("ep01.wav", "clustering_old", "x"), ("ep09.wav", "clustering_old", "y"), (" ", "z", "w")], "filename string, cluster_dir string, extra string")
    now = spark.createDataFrame([("ep01.wav", "clustering_5", 1.0), ("ep03.wav", "noise", 1.0)], "filename string, cluster_dir string, mtime double")
    refreshed = M.refresh_manifest(old, now, meta)
    assert tuple(M.refresh_counts(refreshed).first()) == (4, 2, 1, 1)
    assert col(refreshed, "filename", "cluster_dir", "extra") == [(" ", "z", "w"), ("ep01.wav", "clustering_5", "x"), ("ep03.wav", "noise", ""), ("ep09.wav", "", "y")]
    fixture = spark.createDataFrame([("ep01_000000.wav", "0", "clustering_old"), (" ep02_000000.wav\t", "1", "clustering_old"), ("ep04.wav", "2", "")], "filename string, index string, cluster_dir string")
    now = spark.createDataFrame([("ep01_000000.wav", "clustering_5", 1.0), ("ep03_000000.wav", "noise", 1.0)], "filename string, cluster_dir string, mtime double")
    meta = spark.createDataFrame([("ep03_000000.wav", "2", "3.0")], "filename string, index string, timestamp_start string")
    assert tuple(M.refresh_counts(M.refresh_manifest(fixture.limit(2), now, meta)).first()) == (3, 2, 1, 1)
    both = M.refresh_manifest(fixture, now.unionByName(spark.createDataFrame([("ep02_000000.wav", "c", 1.0)], now.schema)), meta)
    assert tuple(M.refresh_counts(both).first()) == (4, 2, 1, 1)
    assert col(both.where("status = 'added'"), "filename", "index", "timestamp_start") == [("ep03_000000.wav", "2", "3.0")]
    assert M.refresh_manifest(fixture.limit(0), now.limit(0), meta).count() == 0


def test_latest_and_relabel(spark):
    a = spark.createDataFrame([("dup.wav", "clustering_1", 0.0), ("dup.wav", "clustering_2", 100.0), ("tie.wav", "a", 1.0), ("tie.wav", "b", 1.0)], "filename string, cluster_dir string, mtime double")
    assert col(M.latest_assignment(a), "filename", "cluster_dir") == [("dup.wav", "clustering_2"), ("tie.wav", "b")]
    b = spark.createDataFrame([("same.wav", "clustering_5", 1.0), ("unique.wav", "clustering_5", 1.0), ("same.wav", "x", 9.0)], "filename string, cluster_dir string, mtime double")
    assert tuple(M.relabel_counts(b, "clustering_5", "x").first()) == (2, 1)
    assert col(M.relabel(b, "clustering_5", "x"), "filename", "cluster_dir", "mtime") == [("same.wav", "x", 1.0), ("unique.wav", "x", 1.0)]


def test_prune(spark):
    rows = [(f"{c}{i}", c) for c, n in (("clustering_1", 11), ("clustering_2", 10), ("noise", 3), ("alice", 4)) for i in range(n)]
    df = spark.createDataFrame(rows, "filename string, cluster_dir string")
    assert col(M.prune_small(df).groupBy("cluster_dir").count(), "cluster_dir") == [("clustering_1",)]
    assert col(M.prune_small(df, protect_labeled=True).groupBy("cluster_dir").count(), "cluster_dir") == [("alice",), ("clustering_1",)]


def test_unlabeled_order(spark):
    rows = [("clustering_2",)] * 5 + [("clustering_10",)] * 2 + [("오카베",)] * 3 + [("noise",)]
    df = spark.createDataFrame(rows, "cluster_dir string")
    assert [r.cluster_dir for r in M.unlabeled_order(df).orderBy("place").collect()] == ["clustering_2", "clustering_10"]
    assert col(M.label_choices(df, df), "label") == [("오카베",)]


def test_gap_merge(spark):
    runs = spark.createDataFrame([(0, 0.0, 1.0), (0, 2.0, 3.0), (0, 4.001, 4.02), (1, 0.0, 0.04)], "track int, start double, end double")
    assert col(S.merge_gaps(runs), "track", "start", "end") == [(0, 0.0, 3.0)]


def test_islands_cross_chunks(spark):
    v = [1, 1, 0, 1, 1, 1, 1, 0, 0, 1]
    df = spark.createDataFrame([(0, i, float(x)) for i, x in enumerate(v)], "track int, i long, v double")
    assert col(S.islands(df, F.col("v") > 0, 1.0, 4), "start", "end") == [(0.0, 2.0), (3.0, 7.0), (9.0, 10.0)]
    assert S.islands(df, F.col("v") > 2, 1.0).count() == 0


def test_slices(spark):
    df = spark.createDataFrame([(0, i, float(i)) for i in range(10)], "track int, i long, v double")
    cuts = spark.createDataFrame([(0, 0, 2.0, 7.0), (0, 1, 8.0, 11.0), (0, 2, 3.0, 3.0)], "track int, seq int, start double, end double")
    chunks = S.chunked(df, 4)
    assert [list(r.samples) for r in S.slice_samples(chunks, cuts, 4, 1.0).collect()] == [[2.0, 3.0, 4.0, 5.0, 6.0]]
    assert col(S.slice_samples(chunks, cuts, 4, 1.0, clamp=True).select("seq", F.size("samples").alias("n")), "seq", "n") == [(0, 5), (1, 2)]


def test_slice_sums(spark):
    at = [i for i in range(3, 40) if not 9 < i < 22 and i != 30]
    df = spark.createDataFrame([(0, i, float(i)) for i in at], "track int, i long, v double")
    every = [(0, a * 100 + b, float(a), float(b)) for a in range(0, 42) for b in range(0, 42)]
    cuts = spark.createDataFrame(every, "track int, seq int, start double, end double")
    want = [(seq, len(own), sum(own), own[0]) for _, seq, a, b in every if b <= 40 and (own := [float(i) for i in at if a <= i < b])]
    assert col(S.slice_sums(df, cuts, 4, 1.0), "seq", "n", "total", "first") == want
    assert S.slice_sums(df, cuts, 4, 1.0).where("seq = 3938").count() == 0


def test_long_slices_are_not_built(spark, tmp_path):
    from voxloom.plans import segment_queries

    events = spark.range(800).select(F.col("id").alias("event_id"), (F.col("id") % 90).alias("user_id"), (F.col("id") % 50).cast("double").alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    plan = segment_queries.q_slice_samples(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "flatten" not in plan  # arrays by chunk only


def test_refine_modes(spark):
    def heard(wave, rate):
        return [(0.0, 10.0, " a "), (10.0, 20.0, "b"), (None, 5.0, "x")] if len(wave) > 20 * rate else [(0.0, 1.0, "c")]

    df = spark.createDataFrame([("f", 100.0, [0.0] * 45)], "file string, start double, samples array<double>")
    assert col(S.refine(df, heard, rate=1), "start", "end", "text") == [(100.0, 110.0, "a"), (110.0, 120.0, "b"), (120.0, 130.0, "a"), (130.0, 140.0, "b"), (140.0, 141.0, "c"), (141.0, 142.0, "c"), (142.0, 143.0, "c"), (143.0, 144.0, "c"), (144.0, 145.0, "c")]
    assert col(S.refine(df, heard, rate=1, mode="reference"), "start", "text")[0] == (100.0, "a")


def test_recommendation(spark):
    def store(rows):
        return V.centroids(spark.createDataFrame(rows, "cluster_dir string, embedding array<float>"))

    labels = store([("label_a", [1.0, 0.0])] * 2 + [("label_b", [0.0, 1.0])] * 2)
    r = V.recommend(store([("t", [1.0, 0.0])] * 2), labels).first()
    assert (r.label, r.warning) == ("label_a", False) and r.score >= 0.99
    r = V.recommend(store([("t", [1.0, 0.0])]), store([("a", [0.34, 0.94042516]), ("b", [0.33, 0.94398093])])).first()
    assert r.label == "a" and r.warning and "top1=" in r.reason and "top1-top2=" in r.reason


def test_vectors(spark):
    df = spark.createDataFrame([("a", [3.0, 4.0]), (" ", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [1.0, 2.0, 3.0])], "filename string, embedding array<float>")
    assert [(r.filename, [round(x, 6) for x in r.embedding]) for r in V.clean_store(df).collect()] == [("a", [0.6, 0.8])]
    new = spark.createDataFrame([("a", [1.0, 0.0]), ("z", [0.0, 2.0]), ("n", [0.0, 0.0])], "filename string, embedding array<float>")
    kept = {r.filename: (r.status, list(r.embedding)) for r in V.upsert_store(df.where("filename = 'a'"), new).collect()}
    assert kept["a"][0] == "kept" and kept["z"] == ("added", [0.0, 1.0]) and "n" not in kept
    assert {r.filename: r.status for r in V.upsert_store(df.where("filename = 'a'"), new, True).collect()} == {"a": "updated", "z": "added"}


def test_hdbscan_and_kmeans(spark):
    rng = np.random.default_rng(1)
    blobs = np.concatenate([rng.normal((1, 0), 0.02, (12, 2)), rng.normal((0, 1), 0.02, (12, 2)), [[-1.0, -1.0]]])
    x = blobs / np.linalg.norm(blobs, axis=1, keepdims=True)
    labels = V.hdbscan_labels(x)
    assert set(labels[:12]) == {0} and set(labels[12:24]) == {1} and labels[24] == -1
    assert (V.hdbscan_labels(x[:3]) == -1).all()
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(blobs)], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.label for r in V.recluster(df).collect()} == dict(enumerate(labels.tolist()))
    more = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(np.concatenate([blobs] * 4))], "vec_id long, embedding array<double>")
    by_vector = {}
    for r in V.recluster(more, min_cluster=10, sample=60).collect():  # one rule for sampled rows and others
        assert by_vector.setdefault(r.vec_id % 25, r.label) == r.label
    assert by_vector[24] == -1
    assigned, centers = V.spherical_kmeans(df, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.6, -0.8])])
    assert centers[2][1] == pytest.approx([0.6, -0.8]) or assigned.where("label = 2").count() > 0


def test_hdbscan_by_blocks(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.1 + 0.1 * i, (40, 6)) for i, c in enumerate(rng.normal(size=(5, 6)))] + [rng.normal(size=(60, 6))])
    x = np.concatenate([x, x[:9], x[:9]])  # with copies
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    want, turn = V.hdbscan_labels(units), rng.permutation(len(x))
    assert want.max() > 2 and (want < 0).any()
    assert (V.hdbscan_labels(units[turn], names=turn.tolist()) == want[turn]).all()
    df = spark.createDataFrame([(f"{i:03}", v.tolist()) for i, v in enumerate(x)] + [("zero", [0.0] * 6)], "k string, x array<double>")
    for block in (30, 2048):
        assert col(V.hdbscan(df, "k", "x", block=block), "k", "label") == [(f"{i:03}", n) for i, n in enumerate(want.tolist())]
    assert col(V.hdbscan(df.where("k < '003'"), "k", "x"), "label") == [(-1,)] * 3
    assert V.hdbscan(df.where("k < ''"), "k", "x").count() == 0


def test_bridging_tree():
    rng = np.random.default_rng(2)
    x, core = rng.normal(size=(50, 3)), rng.uniform(0.1, 0.6, 50)
    whole = V._spanning_tree(x, core)
    parts = [V._spanning_tree(x[:20], core[:20]), V._spanning_tree(x[20:], core[20:]), V._bridging_tree(x[:20], x[20:], core[:20], core[20:])]
    assert all((a < 20) != (b < 20) for a, b in zip(*parts[2][:2], strict=True)) and len(parts[2][0]) == 49
    ids = [np.concatenate([parts[0][k], parts[1][k] + 20, parts[2][k]]) for k in (0, 1)]
    found = V._forest(*ids, np.concatenate([p[2] for p in parts]))
    assert sorted(found[2]) == pytest.approx(sorted(whole[2])) and len(found[0]) == 49
    assert V._bridging_tree(x[:1], x[1:2], core[:1], core[1:2])[2] == pytest.approx([max(np.linalg.norm(x[0] - x[1]), core[0], core[1])])


def test_hdbscan_of_many(spark):
    angle = F.when(F.col("id") % 2 == 0, F.col("id") * 2.5e-5).otherwise(2 + F.col("id") * 2.5e-5)
    df = spark.range(20_100).select(F.col("id").alias("vec_id"), F.array(F.cos(angle), F.sin(angle)).alias("embedding"))
    assert {(r.side, r.label): r.n for r in V.hdbscan(df).groupBy((F.col("vec_id") % 2).alias("side"), "label").agg(F.count("*").alias("n")).collect()} == {(0, 0): 10_050, (1, 1): 10_050}


def test_blocked_similarity_rounds_in_blocks(spark):
    vectors = {"a": [1.0, 0.0], "b": [3.0, 4.0], "c": [-3.0, 4.0], "d": [0.0, 0.0], "e": [-1.0, 1e-9]}
    df = spark.createDataFrame(list(vectors.items()), "k string, x array<float>")
    found = {(r.k, r.other): r.similarity for r in V.blocked_similarity(df.where("k < 'c'"), df, "k", "x", block=2, digits=1).collect()}
    assert found == dict(zip([(a, b) for a in "ab" for b in "abcde"], [1.0, 0.6, -0.6, 0.0, -1.0, 0.6, 1.0, 0.3, 0.0, -0.6], strict=True))
    plan = V.blocked_similarity(df, df, "k", "x", digits=1)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    with pytest.raises(Exception, match="one length"):
        V.blocked_similarity(df, df.unionByName(spark.createDataFrame([("f", [1.0])], "k string, x array<float>")), "k", "x").collect()


def test_kmeans_with_empty_tasks(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], "vec_id long, embedding array<double>").repartition(8)
    seeds = [(0, [1.0, 0.0]), (1, [0.0, 1.0])]
    assert col(V.kmeans_step(df, seeds).select("label", "n"), "label", "n") == [(0, 1), (1, 1)]
    assert V.kmeans_step(df.where("vec_id < 0"), seeds).count() == 0
    assigned, centers = V.spherical_kmeans(df, seeds)
    assert col(assigned, "vec_id", "label") == [(0, 0), (1, 1)] and centers == seeds


def test_kmeans_step_of_unlabelled_and_cancelling_vectors(spark, tmp_path):
    from voxloom.plans import vector_queries

    rows = [(0, 1, [1.0, 0.1]), (1, 1, [2.0, 0.0]), (2, None, [0.0, 1.0]), (3, None, [0.1, 1.0]), (4, 3, [0.6, 0.8]), (5, 3, [-0.6, -0.8])]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = vector_queries.q_kmeans_step(spark, str(tmp_path)).collect()
    # 4 is nearest to the centre without a label, 5 to the one of label 1; label 3 has no centre
    assert sorted((str(r.label), r.i, r.n) for r in found) == [("1", 1, 3), ("1", 2, 3), ("None", 1, 3), ("None", 2, 3)]
    assert vector_queries.q_noise_gate(spark, str(tmp_path)).where("label is null").count() == 3
    assert vector_queries.q_kmeans_full(spark, str(tmp_path)).count() == 6


def test_kmeans_step_keeps_nan(spark):
    df = spark.createDataFrame([(0, [1.0, float("nan")])], "vec_id long, embedding array<double>")
    assert np.isnan(V.kmeans_step(df, [(0, [1.0, 0.0])]).first().centroid).all()
    assert V.kmeans_step(df, []).count() == V.assign(df, []).count() == 0


def test_recluster_with_empty_tasks(spark):
    points = [(i, [1.0, i / 1000]) for i in range(6)] + [(10 + i, [i / 1000, 1.0]) for i in range(6)]
    df = spark.createDataFrame(points, "vec_id long, embedding array<double>").repartition(24)
    assert {r.vec_id: r.label for r in V.recluster(df).collect()} == {k: k // 10 for k, _ in points}


def test_recluster_of_the_whole_table(spark):
    rng = np.random.default_rng(145)  # k-means over noise too gives six rows another label
    blobs = [rng.normal(c, 0.16 + 0.05 * i, (60, 6)) for i, c in enumerate(rng.normal(size=(4, 6)))]
    x = np.concatenate([*blobs, rng.normal(size=(60, 6))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    base = V.hdbscan_labels(u)
    on = base >= 0
    centers = np.array([u[base == n].mean(axis=0) for n in range(base.max() + 1)])
    for _ in range(100):  # noise has no part in it
        centers /= np.linalg.norm(centers, axis=1, keepdims=True)
        label = (u[on] @ centers.T).argmax(axis=1)
        old, centers = centers, np.array([u[on][label == n].mean(axis=0) for n in range(len(centers))])
        if np.allclose(old, centers / np.linalg.norm(centers, axis=1, keepdims=True), atol=1e-4):
            break
    want = base.copy()
    want[on] = label
    assert len(centers) > 1 and 20 < (~on).sum()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, [0.0] * 6)], "vec_id long, embedding array<double>")
    assert col(V.recluster(df, gate=1.0), "vec_id", "label") == list(enumerate(want.tolist()))
    assert col(V.recluster(df.where("vec_id < 4 or vec_id = 999")), "vec_id", "label") == [(i, -1) for i in range(4)]
    assert not spark._jsparkSession.sharedState().cacheManager().lookupCachedData(V.recluster(df)._jdf).isDefined()


def test_recluster_past_the_old_sample(spark):
    def ring(n, turn):
        return [(turn * 100_000 + i, [float(np.cos(turn + i * 1e-5)), float(np.sin(turn + i * 1e-5))]) for i in range(n)]

    points = [*ring(12_000, 0), *ring(12_000, 2), *ring(6, 4)]
    df = spark.createDataFrame(points, "vec_id long, embedding array<double>")
    # a cluster of six, of which a sample of 20,000 of 24,006 rows has all only by chance
    found = V.recluster(df, min_cluster=6).groupBy((F.col("vec_id") / 100_000).cast("int").alias("ring"), "label").count()
    assert col(found, "ring", "label", "count") == [(0, 0, 12_000), (2, 1, 12_000), (4, 2, 6)]


def test_note_bounds_far_along_a_track(spark):
    bounds = [(0, 0, 1e8)] + [(0, i, 0.01) for i in range(1, 61)]
    df = spark.createDataFrame(bounds, "track int, i long, bound double")
    # a half rounds to even at frame 50; doubles have drifted past it there
    assert col(G.note_bounds(df, ["track"], "i", "bound"), "i", "item") == [(i, 1 if i <= 50 else 2) for i in range(61)]


def test_metrics(spark):
    df = spark.createDataFrame([(0, float(i), float(i)) for i in range(1, 5)], "track int, r double, e double")
    assert df.groupBy("track").agg(G.sdr(F.col("r"), F.col("e")).alias("s")).first().s == pytest.approx(10 * np.log10(30 / 1e-7), abs=1e-3)
    silent = df.withColumn("r", F.lit(0.0))
    assert silent.groupBy("track").agg(G.sdr(F.col("r"), F.col("e")).alias("s")).first().s == pytest.approx(10 * np.log10(1e-7 / 30), abs=1e-3)
    scaled = df.withColumn("e", F.col("r") * 3)
    assert G.si_sdr(scaled, ["track"], "r", "e").first().si_sdr > 60
    v = spark.createDataFrame([(0, i, float(x)) for i, x in enumerate([1, 2, 3, 4])], "t int, i long, x double")
    assert G.chunk_median(v, "t", "i", 1, F.max("x")).first()["median"] == 2.0


def test_overlap_add_is_identity(spark):
    x = [[float(i % 7) for i in range(50)], [1.0, 2.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "track int, samples array<double>")
    for r in G.demix(df, lambda a: a, 16).collect():
        assert list(r.samples) == pytest.approx(x[r.track])
    long = spark.createDataFrame([(0, i, v) for i, v in enumerate(x[0])], "track int, i long, v double")
    assert [r.v for r in G.overlap_add(long, 16, 5, 1 + F.col("place")).orderBy("i").collect()] == pytest.approx(x[0])


def test_stft_round_trip(spark):
    x = np.random.default_rng(0).normal(size=300)
    assert G.istft(G.stft(x, 64, 16), 300, 64, 16) == pytest.approx(x)
    df = spark.createDataFrame([(0, 0, x.tolist()), (0, 1, (2 * x).tolist())], "track int, src int, samples array<double>")
    assert list(G.stft_ensemble(df, "min", 64, 16).first().samples) == pytest.approx(x.tolist())


def test_batches(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([1, 1, 1, 5, 5, 10])], "k long, n long")
    found = {r.k: r.batch for r in G.batch_by_size(df, "k", "n", 10, 2).collect()}
    assert [found[i] for i in range(6)] == [0, 0, 1, 1, 2, 3]


@pytest.mark.parametrize(
    ("base", "current", "most", "cpu", "ram", "gpu", "vram", "want"),
    [(1, 1, 4, 35, 40, 20, 20000, 2), (1, 2, 4, 35, 40, 20, 20000, 3), (1, 3, 4, 35, 40, 20, 20000, 4), (2, 4, 4, 95, 32, 30, 18000, 1), (2, 4, 4, 82, 32, 40, 18000, 2), (1, 1, 4, 40, 30, None, None, 2), (2, 3, 4, 20, 32, 20, 2000, 1), (1, 3, 3, 20, 40, 10, 24000, 3)],
)
def test_batch_policy(spark, base, current, most, cpu, ram, gpu, vram, want):
    args = [F.lit(x).cast("double") if i > 2 else F.lit(x) for i, x in enumerate((base, current, most, cpu, ram, gpu, vram))]
    assert one(spark, N.batch_size(*args))[0] == want


def test_wav_and_text_files(spark, tmp_path):
    x = np.array([[0.5, -0.25, 0.125]], np.float32)
    rate, back = files.parse_wav(files.write_wav(8000, x))
    assert rate == 8000 and (back == x).all()
    (tmp_path / "a.wav").write_bytes(files.write_wav(8000, x))
    (tmp_path / "b.wav").write_bytes(b"junk")
    assert col(files.read_wavs(spark, str(tmp_path), 2), "name", "chunk_no", "reason") == [("a.wav", 0, ""), ("a.wav", 1, ""), ("b.wav", 0, "not a WAV file")]
    texts = tmp_path / "t"
    texts.mkdir()
    (texts / "k.smi").write_bytes("안녕".encode("cp949"))
    (texts / "u.smi").write_bytes("안녕".encode("utf-16"))
    assert col(files.read_texts(spark, str(texts)), "name", "text") == [("k.smi", "안녕"), ("u.smi", "안녕")]


def test_store_and_manifest_files(spark, tmp_path):
    buffer = io.BytesIO()
    np.savez(buffer, filenames=np.array(["a", " ", "z"]), embeddings=np.array([[1, 0], [1, 0], [0, 0]], np.float32))
    (tmp_path / "s.npz").write_bytes(buffer.getvalue())
    assert [(r.filename, list(r.embedding)) for r in files.read_store(spark, str(tmp_path / "s.npz")).collect()] == [("a", [1.0, 0.0])]
    m = spark.createDataFrame([("b", 'say "hi", you'), ("a", None)], "filename string, transcript string")
    files.write_manifest(m, str(tmp_path / "m"))
    back = files.read_manifest(spark, str(tmp_path / "m"))
    assert col(back, "filename", "transcript", "index") == [("a", "", ""), ("b", 'say "hi", you', "")]


def test_transcode_and_providers(spark):
    def codec(content, name):
        if name == "bad.mp3":
            raise ValueError("broken")
        return content[::-1]

    df = spark.createDataFrame([("a.mp3", b"xy"), ("bad.mp3", b"z")], "name string, content binary")
    done = files.transcode(df, codec, ".wav")
    assert tuple(files.transcode_summary(done).first()) == (2, 1, 1, ["bad.mp3"])
    PROVIDERS = P.Providers()
    PROVIDERS.register("codec", "flip")(codec)
    assert PROVIDERS.get("codec", "flip") is codec
    with pytest.raises(KeyError):
        PROVIDERS.get("codec", "none")
    out, side = P.chain(df, [lambda d: (d.limit(1), {"all": d})])
    assert out.count() == 1 and side[0]["all"].count() == 2


def test_sync_store(spark):
    def embed(batches):
        for pdf in batches:
            yield pd.DataFrame({"filename": pdf["filename"], "embedding": [[0.0, 2.0]] * len(pdf)})

    store = spark.createDataFrame([("a", [1.0, 0.0])], "filename string, embedding array<float>")
    names = spark.createDataFrame([("a",), ("b",)], "filename string")
    assert col(P.sync_store(names, store, embed), "filename", "status") == [("a", "kept"), ("b", "added")]


def test_streaming(spark, tmp_path):
    from voxloom.streaming import events as E

    src = tmp_path / "in"
    spark.createDataFrame([("f", "c1", 1.0), ("f", "c2", 2.0), ("g", "c1", 1.0)], "filename string, cluster_dir string, mtime double").write.parquet(str(src))
    stream = spark.readStream.schema("filename string, cluster_dir string, mtime double").parquet(str(src))
    q = E.latest_assignments(stream).writeStream.format("memory").queryName("latest").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert col(spark.table("latest"), "filename", "cluster_dir") == [("f", "c2"), ("g", "c1")]
    times = [(0, "2024-01-01 00:00:00", True), (0, "2024-01-01 00:00:00.5", True), (0, "2024-01-01 00:00:03", True), (0, "2024-01-01 00:00:03.2", False)]
    batch = spark.createDataFrame(times, "track int, t string, loud boolean").select("track", F.to_timestamp("t").alias("ts"), "loud")
    assert [r.n for r in E.loud_sessions(batch).orderBy("start").collect()] == [2, 1]
    assert E.windowed_energy(batch.withColumn("v", F.lit(1.0))).agg(F.sum("n")).first()[0] == 8


def test_whole_table_queries_match_brute_force(spark, sf):
    from voxloom.plans import catalogue, segment_queries

    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").toPandas()
    x = np.array(e.embedding.tolist(), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for label in e.label.unique():
        own = np.flatnonzero(e.label == label)
        mean = x[own].mean(axis=0)
        want |= dict(zip(e.vec_id[own], (1 - x[own] @ mean / np.linalg.norm(mean)) / 2, strict=True))
    found = {r.vec_id: r.distance for r in catalogue.QUERIES["q_half_cosine"](spark, sf).collect()}
    assert found.keys() == want.keys() and all(abs(found[i] - want[i]) < 2e-5 for i in want)

    tracks = {}
    for r in segment_queries._samples(spark, sf).collect():
        tracks.setdefault(r["track"], {})[r["i"]] = r["v"]
    want = {}
    for r in spark.read.parquet(f"{sf}/events.parquet").collect():
        a, b, own = r.event_id // 16, r.event_id // 16 + r.user_id, tracks.get(r.event_id % 8, {})
        if own and a < b <= max(own) + 1:
            cut = [own[i] for i in range(a, b)]
            want[r.event_id] = (r.event_id % 8, len(cut), sum(cut), cut[0])
    found = {r.seq: (r.track, r.n, r.total, r["first"]) for r in catalogue.QUERIES["q_slice_samples"](spark, sf).collect()}
    assert found.keys() == want.keys() and len(want) > 0
    assert all(found[k][:2] == want[k][:2] and abs(found[k][2] - want[k][2]) < 1e-5 and abs(found[k][3] - want[k][3]) < 1e-5 for k in want)
