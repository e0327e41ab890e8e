"""Waveform operators against brute force and closed forms."""

from __future__ import annotations

import itertools

import numpy as np

from voxloom.operators import waveform as W


def tone(hz, rate, seconds=0.2):
    return np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)


def test_resample_keeps_a_tone():
    for old, new in ((48_000, 16_000), (44_100, 16_000), (8_000, 16_000)):
        y = W.resample(tone(440, old), old, new)
        want = tone(440, new)
        assert len(y) == -(-len(tone(440, old)) * new // old)
        n = min(len(y), len(want))
        assert np.abs(y[200 : n - 200] - want[200 : n - 200]).max() < 0.01


def test_embedding_input(spark):
    rows = spark.createDataFrame([(1, 8000, [0.5] * 100, "x"), (2, 16000, [], "y"), (3, 16000, None, "z"), (4, 48000, [1.0] * 7, "x")], "id int, rate int, samples array<float>, reason string")
    found = {r["id"]: (None if r["samples"] is None else len(r["samples"]), r["reason"]) for r in W.embedding_input(rows, "rate", most=150).collect()}
    assert found == {1: (150, None), 2: (0, W.EMPTY), 3: (None, W.EMPTY), 4: (3, None)}
    assert W.embedding_input(rows.where("id = 1"), "rate", most=0).first()["reason"] == W.EMPTY_AFTER_TRIM
    assert W.embedding_input(rows.limit(0), "rate").count() == 0


def test_phase_shift():
    t = np.arange(400) / 400
    for n in (400, 399):
        x = np.cos(2 * np.pi * 20 * np.arange(n) / n)
        assert np.allclose(W.shifted_phase(x, 90), -np.sin(2 * np.pi * 20 * np.arange(n) / n), atol=1e-9)
    assert np.allclose(W.shifted_phase(np.cos(2 * np.pi * 8 * t), 45), np.cos(2 * np.pi * 8 * t + np.pi / 4), atol=1e-9)
    assert W.phase_degrees(180) == [0, 180] and W.phase_degrees(90) == [0, 180, 90, -90]
    assert W.phase_degrees(70) == [0, 180, 70, -70, 140, -140]


def test_phase_shift_rows(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0, 0.0, -1.0]), (2, []), (3, None)], "id int, samples array<double>")
    found = {(r["id"], r["degrees"]): r["samples"] for r in W.phase_shifts(rows, 90).collect()}
    assert len(found) == 12 and found[1, 180] == [-1.0, -2.0, 0.0, 1.0] and found[2, 90] == [] and found[3, 90] is None


def test_best_lag_is_the_peak_of_the_correlation():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (7, 12), (40, 40), (100, 33)):
        a, b = rng.normal(size=n), rng.normal(size=m)
        assert W.best_lag(a, b) == np.correlate(a, b, "full").argmax() - (m - 1)
    assert W.best_lag(np.zeros(0), np.ones(3)) == 0


def test_quick_alignment(spark):
    x = np.random.default_rng(5).normal(size=300)
    late = np.concatenate([np.zeros(6), x])
    rows = spark.createDataFrame([(1, x.tolist(), late.tolist()), (2, late.tolist(), x.tolist()), (3, [1.0], [2.0]), (4, None, [2.0])], "id int, a array<double>, b array<double>")
    found = {r["id"]: r for r in W.quick_alignment(rows, "a", "b", 100).collect()}
    assert (found[1]["lag"], found[2]["lag"], found[3]["lag"], found[4]["lag"]) == (-6, 6, 0, 0)
    assert np.allclose(found[1]["b"], x) and np.allclose(found[2]["b"], late) and found[4]["b"] == [2.0]


def test_best_path_by_brute_force():
    rng = np.random.default_rng(7)
    salience = rng.random((4, 40))
    steps = np.maximum(30 - np.abs(np.arange(40)[:, None] - np.arange(40)), 0)
    steps = np.log(steps / steps.sum(axis=1, keepdims=True) + 1e-300)
    seen = np.log(salience / salience.sum(axis=1, keepdims=True))
    least = [np.argsort(-s)[:6] for s in seen]  # the best path passes only strong bins here
    paths = itertools.product(*least)
    score = lambda p: seen[range(4), p].sum() + sum(steps[i, j] for i, j in itertools.pairwise(p))
    best = max(paths, key=score)
    assert score(W.best_path(salience)) >= score(best) - 1e-12


def test_salience_pitch(spark):
    peak = np.zeros((3, 360))
    peak[0, 100], peak[1, 100:102], peak[2, 50] = 1.0, 0.5, 0.01
    hz = 10 * 2 ** ((20 * np.array([100, 100.5]) + 1997.3794084376191) / 1200)
    assert np.allclose(W.pitch_of(peak), [*hz, 0])
    far = np.zeros((3, 360))
    far[:, 100] = 0.4
    far[1, 300] = 0.5
    assert W.pitch_of(far)[1] > 2 * W.pitch_of(far, viterbi=True)[1] and np.allclose(W.pitch_of(far, viterbi=True), hz[0])
    rows = spark.createDataFrame([(1, peak.tolist()), (2, []), (3, None)], "id int, salience array<array<double>>")
    found = {r["id"]: r["f0"] for r in W.salience_pitch(rows).collect()}
    assert np.allclose(found[1], [*hz, 0]) and found[2] == [] and found[3] is None
