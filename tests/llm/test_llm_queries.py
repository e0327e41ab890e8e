"""The registered queries and the pipeline over the whole smallest tables, against plain Python."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from test_llm_operators import base_spans, brute_components, check_packing, shingles
from voxloom.llm import language, packing, registry, secrets, sketches


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def rows(spark, sf, name):
    return registry.QUERIES[name](spark, sf).collect()


def test_op1(spark, sf, docs):
    found = rows(spark, sf, "op1_language")
    assert {r.doc_id: r.held_out for r in found} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs} and len(found) == len(docs)
    known = {d.lang for d in docs.values() if d.lang} | {"und"}
    assert all(r.lang_pred in known and 0 <= r.score <= 1 for r in found)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id].text or "")) for r in found)
    held = [r for r in found if r.held_out and docs[r.doc_id].lang]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.95


def test_op4(spark, sf, docs):
    found = rows(spark, sf, "op4_packing")
    n = check_packing(found, [(i, d.text) for i, d in docs.items()])
    tokens = {i: packing.token_ids(d.text) for i, d in docs.items()}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(np.asarray(tokens[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    for i, t in tokens.items():
        own = sorted((r.piece, r.start, r.length) for r in found if r.doc_id == i)
        assert [p for p, _, _ in own] == list(range(len(own))) and [s for _, s, _ in own] == np.cumsum([0, *[k for _, _, k in own]])[:-1].tolist()
        assert len(own) == 1 if len(t) <= 1024 else all(k == 1024 for _, _, k in own[1:])
    assert n <= 1.02 * math.ceil(sum(map(len, tokens.values())) / 1024) + 1


def test_op5(spark, sf, docs):
    found = rows(spark, sf, "op5_flac")
    by_text = {}
    for r in found:
        text = (docs[r.doc_id].text or "").encode()
        payload = text + bytes(max(64, -(-len(text) // 64) * 64) - len(text))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        x = np.frombuffer(payload, np.uint8).astype(float) - 128
        want = f"rms={np.sqrt((x * x).mean()):.6f};peak={int(abs(x).max())};mean={x.mean():.6f};zcr={np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)) / len(x):.6f};step={np.abs(np.diff(x)).sum() / len(x):.6f}"
        assert r.feature == want
        assert by_text.setdefault(text, tuple(r)[1:]) == tuple(r)[1:]
    assert len(found) == len(docs)


def test_op6(spark, sf, docs):
    found = rows(spark, sf, "op6_secrets")
    assert len(found) == len(docs)
    for r in found:
        base = base_spans(docs[r.doc_id].text or "")
        named = [f"{k}:{a}:{b}" for k, a, b in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("model")] == named


def test_op7(spark, sf, docs):
    found = rows(spark, sf, "op7_sharding")
    counts = Counter(r.shard for r in found)
    assert sorted(r.doc_id for r in found) == sorted(docs) and set(counts) <= set(range(40)) and max(counts.values()) - min(counts.get(s, 0) for s in range(40)) <= 1
    for r in found:
        text = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "rows", None)
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(n)) for s, n in counts.items())


def test_op8(spark, sf, docs):
    found = {r.doc_id: r for r in rows(spark, sf, "op8_sketches")}
    order = sorted(docs, reverse=True)
    errors, prints = [], {}
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        a, b, r = docs[i].text or "", docs[j].text or "", found[i]
        part = len(a) // 3
        changed = a[: len(a) - part] + b[:part]
        assert (r.n_chars, r.edited_sha256) == (len(a), hashlib.sha256(changed.encode()).hexdigest())
        assert prints.setdefault(a, r.fingerprint) == r.fingerprint
        for likeness, other in ((r.near_edited, changed), (r.near_next, b)):
            s, t = shingles(a, sketches.WIDTH), shingles(other, sketches.WIDTH)
            errors.append(likeness - (len(s & t) / len(s | t) if s | t else 1.0))
    assert len(found) == len(docs) and np.sqrt(np.mean(np.square(errors))) <= 0.05 and max(map(abs, errors)) <= 0.25


def test_op10(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = rows(spark, sf, "op10_html")
    assert sorted(r.page_id for r in found) == sorted(pages)
    for r in found:
        body = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id].html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def poisson(rate, u):
    n, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total < u:
        n += 1
        p *= rate / n
        total += p
    return n


def test_pipeline(spark, sf, docs):
    """Every kept document's tokens, as many times as its source's Poisson draw says."""
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.train(*language.labelled_sample(frame))
    ids = sorted(docs)
    judged = dict(zip(ids, language.predict([docs[i].text for i in ids], model), strict=True))
    kept = [i for i in ids if judged[i][0] != "und" and judged[i][4] >= 0.4]
    assert len(kept) >= 0.97 * len(ids)
    kept = sorted({c for _, _, c in brute_components([(i, docs[i].text) for i in kept], 5, 80, 100)})
    masked = {i: secrets.masked(docs[i].text, spans) if spans else docs[i].text for i, spans in zip(kept, secrets.scan(pa.array([docs[i].text for i in kept]), secrets.trained()), strict=True)}
    assert not any(base_spans(t) for t in masked.values())
    sources = Counter(docs[i].source for i in kept)
    weights = {s: math.sqrt(n) for s, n in sources.items()}
    want = Counter()
    for i in kept:
        rate = weights[docs[i].source] * len(kept) / sum(weights.values()) / sources[docs[i].source]
        u = (int(hashlib.md5(f"20231|{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        if n := poisson(rate, u):
            want[i] = n * len(packing.token_ids(masked[i]))
    found = corpus_pipeline.run(spark, sf).collect()
    got = Counter()
    for r in found:
        got[r.doc_id] += r.length
    assert got == want
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist() and sum(n for _, n in own) <= 1024
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "best-fit packing"]
