"""Language identification by a linear-chain conditional random field over the words of code-switched text.

A word's score for a language sums learned weights of hashed affixes and character n-grams and of membership in
frequent-word lexicons; a learned transition matrix links neighbouring words.  Forward-backward gives each word's
posterior; it runs over blocks of words at once: block products of the step matrices first, then messages from block
to block, then inside all blocks in step.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import grown, mix64, only_new, slices, table

BUCKETS = 1 << 16
STEP = 32
UNKNOWN = "und"
#: Bounds of the labelled sample: documents a language, characters and words of the excerpt of each, from anywhere in it.
TRAIN_DOCS = 80
TRAIN_CHARS = 20_000
TRAIN_WORDS = 400
LEXICON = 300
EPOCHS = 30
SEED = 5


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is a letter; its lower case where that is one code point."""
    letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for c in (*range(0xD800), *range(0xE000, 0x110000)):
        ch = chr(c)
        if ch.isalpha():
            letter[c] = True
            small = ch.lower()
            if len(small) == 1:
                lower[c] = ord(small)
    return letter, lower


@dataclass
class Words:
    """Distinct words of some texts (code points and places), and the sequence of words of each text."""

    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    sequence: np.ndarray
    at: np.ndarray


_P = np.uint64(0x9E3779B97F4A7C15 | 5)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def words_of(texts: list[str]) -> Words:
    """Words are the longest runs of letters, lower-cased."""
    letter, lower = _letters()
    raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    is_letter = letter[raw]
    edge = np.diff(is_letter.astype(np.int8), prepend=0)
    starts = np.flatnonzero(edge == 1)
    ends = np.flatnonzero(edge == -1)
    points = lower[raw]
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(raw), _P)]))
    inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(raw), _P_INV)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(points.astype(np.uint64) + np.uint64(1)) * power[: len(raw)])])
    hashes = mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    distinct, first, sequence = np.unique(hashes, return_index=True, return_inverse=True)
    return Words(points, starts[first], ends[first], distinct, sequence.reshape(-1), np.searchsorted(starts, bounds))


def _bucket(kind: int, *points: np.ndarray) -> np.ndarray:
    h = np.full(len(points[0]), kind, np.uint64)
    for p in points:
        h = (h + p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mix64(h) >> np.uint64(48)).astype(np.int64) % (BUCKETS - 1) + 1


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket, value) of all affix and n-gram features; a word's n-grams together weigh as much as one affix each kind."""
    n = words.ends - words.starts
    total = int(n.sum())
    own = np.repeat(np.arange(len(n)), n)
    inside = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    c = words.points[words.starts[own] + inside]
    begin, end = inside == 0, inside == n[own] - 1
    before = np.where(begin, 1, np.concatenate([[0], c[:-1]]) if total else c)
    after = np.where(end, 2, np.concatenate([c[1:], [0]]) if total else c)
    share = (2.0 / np.maximum(n, 1))[own]
    rows, buckets, values = [own, own], [_bucket(11, before, c, after), _bucket(12, c, after)], [share, share]
    for size in (1, 2, 3):
        have = np.flatnonzero(n >= size)
        for kind, base in ((20 + size, words.starts[have]), (30 + size, words.ends[have] - size)):
            rows.append(have)
            buckets.append(_bucket(kind, *(words.points[base + i] for i in range(size))))
            values.append(np.ones(len(have)))
    return np.concatenate(rows), np.concatenate(buckets), np.concatenate(values)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray

    def scores(self, words: Words, made: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Emission scores of the distinct words by label."""
        rows, buckets, values = made or word_features(words)
        out = np.empty((len(words.hashes), len(self.labels)))
        for label in range(len(self.labels)):
            out[:, label] = np.bincount(rows, self.weights[buckets, label] * values, len(out))
        return out + _members(words, self.lexicon) @ self.lexicon_weights


def _members(words: Words, lexicon: np.ndarray) -> np.ndarray:
    """Whether each distinct word is in each language's lexicon; lexicon: sorted (hash, language) rows."""
    languages = int(lexicon["language"].max(initial=-1)) + 1
    out = np.zeros((len(words.hashes), languages))
    for language in range(languages):
        own = np.sort(lexicon["hash"][lexicon["language"] == language])
        at = np.minimum(np.searchsorted(own, words.hashes), len(own) - 1)
        out[:, language] = own[at] == words.hashes
    return out


def forward_backward(scores: np.ndarray, at: np.ndarray, transitions: np.ndarray, start: np.ndarray, expected: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Posteriors of each word of sequences at[i]..at[i+1], exact, and the summed pair posteriors if asked for."""
    size = np.diff(at)
    full = np.flatnonzero(size)
    labels = scores.shape[1]
    if not len(full):
        return np.zeros((0, labels)), np.zeros((labels, labels)) if expected else None
    blocks = -(-size[full] // STEP)
    top = np.cumsum(blocks) - blocks
    nb = int(blocks.sum())
    doc = np.repeat(np.arange(len(full)), size[full])
    inside = np.arange(len(scores)) - np.repeat(at[full] - at[full][0], size[full])
    row, step = top[doc] + inside // STEP, inside % STEP
    p = np.ones((STEP, nb, labels))
    p[step, row] = np.exp(scores - scores.max(axis=1, keepdims=True))
    live = np.zeros((STEP, nb), bool)
    live[step, row] = True
    first = np.zeros((STEP, nb), bool)
    first[0, top] = True
    a = np.exp(transitions)
    moves = live & ~first
    product = np.broadcast_to(np.eye(labels), (nb, labels, labels)).copy()
    for t in range(STEP):
        moved = np.where(moves[t][:, None, None], product @ a, product) * p[t][:, None, :]
        product = moved / moved.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.empty((nb, labels)), np.ones((nb, labels)) / labels
    enter[top] = np.exp(start - start.max())
    order = np.argsort(-blocks, kind="stable")
    for j in range(1, int(blocks.max())):
        own = top[order[: np.searchsorted(-blocks[order], -j, side="left")]] + j
        message = np.einsum("bi,bij->bj", enter[own - 1], product[own - 1])
        enter[own] = message / message.sum(axis=1, keepdims=True)
    for j in range(int(blocks.max()) - 1, 0, -1):
        own = top[order[: np.searchsorted(-blocks[order], -j, side="left")]] + j
        message = np.einsum("bij,bj->bi", product[own], leave[own])
        leave[own - 1] = message / message.sum(axis=1, keepdims=True)
    alpha, beta = np.empty((STEP, nb, labels)), np.empty((STEP, nb, labels))
    now = enter
    for t in range(STEP):
        now = np.where(moves[t][:, None], now @ a, now) * p[t]
        now = now / now.sum(axis=1, keepdims=True)
        alpha[t] = now
    now = leave
    for t in range(STEP - 1, -1, -1):
        beta[t] = now
        back = p[t] * now
        now = np.where(moves[t][:, None], back @ a.T, back)
        now = now / now.sum(axis=1, keepdims=True)
    joint = (alpha * beta)[step, row]
    pairs = None
    if expected:
        previous = np.concatenate([enter[None], alpha[:-1]])
        right = p * beta
        norm = np.einsum("tbi,ij,tbj->tb", previous, a, right)
        weight = np.where(moves, 1 / norm, 0.0)
        pairs = np.einsum("tbi,tbj,tb->ij", previous, right, weight) * a
    return joint / joint.sum(axis=1, keepdims=True), pairs


def train(texts: list[str], langs: list[str], seed: int = SEED, epochs: int = EPOCHS) -> Model:
    """Fits weights and transitions by Adam on the exact gradient of the conditional likelihood.

    Segments of the labelled texts are strung together in random order, so that the transitions see switches.
    """
    labels = sorted(set(langs))
    if not labels:
        return Model([UNKNOWN], np.zeros((BUCKETS, 1)), np.zeros(0, [("hash", np.uint64), ("language", np.int64)]), np.zeros((0, 1)), np.zeros((1, 1)), np.zeros(1))
    words = words_of(texts)
    code = np.array([labels.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    sequence, gold = [], []
    for i in range(len(texts)):
        at, end = int(words.at[i]), int(words.at[i + 1])
        at += int(rng.integers(0, max(0, end - at - TRAIN_WORDS) + 1))
        taken = 0
        while at < end and taken < TRAIN_WORDS:
            n = min(int(rng.geometric(1 / 30)), end - at)
            sequence.append(words.sequence[at : at + n])
            gold.append(np.full(n, code[i]))
            at, taken = at + n, taken + n
    if not sequence:
        sequence, gold = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    order = rng.permutation(len(sequence))
    flat, gold = np.concatenate([sequence[i] for i in order]), np.concatenate([gold[i] for i in order])
    n, k = len(flat), len(labels)
    counts = np.zeros((len(words.hashes), k))
    np.add.at(counts, (flat, gold), 1)
    rows = []
    for language in range(k):
        own = counts[:, language] - 2 * (counts.sum(axis=1) - counts[:, language])
        best = np.argsort(-own, kind="stable")[:LEXICON]
        best = best[own[best] > 0]
        rows += [(words.hashes[b], language) for b in best]
    lexicon = np.array(rows, [("hash", np.uint64), ("language", np.int64)])
    made = word_features(words)
    members = _members(words, lexicon)
    model = Model(labels, np.zeros((BUCKETS, k)), lexicon, np.zeros((members.shape[1], k)), np.zeros((k, k)), np.zeros(k))
    at = np.append(np.arange(0, n, 400), n) if n else np.zeros(1, np.int64)
    gold_pairs = np.zeros((k, k))
    if n:
        inner = np.ones(n, bool)
        inner[at[:-1]] = False
        np.add.at(gold_pairs, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.weights, model.lexicon_weights, model.transitions, model.start)]
    for epoch in range(1, epochs + 1 if n else 1):
        posterior, pairs = forward_backward(model.scores(words, made)[flat], at, model.transitions, model.start, True)
        posterior[np.arange(n), gold] -= 1
        by_word = np.stack([np.bincount(flat, posterior[:, label], len(words.hashes)) for label in range(k)], axis=1)
        by_bucket = np.stack([np.bincount(made[1], by_word[made[0], label] * made[2], BUCKETS) for label in range(k)], axis=1)
        for x, g, (m, v) in zip((model.weights, model.lexicon_weights, model.transitions, model.start), (by_bucket + 0.5 * model.weights, members.T @ by_word, pairs - gold_pairs, posterior[at[:-1]].sum(axis=0)), state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    return model


def predict(texts: list[str | None], model: Model) -> list[tuple[str, float, int, int, float]]:
    """(language, mean posterior of it over the words, words, switches between neighbouring words, mean of each word's highest posterior) of each whole text; `und`, 0 without a letter."""
    words = words_of([t or "" for t in texts])
    posterior, _ = forward_backward(model.scores(words)[words.sequence], words.at, model.transitions, model.start)
    size = np.diff(words.at)
    sums = np.concatenate([np.zeros((1, posterior.shape[1])), np.cumsum(posterior, axis=0)])
    mean = (sums[words.at[1:]] - sums[words.at[:-1]]) / np.maximum(size, 1)[:, None]
    best = mean.argmax(axis=1)
    sure = np.concatenate([[0.0], np.cumsum(posterior.max(axis=1))])
    sure = (sure[words.at[1:]] - sure[words.at[:-1]]) / np.maximum(size, 1)
    label = posterior.argmax(axis=1)
    switch = np.concatenate([[0], np.cumsum(np.diff(label) != 0), [0]]) if len(label) else np.zeros(2, np.int64)
    out = []
    for i, n in enumerate(size.tolist()):
        if n:
            out.append((model.labels[best[i]], float(min(1.0, max(0.0, mean[i, best[i]]))), n, int(switch[words.at[i + 1] - 1] - switch[words.at[i]]), float(min(1.0, sure[i]))))
        else:
            out.append((UNKNOWN, 0.0, 0, 0, 0.0))
    return out


def labelled_sample(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], list[str]]:
    """About TRAIN_DOCS texts of every language: rows whose hashed key and text fall under the language's share, and of a longer one an excerpt of TRAIN_CHARS characters.  Rows held out by crc32(key) mod 5 = 0 and null languages never are in it."""
    free = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    counts = free.groupBy(F.col(lang).alias("_vx_lang")).agg(F.count(F.lit(1)).alias("_vx_n"))
    counts = docs.sparkSession.createDataFrame(counts.collect(), counts.schema)
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col(key), F.col(text)), F.lit(1 << 30))
    share = F.least(F.lit(1.0), 1.2 * TRAIN_DOCS / F.col("_vx_n")) * (1 << 30)
    begin = F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit(SEED)), F.greatest(F.length(text) - TRAIN_CHARS, F.lit(0)) + 1)
    excerpt = F.col(text).substr((begin + 1).cast("int"), F.lit(TRAIN_CHARS))
    drawn = free.join(F.broadcast(counts), F.col(lang) == F.col("_vx_lang")).where(draw < share)
    rows = drawn.select(lang, excerpt.alias("_vx_excerpt"), draw.alias("_vx_draw"), key).orderBy("_vx_draw", key, "_vx_excerpt").collect()
    return [r[1] for r in rows], [r[0] for r in rows]


def held_out(key):
    return F.coalesce(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns and lang_pred string, score double, n_words and n_switches int, certainty double.  A null text, or one without a letter, is `und` with score 0; input columns of these names are replaced.  Works row by row: repeated rows get equal results, an empty table stays empty, a very long text is read whole, alone in its slice; tied languages go by name."""
    docs = only_new(docs, "lang_pred", "score", "n_words", "n_switches", "certainty")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                found = list(zip(*predict(batch.column(text).to_pylist(), sent.value), strict=True))
                new = [pa.array(c, t) for c, t in zip(found, (pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.float64()), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "lang_pred", "score", "n_words", "n_switches", "certainty"])

    return docs.mapInArrow(run, grown(docs, lang_pred="string", score="double", n_words="integer", n_switches="integer", certainty="double"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(*labelled_sample(docs))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")
