"""Secret scans: three base patterns, and a character convolutional network over every candidate and its context.

Candidates are the base matches and all longest runs of [A-Za-z0-9+/_.=-] of twelve characters or more, with a digit or without.
The network (numpy only) reads a window of the candidate and of what stands around it.  A candidate longer than the
window is read whole, by overlapping windows and by its parts between separators; one that passes is enough.  It is
trained here on labelled findings written by a seeded generator; its scores are calibrated on findings held out from
that, and each shape of candidate has the highest threshold that keeps the recall wanted there, over all and by kind.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from voxloom.llm.common import grown, only_new, slices, table, text_bytes

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "model")
LEAST = {"assign": 12, "access": 18, "hex": 16, "model": 12}
#: Characters of left context, of the candidate and of right context that the network sees.
LEFT, BODY, RIGHT = 24, 40, 8
WIDTH, FILTERS, HIDDEN = 4, 24, 24
RECALL = 0.97
#: Recall kept in each kind of secret that has at least so many calibration findings.
KIND_RECALL, KIND_LEAST = 0.95, 20
FINDINGS = 45000
SEED = 17

_BODY = np.zeros(256, bool)
_BODY[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
REPLACEMENT = "<secret>"


Finding = tuple[str, str, str, int, str]


def findings(n: int = FINDINGS, seed: int = SEED) -> list[Finding]:
    """Labelled findings (left context, candidate, right context, secret or not, kind of secret)."""
    rng = random.Random(seed)
    hexes, digits, letters, capitals = "0123456789abcdef", "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    mixed = letters + capitals + digits

    def some(alphabet: str, low: int, high: int | None = None) -> str:
        return "".join(rng.choices(alphabet, k=rng.randint(low, high or low)))

    def digited(alphabet: str, low: int, high: int) -> str:
        text = some(alphabet, low, high)
        at = rng.randrange(len(text))
        return text[:at] + rng.choice(digits) + text[at + 1 :]

    def word() -> str:
        return some(letters, 2, 9)

    def prose(k: int) -> str:
        return " ".join(rng.choice((word(), word().capitalize(), word() + rng.choice(".,"))) for _ in range(k))

    def secret() -> tuple[str, str, str, str]:
        key = rng.choice(("key", "secret", "token", "password", "passwd", "pwd", "auth", "api_key", "apikey", "access_key", "client_secret", "credential", "private_key", "Authorization: Bearer", "bearer"))
        key = rng.choice((key, key.upper(), key.capitalize()))
        quote = rng.choice(("", '"', "'"))
        kind, make = rng.choice(
            (
                ("hex", lambda: some(hexes, 32, 64)),
                ("hex", lambda: some(hexes, 40)),
                ("mixed", lambda: digited(mixed, 16, 48)),
                ("base64", lambda: digited(mixed + "+/", 24, 60) + "=" * rng.randint(0, 2)),
                ("access key", lambda: "AKIA" + digited(capitals + digits, 16, 16)),
                ("github", lambda: rng.choice(("ghp_", "gho_", "ghs_")) + digited(mixed, 36, 36)),
                ("stripe", lambda: rng.choice(("sk_live_", "pk_live_", "sk-", "rk_")) + digited(mixed, 24, 48)),
                ("slack", lambda: "xoxb-" + some(digits, 11) + "-" + some(mixed, 24)),
                ("gitlab", lambda: rng.choice(("glpat-", "gldt-", "glrt-")) + digited(mixed + "_-", 20, 20)),
                ("google", lambda: "AIza" + digited(mixed + "_-", 35, 35)),
                ("npm", lambda: rng.choice(("npm_", "pypi-", "hf_", "dop_v1_")) + digited(mixed, 34, 40)),
                ("jwt", lambda: "eyJ" + digited(mixed + "-_", 20, 40) + "." + some(mixed, 20, 40) + "." + some(mixed + "-_", 20, 43)),
                ("short", lambda: digited(mixed + "_-.", 12, 20)),
                *[("url password", lambda: digited(mixed + "_-.", 12, 28))] * 2,
                ("url password", lambda: some(letters + capitals, 12, 24)),
                *[("letters", lambda: some(letters + capitals, 12, 40))] * 3,
                ("letters", lambda: some(letters, 14, 32)),
                ("letters", lambda: rng.choice(("ghp_", "sk_live_", "sk-")) + some(letters + capitals, 24, 36)),
            )
        )
        value = make()
        if kind == "url password":
            scheme = rng.choice(("postgres", "postgresql", "mysql", "mongodb", "mongodb+srv", "redis", "amqp", "https", "ftp", "jdbc:mysql"))
            return rng.choice((prose(2) + " ", prose(1) + "=", "url: ", "\n")) + f"{scheme}://{rng.choice((word(), 'admin', 'root', 'user', 'app', ''))}:", value, f"@{word()}{rng.choice(('.example.com', '.internal', '', '-db'))}{rng.choice((':5432', ':3306', ''))}/{word()}", kind
        if kind in ("access key", "github", "stripe", "slack", "gitlab", "google", "npm", "jwt") and rng.random() < 0.6 or len(set(value)) > 18 and len(value) > 30 and rng.random() < 0.2:
            return prose(4) + " ", value, " " + prose(2), kind
        return rng.choice((prose(2) + " ", word() + " ", prose(1) + "\n")) + key + rng.choice((" = ", "=", ": ", ":", " ")) + quote, value, quote + rng.choice((" ", "\n", ";")) + prose(2), kind

    def spoken(low: int, high: int) -> str:
        """A pronounceable word, as long words of prose are."""
        text = "".join(rng.choice(("", "", "s", "st", "tr", "pr", "ch", "th", "b", "c", "d", "f", "g", "l", "m", "n", "p", "r", "t", "v", "h", "w", "sch", "schl", "pf", "gr", "kl", "qu", "wh")) + rng.choice(("a", "e", "i", "o", "u", "ea", "ou", "au", "ie", "io", "eau")) + rng.choice(("", "", "n", "r", "l", "s", "t", "nt", "ss", "ch", "rch", "ng", "x", "d", "pf")) for _ in range(16))
        return text[: rng.randint(low, high)]

    def digitless() -> str:
        some_case = rng.choice((str, str.capitalize, str.upper))
        long = rng.choice(("international", "responsibility", "characteristics", "Verantwortung", "Geschwindigkeitsbegrenzung", "unterschiedliche", "développement", "particulièrement", "establecimiento", "representaciones", "communication", "administrative", "approximately", "understanding")).encode("ascii", "replace").decode().replace("?", "e")
        return rng.choice(
            (
                lambda: some_case(long) + rng.choice(("", "", ".")),
                *[lambda: some_case(spoken(12, 22)) + rng.choice(("", "", "."))] * 4,
                *[lambda: rng.choice((spoken(12, 20), long)).upper() + rng.choice(("", "", "."))] * 3,
                lambda: rng.choice("._-/=").join(some_case(rng.choice((word, lambda: spoken(3, 9)))()) for _ in range(rng.randint(2, 5))),
                lambda: "".join(spoken(3, 8).capitalize() for _ in range(rng.randint(2, 4))),
                lambda: f"{word()}.{word()}.example.{rng.choice(('com', 'org', 'net'))}",
                lambda: f"{spoken(3, 9)}.{spoken(3, 9).capitalize()}",
                lambda: rng.choice("-=._/") * rng.randint(12, 60),
            )
        )()

    def harmless() -> tuple[str, str, str, str]:
        value = digitless() if rng.random() < 0.4 else rng.choice(
            (
                lambda: some(digits, 16),
                lambda: some(digits, 12, 19),
                lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}",
                lambda: f"{word()}_{some(digits, 6, 8)}_{some(digits, 4, 6)}.{rng.choice(('jpg', 'png', 'txt', 'csv', 'wav'))}",
                lambda: f"{word()}.{rng.randint(1, 99)}.{word()}{rng.randint(1, 9)}.example.com",
                lambda: f"mail{rng.randint(1, 9)}.example.{rng.choice(('com', 'org', 'net'))}",
                lambda: f"{word()}/{word()}/{rng.randint(1, 2000)}/{word()}.html",
                lambda: f"{word()}-{word()}-{rng.randint(1, 999)}-{word()}",
                lambda: f"{rng.randint(1, 20)}.{rng.randint(0, 30)}.{rng.randint(0, 99)}-{rng.choice(('alpha', 'beta', 'rc'))}{rng.randint(1, 9)}",
                lambda: word() + word() + some(digits, 1, 3) + word(),
                lambda: "---" * rng.randint(3, 8) + some(digits, 1, 2),
                lambda: "." * rng.randint(9, 30) + some(digits, 1, 3),
                lambda: "=" * rng.randint(11, 30) + some(digits, 1),
                lambda: f"{some(digits, 3)}-{some(digits, 3)}-{some(digits, 4)}-{some(digits, 2)}",
                lambda: f"{word()}{rng.randint(1, 9)}.{word().capitalize()}{rng.randint(1, 9)}.{word()}",
                lambda: f"{rng.choice(('SKU', 'REF', 'ORDER', 'INV'))}-{some(digits, 8, 12)}",
                lambda: f"{word()}_{word()}_v{rng.randint(1, 9)}_{word()}",
                lambda: f"{some(digits, 1, 3)}.{some(digits, 8, 12)}",
            )
        )()
        if len(value) < 12:
            value += some(digits, 12 - len(value)) if any(c in digits for c in value) else spoken(12, 12)[: 12 - len(value)]
        left = rng.choice((prose(4) + " ", prose(4) + " ", prose(4).upper() + " ", spoken(4, 9) + " " + spoken(2, 12) + " ", prose(3) + ": ", "https://", prose(2) + "@", prose(3) + "\n", prose(3) + ".\n", prose(3) + ".\n\n", prose(3).upper() + rng.choice(("! ", "!! ", "!!! ", "!!\n")), prose(2) + " (", prose(1) + "="))
        return left, value, rng.choice((" ", " ", ".\n", ", ", ")", "!! ", "!\n", "? ")) + rng.choice((prose(3), prose(3).upper())), ""

    def at_an_edge(left: str, value: str, right: str, kind: str) -> tuple[str, str, str, str]:
        """Some findings stand near the start or the end of their text."""
        draw = rng.random()
        if 0.15 < draw < 0.2 and left[-1:] in " \n":
            return "", value, "", kind
        return (left[-rng.randint(0, 6) :] if draw < 0.15 and len(left) > 6 and left[-1] in " \n" else left), value, ("" if draw > 0.9 and right[:1] not in ("'", '"', "@") else right), kind

    def inside(label: bool) -> tuple[str, str, str]:
        """A window or a part of a longer candidate: the context belongs to it too."""
        mark = rng.choice("///.-_=")
        filler = lambda: mark * rng.randint(12, 40) if rng.random() < 0.2 else mark.join(rng.choice((word, word, lambda: spoken(3, 9), lambda: some(digits, 1, 5), lambda: spoken(4, 9).capitalize(), lambda: spoken(12, 16)))() for _ in range(rng.randint(4, 9))) + mark
        before, after = filler() + filler(), mark + filler() + filler()
        if not label:
            whole, at = before + after[1:], rng.randint(0, len(before))
            size = min(BODY, len(whole) - at)
            return whole[:at], whole[at : at + size], whole[at + size :]
        value = rng.choice((some(mixed, 20, 48), some(hexes, 32, 64), some(letters + capitals, 24, 40), "AKIA" + some(capitals + digits, 16), "ghp_" + some(mixed, 36)))
        whole, at, end = before + value + after, len(before), len(before) + len(value)
        if rng.random() < 0.5:  # a window that holds a whole token or much of it
            at = max(0, at - rng.randint(0, max(0, BODY - min(len(value), BODY // 2))))
            end = min(len(whole), at + BODY)
        return whole[:at], whole[at:end], whole[end:]

    def nested(label: bool) -> tuple[str, str, str, str]:
        left, value, right = inside(label)
        return prose(2) + " " + left, value, right + " " + prose(1), "nested" if label else ""

    def drawn(label: bool) -> tuple[str, str, str, str]:
        if rng.random() < 0.15:
            return nested(label)
        return at_an_edge(*(secret() if label else harmless()))

    return [(*found[:3], label, found[3]) for label, found in ((label, drawn(label)) for label in (rng.random() < 0.5 for _ in range(n)))]


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What a candidate is made of: 0 no digit, 1 hexadecimal digits only, 2 anything else."""
    digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    hexes = np.concatenate([[0], np.cumsum(_HEX[data])])
    return np.where(digits[ends] == digits[starts], 0, np.where(hexes[ends] - hexes[starts] == ends - starts, 1, 2))


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Codes (1..128; 0 outside of the text) of left context, candidate and right context of candidates in one buffer; a long candidate shows its first three quarters of BODY and its last quarter."""
    head = BODY * 3 // 4
    at = np.empty((len(starts), LEFT + BODY + RIGHT), np.int64)
    at[:, :LEFT] = starts[:, None] - LEFT + np.arange(LEFT)
    body = np.arange(BODY)
    n = (ends - starts)[:, None]
    tail = np.where(n > BODY, n - BODY + body, body)
    at[:, LEFT : LEFT + BODY] = starts[:, None] + np.where(body < head, body, tail)
    at[:, LEFT + BODY :] = ends[:, None] + np.arange(RIGHT)
    seen = (at >= low[:, None]) & (at < high[:, None])
    seen[:, LEFT : LEFT + BODY] &= at[:, LEFT : LEFT + BODY] < ends[:, None]
    codes = np.minimum(data[np.clip(at, 0, max(0, len(data) - 1))] if len(data) else at * 0, 127).astype(np.int64) + 1
    return np.where(seen, codes, 0)


@dataclass
class Network:
    """Convolution by table lookup, maxima over left context, candidate and right context, one hidden layer, calibrated sigmoid."""

    tables: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    #: By shape; the figures are those of findings that neither training nor thresholds have seen.
    thresholds: np.ndarray = field(default_factory=lambda: np.full(3, 0.5))
    recall: float = 0.0
    precision: float = 0.0
    recalls: dict[str, float] = field(default_factory=dict)

    PARTS = ((0, LEFT - WIDTH + 1), (LEFT - 2, LEFT + BODY - WIDTH + 1), (LEFT + BODY - 2, LEFT + BODY + RIGHT - WIDTH + 1))

    def layers(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        positions = codes.shape[1] - WIDTH + 1
        h = self.bias + sum(self.tables[w][codes[:, w : w + positions]] for w in range(WIDTH))
        picks, tops = [], []
        for low, high in self.PARTS:
            pick = h[:, low:high].argmax(axis=1)
            tops.append(np.take_along_axis(h[:, low:high], pick[:, None], axis=1)[:, 0])
            picks.append(pick + low)
        body = codes[:, LEFT : LEFT + BODY]
        length = (body > 0).sum(axis=1)
        order = np.sort(body, axis=1)
        kinds = ((np.diff(order, axis=1) > 0) & (order[:, 1:] > 0)).sum(axis=1)
        x = np.concatenate([np.maximum(np.concatenate(tops, axis=1), 0), np.stack([length / BODY, kinds / np.maximum(length, 1), ((body >= 49) & (body <= 58)).sum(axis=1) / np.maximum(length, 1)], axis=1)], axis=1)
        z = np.maximum(x @ self.hidden + self.hidden_bias, 0)
        return np.concatenate(picks, axis=1), x, z, (z @ self.out + self.out_bias)[:, 0]

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        logits = [self.layers(codes[i : i + 512])[-1] for i in range(0, len(codes), 512)]
        return 1 / (1 + np.exp(-np.clip(self.scale * np.concatenate([*logits, np.zeros(0)]) + self.shift, -50, 50)))


def _codes(rows: list[Finding]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, shapes) of findings."""
    buffers = [(a + b + c).encode() for a, b, c, *_ in rows]
    data = np.frombuffer(b"".join(buffers), np.uint8)
    low = np.cumsum([0, *map(len, buffers)])
    starts = low[:-1] + [len(a.encode()) for a, *_ in rows]
    ends = starts + [len(b.encode()) for _, b, *_ in rows]
    return windows(data, starts, ends, low[:-1], low[1:]), shapes(data, starts, ends)


@functools.lru_cache(maxsize=4)
def trained(n: int = FINDINGS, recall: float = RECALL, seed: int = SEED, epochs: int = 9) -> Network:
    """The network fitted on two thirds of the findings by Adam; calibration (Platt) and thresholds from one sixth, recall and precision from the last.

    Each shape has the highest threshold that keeps `recall` among its secrets and KIND_RECALL among those of each kind.
    """
    rows = findings(n, seed)
    (codes, shape), y = _codes(rows), np.array([r[3] for r in rows], float)
    kinds = np.array([r[4] for r in rows])
    cut, end = n * 4 // 6, n * 5 // 6
    rng = np.random.default_rng(seed)
    inputs = 3 * FILTERS + 3
    net = Network(
        rng.normal(0, 0.15, (WIDTH, 129, FILTERS)), np.zeros(FILTERS), rng.normal(0, inputs**-0.5, (inputs, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)), np.zeros(1)
    )
    held = [net.tables, net.bias, net.hidden, net.hidden_bias, net.out, net.out_bias]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in held]
    step = 0
    for _ in range(epochs):
        for own in np.array_split(rng.permutation(cut), max(1, cut // 128)):
            step += 1
            picks, x, z, logit = net.layers(codes[own])
            g = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y[own])[:, None] / len(own)
            dz = (g @ net.out.T) * (z > 0)
            dx = (dz @ net.hidden.T)[:, : 3 * FILTERS] * (x[:, : 3 * FILTERS] > 0)
            dt = np.zeros_like(net.tables)
            filters = np.tile(np.arange(FILTERS), 3)
            for w in range(WIDTH):
                np.add.at(dt[w], (np.take_along_axis(codes[own], picks + w, axis=1), filters[None, :]), dx)
            grads = [dt, dx.reshape(-1, 3, FILTERS).sum(axis=(0, 1)), x.T @ dz, dz.sum(axis=0), z.T @ g, g.sum(axis=0)]
            for p, grad, (m, v) in zip(held, grads, state, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    logit = np.concatenate([net.layers(codes[i : min(end, i + 512)])[-1] for i in range(cut, end, 512)])
    truth = y[cut:end]
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(net.scale * logit + net.shift, -50, 50)))
        net.scale -= 0.05 * float(((p - truth) * logit).mean())
        net.shift -= 0.2 * float((p - truth).mean())
    p = net.scores(codes[cut:end])
    net.thresholds = np.ones(3)
    for own_shape in range(3):
        secret = (truth == 1) & (shape[cut:end] == own_shape)
        for kind, least in [("", recall), *((k, KIND_RECALL) for k in sorted(set(kinds[cut:end][secret])))]:
            own = np.sort(p[secret & (kinds[cut:end] == kind)] if kind else p[secret])
            if len(own) >= (KIND_LEAST if kind else 1):
                net.thresholds[own_shape] = min(net.thresholds[own_shape], float(own[int((1 - least) * len(own))]))
    truth, found = y[end:] == 1, net.scores(codes[end:]) >= net.thresholds[shape[end:]]
    net.recall, net.precision = float((found & truth).sum() / max(1, truth.sum())), float((found & truth).sum() / max(1, found.sum()))
    net.recalls = {k: float(found[truth & (kinds[end:] == k)].mean()) for k in sorted(set(kinds[end:][truth]))}
    return net


def _runs(mask: np.ndarray, cut: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest runs of `mask` that stay inside a text, of at least `least` bytes."""
    before, after = np.concatenate([[False], mask[:-1]]), np.concatenate([mask[1:], [False]])
    starts = np.flatnonzero(mask & (~before | cut[:-1]))
    ends = np.flatnonzero(mask & (~after | cut[1:])) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(b"/._=-")] = True


def units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(candidate number, start, end) of what the network reads: each candidate, and of one longer than BODY also windows of BODY at every half of it and the parts between separators, so that every byte is seen."""
    own, low, high = [np.arange(len(starts))], [starts], [ends]
    for i in np.flatnonzero(ends - starts > BODY).tolist():
        s, e = int(starts[i]), int(ends[i])
        at = np.append(np.arange(s, e - BODY, BODY // 2), e - BODY)
        bounds = np.concatenate([[s - 1], s + np.flatnonzero(_SEPARATOR[data[s:e]]), [e]])
        part = np.flatnonzero(np.diff(bounds) - 1 >= LEAST["model"])
        low += [at, bounds[part] + 1]
        high += [at + BODY, bounds[part + 1]]
        own.append(np.full(len(at) + len(part), i))
    return np.concatenate(own), np.concatenate(low), np.concatenate(high)


def _hits(data: bytes, needle: bytes) -> list[int]:
    out, at = [], data.find(needle)
    while at >= 0:
        out.append(at)
        at = data.find(needle, at + 1)
    return out


Span = tuple[str, int, int, float]


def scan(column: pa.Array, net: Network) -> list[list[Span]]:
    """(kind, start, end, score) by code points of each text: all base matches, and candidates apart from them that reach the threshold; by start, then kind."""
    data, offsets = text_bytes(column)
    out: list[list[Span]] = [[] for _ in range(len(column))]
    if not len(data):
        return out
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    base: list[tuple[int, str, int, int]] = []
    raw = data.tobytes()

    def owners(places: list[int]) -> list[int]:
        return sorted(set((np.searchsorted(offsets, places, side="right") - 1).tolist())) if places else []

    low = _LOWER[data].tobytes()
    for kind, pattern, docs in (("assign", ASSIGN, owners([p for k in KEYWORDS for p in _hits(low, k)])), ("access", ACCESS, owners(_hits(raw, b"AKIA")))):
        for d in docs:
            begin = int(offsets[d])
            text = raw[begin : int(offsets[d + 1])].decode()
            plain = len(text) == offsets[d + 1] - begin
            for m in pattern.finditer(text):
                value = m.start(2) if kind == "assign" else m.start()
                if m.end() - value >= LEAST[kind]:
                    shift = begin if plain else begin + len(text[: m.start()].encode()) - m.start()
                    base.append((d, kind, m.start() + shift, m.end() + shift))
    starts, ends = _runs(_HEX[data], cut, LEAST["hex"])
    base += zip((np.searchsorted(offsets, starts, side="right") - 1).tolist(), ["hex"] * len(starts), starts.tolist(), ends.tolist(), strict=True)
    starts, ends = _runs(_BODY[data], cut, LEAST["model"])
    more = list(zip((np.searchsorted(offsets, starts, side="right") - 1).tolist(), ["model"] * len(starts), starts.tolist(), ends.tolist(), strict=True))
    every = base + more
    if not every:
        return out
    doc, start, end = (np.array([c[i] for c in every]) for i in (0, 2, 3))
    # a base match of kind assign is judged by its value
    begin = np.array([s + ASSIGN.match(raw[s:e].decode("ascii")).start(2) if kind == "assign" else s for _, kind, s, e in every])
    own, low_end, high_end = units(data, begin, end)
    score, passed = np.zeros(len(every)), np.zeros(len(every), bool)
    shape = shapes(data, low_end, high_end)
    step = 1 << 14
    for i in range(0, len(own), step):
        some = slice(i, i + step)
        p = net.scores(windows(data, low_end[some], high_end[some], offsets[doc[own[some]]], offsets[doc[own[some]] + 1]))
        np.maximum.at(score, own[some], p)
        np.logical_or.at(passed, own[some], p >= net.thresholds[shape[some]])
    # offsets are of the one buffer of all texts, so the base spans of all texts are one list: by start, with the furthest end so far
    taken = np.array(sorted((s, e) for _, _, s, e in base), np.int64).reshape(-1, 2)
    reach = np.maximum.accumulate(taken[:, 1]) if len(taken) else taken[:, 1]
    before = np.searchsorted(taken[:, 0], end, side="left")
    apart = np.ones(len(every), bool)
    apart[before > 0] = reach[before[before > 0] - 1] <= start[before > 0]
    for (d, kind, s, e), p, good in zip(every, score.tolist(), (passed & apart).tolist(), strict=True):
        if kind == "model" and not good:
            continue
        out[d].append((kind, int(points[s] - points[offsets[d]]), int(points[e] - points[offsets[d]]), p))
    for spans in out:
        spans.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
_SPANS_SQL = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_secrets(docs: DataFrame, text: str = "text", net: Network | None = None) -> DataFrame:
    """All columns and secrets array<struct<kind, start, end, score>> (code points, end exclusive).  A null or empty text has none; a column named secrets is replaced.  Works row by row: repeated rows get the same spans, an empty table stays empty, a very long text is read whole, alone in its slice.  Spans that start together go by kind."""
    docs = only_new(docs, "secrets")
    sent = docs.sparkSession.sparkContext.broadcast(net or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans] for spans in scan(batch.column(text), sent.value)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _SPANS)], [*batch.schema.names, "secrets"])

    return docs.mapInArrow(run, grown(docs, secrets=_SPANS_SQL))


def masked(text: str, spans: list[Span]) -> str:
    """`text` with every span, overlapping ones together, replaced by `<secret>`."""
    parts, at = [], 0
    for _, start, end, _ in spans:
        if start >= at:
            parts += (text[at:start], REPLACEMENT)
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text", size: str = "n_chars", net: Network | None = None) -> DataFrame:
    """The same columns with all secrets masked in the text, and `size`, if there, counted anew for the texts that change.  A null text stays null; repeated rows change alike, an empty table stays empty, very long texts are masked whole; other columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(net or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                found = scan(batch.column(text), sent.value)
                if not any(found):
                    yield batch
                    continue
                columns = {n: batch.column(n) for n in batch.schema.names}
                texts = columns[text].to_pylist()
                new = [masked(t, s) if s else t for t, s in zip(texts, found, strict=True)]
                columns[text] = pa.array(new, batch.schema.field(text).type)
                if size in columns:
                    columns[size] = pa.array([len(t) if s else n for t, s, n in zip(new, found, columns[size].to_pylist(), strict=True)], batch.schema.field(size).type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_model", pa.int64()), ("top_score", pa.float64())])


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind and digests of column secrets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, spans in zip(batch.column("doc_id").to_pylist(), batch.column("secrets").to_pylist(), strict=True):
                kinds = [s["kind"] for s in spans]
                named = [f"{s['kind']}:{s['start']}:{s['end']}" for s in spans]
                base = ",".join(n for n, k in zip(named, kinds, strict=True) if k != "model")
                rows.append((doc, *map(kinds.count, KINDS[:3]), hashlib.sha256(base.encode()).hexdigest(), ",".join(named), kinds.count("model"), max((round(s["score"], 6) for s in spans), default=0.0)))
            columns = list(zip(*rows, strict=True)) or [()] * len(RESULT)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, RESULT.types, strict=True)], schema=RESULT)

    return found.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long, top_score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(find_secrets(docs).select("doc_id", "secrets"))
