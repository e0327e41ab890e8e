"""FLAC as a media column: whole-array encoder and decoder for mono streams, and a plain decoder for any stream.

The encoder cuts the samples into frames, takes the best of the fixed linear predictors and a Rice parameter for each,
and writes checksums and a seek table with one point a frame.  The decoder finds the frames by the seek table, checks
their CRCs, decodes the Rice residuals of many frames in step, undoes the predictors and verifies the MD5.  Streams
without a full seek table, and frames of a kind that the fast path leaves out, go through the plain decoder.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from voxloom.llm.common import grown, only_new, slices, table

BLOCK = 1024
#: Samples in a PCM block.
PCM_SAMPLES = 4096
RATE = 8000
#: Frames that are worked on at once.
LANES = 1024
UNIT = 64


def _crc_table(poly: int, bits: int, words: int) -> np.ndarray:
    """CRC of every value of `words` bits (from a zero register) by one bit at a time."""
    out = np.arange(1 << words, dtype=np.uint32) << (bits - words if bits > words else 0)
    for _ in range(words):
        top = (out >> (bits - 1)) & 1
        out = ((out << 1) & ((1 << bits) - 1)) ^ (top * poly)
    return out.astype(np.uint32)


_CRC8 = _crc_table(0x07, 8, 8).astype(np.uint8).tolist()
_CRC16 = _crc_table(0x8005, 16, 16)
_FIRST_BIT = np.full(1 << 16, 16, np.int64)
for _i in range(16):
    _FIRST_BIT[1 << (15 - _i) : 1 << (16 - _i)] = _i


def crc8(data: bytes) -> int:
    crc = 0
    for byte in data:
        crc = _CRC8[crc ^ byte]
    return crc


def crc16_many(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-16 of many byte ranges; zeros in front leave a zero register as it is."""
    most = int(lengths.max(initial=0) + 1) // 2 * 2
    at = (starts + lengths - most)[:, None] + np.arange(most)
    bytes_ = np.where(at >= starts[:, None], data[np.maximum(at, 0)], 0).astype(np.uint32)
    words = np.ascontiguousarray(((bytes_[:, 0::2] << 8) | bytes_[:, 1::2]).T)
    crc = np.zeros(len(starts), np.uint32)
    for word in words:
        crc = _CRC16[crc ^ word]
    return crc


def _number(n: int) -> bytes:
    """The UTF-8-like code of a frame number, up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    room = 0x3F
    while n > room:
        tail.append(0x80 | (n & 0x3F))
        n >>= 6
        room >>= 1
    return bytes([(0xFE << (room.bit_length())) & 0xFF | n, *reversed(tail)])


def _frame_header(size: int, number: int) -> bytes:
    if size >= 256 and size & (size - 1) == 0 and size <= 32768:
        code, extra = size.bit_length() - 1, b""
    elif size <= 256:
        code, extra = 6, bytes([size - 1])
    else:
        code, extra = 7, (size - 1).to_bytes(2, "big")
    head = bytes([0xFF, 0xF8, code << 4 | 4, 0x02]) + _number(number) + extra
    return head + bytes([crc8(head)])


def _put(out: np.ndarray, at: np.ndarray, value: np.ndarray, bits: np.ndarray | int) -> np.ndarray:
    """Adds values of at most 17 bits at bit places; fields never overlap, so a sum is an or."""
    byte = at >> 3
    wide = value << (24 - (at & 7) - bits)
    for i in range(3):
        out += np.bincount(byte + i, weights=(wide >> (16 - 8 * i)) & 255, minlength=len(out))[: len(out)].astype(np.uint8)
    return out


def _encode_frames(x: np.ndarray, sizes: np.ndarray, headers: list[bytes]) -> list[bytes]:
    """Frames of consecutive runs of signed 8-bit samples."""
    first = np.cumsum(sizes) - sizes
    frame = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(x)) - first[frame]
    residuals = [x]
    for order in range(1, 5):
        d = np.diff(residuals[-1], prepend=0)
        d[place < order] = 0
        residuals.append(d)
    weight = np.array([np.add.reduceat(np.abs(r), first) for r in residuals[:5]])
    order = weight.argmin(axis=0)
    same = np.minimum.reduceat(x, first) == np.maximum.reduceat(x, first)
    coded = place >= order[frame]
    r = np.choose(order[frame], residuals)[coded]
    lane = frame[coded]
    folded = (r << 1) ^ (r >> 63)
    n = sizes - order
    begin = np.cumsum(n) - n
    mean = np.add.reduceat(folded, begin) / n
    k = np.clip(np.ceil(np.log2(np.maximum(mean, 1) * 0.6931)), 0, 14).astype(np.int64)
    kk = k[lane]
    length = (folded >> kk) + 1 + kk
    ends = np.cumsum(length)
    bits = np.add.reduceat(length, begin)
    bits = np.where(same, 0, bits)
    header = np.array([len(h) for h in headers])
    body = np.where(same, 16, 8 + 8 * order + 10 + bits)
    total = header + (body + 7) // 8 + 2
    start = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    at = 8 * (start + header) + 18 + 8 * order
    live = ~same[lane]
    begun = (ends[begin] - length[begin])[lane]
    _put(out, (at[lane] + ends - begun - kk - 1)[live], ((1 << kk) | (folded & ((1 << kk) - 1)))[live], (kk + 1)[live])
    _put(out, (at - 4)[~same], k[~same], 4)
    kind = np.where(same, 0, (8 | order) << 1)
    out[start + header] = kind
    for i in range(4):
        has = np.flatnonzero((order > i) & ~same)
        out[start[has] + header[has] + 1 + i] = x[first[has] + i].astype(np.uint8)
    out[(start + header + 1)[same]] = x[first[same]].astype(np.uint8)
    for s, h in zip(start.tolist(), headers, strict=True):
        out[s : s + len(h)] = np.frombuffer(h, np.uint8)
    crc = crc16_many(out, start, total - 2)
    out[start + total - 2], out[start + total - 1] = crc >> 8, crc & 255
    raw = out.tobytes()
    return [raw[s : s + t] for s, t in zip(start.tolist(), total.tolist(), strict=True)]


def encode(payloads: list[bytes], block: int = BLOCK) -> list[bytes]:
    """FLAC streams, one a payload of at least 16 bytes; byte b is the 8-bit sample b - 128."""
    jobs = [(i, at, min(block, len(p) - at)) for i, p in enumerate(payloads) for at in range(0, len(p), block)]
    frames: list[list[bytes]] = [[] for _ in payloads]
    for j in range(0, len(jobs), LANES):
        part = jobs[j : j + LANES]
        x = np.frombuffer(b"".join(payloads[i][at : at + n] for i, at, n in part), np.uint8).astype(np.int64) - 128
        for (i, _, _), data in zip(part, _encode_frames(x, np.array([n for *_, n in part]), [_frame_header(n, at // block) for _, at, n in part]), strict=True):
            frames[i].append(data)
    out = []
    for payload, own in zip(payloads, frames, strict=True):
        sizes = [len(f) for f in own]
        signed = (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
        packed = RATE << 44 | 0 << 41 | 7 << 36 | len(payload)
        info = block.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + packed.to_bytes(8, "big") + hashlib.md5(signed).digest()
        points = np.zeros(len(own), [("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
        points["sample"] = np.arange(len(own)) * block
        points["offset"] = np.cumsum(sizes) - sizes
        points["n"] = block
        points["n"][-1] = len(payload) - (len(own) - 1) * block
        seek = points.tobytes()
        out.append(b"fLaC\x00\x00\x00\x22" + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + b"".join(own))
    return out


class Corrupt(ValueError):
    """A stream that breaks its own checksums or the format."""


class _Bits:
    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at * 8

    def take(self, n: int) -> int:
        if not n:
            return 0
        byte, end = self.at >> 3, (self.at + n + 7) >> 3
        if end > len(self.data):
            raise Corrupt("the stream ends too early")
        value = int.from_bytes(self.data[byte:end], "big") >> (end * 8 - self.at - n)
        self.at += n
        return value & ((1 << n) - 1)

    def signed(self, n: int) -> int:
        value = self.take(n)
        return value - (1 << n) if n and value >> (n - 1) else value

    def unary(self) -> int:
        n = 0
        while not self.take(1):
            n += 1
        return n


_FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
_RATES = (0, 88200, 176400, 192000, 8000, 16000, 22050, 24000, 32000, 44100, 48000, 96000)
_DEPTHS = (0, 8, 12, 0, 16, 20, 24, 32)


def _header(data: bytes, at: int, info: dict) -> tuple[int, int, int, int]:
    """(block size, channel code, bits a sample, header bytes) of the frame at `at`, its CRC-8 verified."""
    if data[at : at + 1] != b"\xff" or len(data) < at + 6 or data[at + 1] & 0xFE != 0xF8:
        raise Corrupt(f"no frame at {at}")
    code, rate, end = data[at + 2] >> 4, data[at + 2] & 15, at + 5
    lead = data[at + 4]
    while lead & 0x80 and lead & 0x40:
        end, lead = end + 1, lead << 1
    if code == 1:
        size = 192
    elif code < 6:
        size = 576 << (code - 2)
    elif code < 8:
        size = int.from_bytes(data[end : end + code - 5], "big") + 1
        end += code - 5
    else:
        size = 256 << (code - 8)
    end += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if crc8(data[at:end]) != data[end]:
        raise Corrupt(f"CRC-8 of the frame at {at}")
    return size, data[at + 3] >> 4, _DEPTHS[data[at + 3] >> 1 & 7] or info["bits"], end + 1 - at


def _subframe(bits: _Bits, size: int, depth: int) -> list[int]:
    bits.take(1)
    kind = bits.take(6)
    wasted = 0
    if bits.take(1):
        wasted = bits.unary() + 1
        depth -= wasted
    if kind == 0:
        x = [bits.signed(depth)] * size
    elif kind == 1:
        x = [bits.signed(depth) for _ in range(size)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 31 if kind >= 32 else kind - 8
        x = [bits.signed(depth) for _ in range(order)]
        taps, shift = _FIXED[order] if kind < 32 else (), 0
        if kind >= 32:
            precision = bits.take(4) + 1
            shift = bits.signed(5)
            taps = tuple(bits.signed(precision) for _ in range(order))
        width = 5 if bits.take(2) else 4
        parts = bits.take(4)
        for part in range(1 << parts):
            n = (size >> parts) - (0 if part else order)
            k = bits.take(width)
            raw = bits.take(5) if k == (1 << width) - 1 else None
            for _ in range(n):
                if raw is not None:
                    r = bits.signed(raw)
                else:
                    u = bits.unary() << k | bits.take(k)
                    r = (u >> 1) ^ -(u & 1)
                x.append((sum(c * v for c, v in zip(taps, reversed(x[-order:] if order else []), strict=True)) >> shift) + r)
    else:
        raise Corrupt(f"subframe type {kind}")
    return [v << wasted for v in x] if wasted else x


def decode_frame(data: bytes, at: int, info: dict) -> tuple[list[list[int]], int]:
    """(samples by channel, place after the frame), both CRCs verified."""
    size, channels, depth, head = _header(data, at, info)
    bits = _Bits(data, at + head)
    n = channels + 1 if channels < 8 else 2
    side = {8: 1, 9: 0, 10: 1}.get(channels)
    x = [_subframe(bits, size, depth + (c == side)) for c in range(n)]
    if channels == 8:
        x[1] = [a - b for a, b in zip(*x, strict=True)]
    elif channels == 9:
        x[0] = [a + b for a, b in zip(*x, strict=True)]
    elif channels == 10:
        mid = [(a << 1) | (b & 1) for a, b in zip(*x, strict=True)]
        x = [[(m + s) >> 1 for m, s in zip(mid, x[1], strict=True)], [(m - s) >> 1 for m, s in zip(mid, x[1], strict=True)]]
    end = (bits.at + 7) >> 3
    own = np.frombuffer(data, np.uint8)
    if int(crc16_many(own, np.array([at]), np.array([end - at]))[0]) != int.from_bytes(data[end : end + 2], "big"):
        raise Corrupt(f"CRC-16 of the frame at {at}")
    return x, end + 2


def stream_info(data: bytes) -> dict:
    """STREAMINFO, seek points (sample, offset from the first frame, samples) and the place of the first frame."""
    if data[:4] != b"fLaC":
        raise Corrupt("no FLAC stream")
    at, info, last = 4, {"seek": np.zeros(0, [("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])}, False
    while not last:
        kind, n = data[at], int.from_bytes(data[at + 1 : at + 4], "big")
        last, body = bool(kind & 0x80), data[at + 4 : at + 4 + n]
        if kind & 0x7F == 0:
            packed = int.from_bytes(body[10:18], "big")
            info |= {"rate": packed >> 44, "channels": (packed >> 41 & 7) + 1, "bits": (packed >> 36 & 31) + 1, "samples": packed & (1 << 36) - 1, "md5": body[18:34]}
        elif kind & 0x7F == 3:
            info["seek"] = np.frombuffer(body, info["seek"].dtype)
        at += 4 + n
    return info | {"first": at}


def decode_any(data: bytes) -> tuple[dict, list[list[int]]]:
    """(stream info, samples by channel) of any FLAC stream, frame after frame; MD5 verified where one is given."""
    info = stream_info(data)
    at, x = info["first"], [[] for _ in range(info["channels"])]
    while at < len(data):
        part, at = decode_frame(data, at, info)
        for own, new in zip(x, part, strict=True):
            own += new
    width = (info["bits"] + 7) // 8
    raw = b"".join(v.to_bytes(width, "little", signed=True) for row in zip(*x, strict=True) for v in row)
    if any(info["md5"]) and hashlib.md5(raw).digest() != info["md5"]:
        raise Corrupt("MD5 of the samples")
    return info, x


def _decode_lanes(data: np.ndarray, at: np.ndarray, size: np.ndarray, head: np.ndarray, ends: np.ndarray) -> list[np.ndarray | None]:
    """Signed samples of mono 8-bit frames with one Rice partition; None for a frame of another kind.  `data` has 8 spare bytes."""
    kind = data[at + head].astype(np.int64)
    order = (kind >> 1) - 8
    constant = kind == 0
    fixed = (kind & 1 == 0) & (order >= 0) & (order <= 4)
    place = 8 * (at + head + 1 + np.where(fixed, order, 0))
    two = (data[place >> 3].astype(np.int64) << 8) | data[(place >> 3) + 1]
    k = (two >> 6) & 15
    fixed &= (two >> 10 == 0) & (k < 15)
    out: list[np.ndarray | None] = [None] * len(at)
    for i in np.flatnonzero(constant):
        out[i] = np.full(size[i], data[at[i] + head[i] + 1].astype(np.int8), np.int64)
    lanes = np.flatnonzero(fixed)
    if not len(lanes):
        return out
    count = size[lanes] - order[lanes]
    by_length = np.argsort(-count, kind="stable")
    lanes, count = lanes[by_length], count[by_length]
    low = int(at.min())
    window = np.lib.stride_tricks.sliding_window_view(data[low : int(ends.max()) + 8], 8)
    window = np.ascontiguousarray(window).view(">u8").reshape(-1).astype(np.uint64)
    pos, kk = place[lanes] + 10 - 8 * low, k[lanes]
    rest = np.uint64(63) - kk.astype(np.uint64)
    codes = np.zeros((int(count[0]), len(lanes)), np.int64)
    active = np.searchsorted(-count, -np.arange(len(codes)), side="left")
    limit = 8 * (len(window) - 1)
    for t in range(len(codes)):
        n = active[t]
        p = pos[:n]
        w = window[p >> 3] << (p & 7).astype(np.uint64)
        q = _FIRST_BIT[(w >> np.uint64(48)).astype(np.int64)]
        if (q == 16).any():
            for i in np.flatnonzero(q == 16):
                ones, start = 0, int(p[i])
                while not (int(data[low + (start + ones >> 3)]) >> (7 - (start + ones & 7))) & 1:
                    ones += 1
                    if start + ones > limit:
                        raise Corrupt("the stream ends too early")
                q[i] = ones
            p = p + q
            w = window[p >> 3] << (p & 7).astype(np.uint64)
            r = (w << np.uint64(1)) >> np.uint64(1) >> rest[:n]
            pos[:n] = p + 1 + kk[:n]
        else:
            r = (w << (q + 1).astype(np.uint64)) >> np.uint64(1) >> rest[:n]
            pos[:n] = p + q + 1 + kk[:n]
        codes[t, :n] = (q << kk[:n]) | r.astype(np.int64)
        np.minimum(pos, limit, out=pos)
    residual = (codes >> 1) ^ -(codes & 1)
    for o in range(5):
        own = np.flatnonzero(order[lanes] == o)
        if not len(own):
            continue
        x = np.concatenate([np.zeros((o, len(own)), np.int64), residual[:, own]])
        warm = np.array([data[at[lanes[own]] + head[lanes[own]] + 1 + i].astype(np.int8) for i in range(o)], np.int64).reshape(o, len(own))
        levels = [warm]
        for _ in range(o):
            levels.append(np.diff(levels[-1], axis=0))
        for depth in range(o, 0, -1):
            # x holds differences of this depth from row `depth` on; its start comes from the warm-up samples
            x[depth - 1] = levels[depth - 1][0]
            x[depth - 1 :] = np.cumsum(x[depth - 1 :], axis=0)
        if o:
            x[:o] = warm
        for j, i in enumerate(own):
            out[lanes[i]] = x[: size[lanes[i]], j]
    return out


def decode(streams: list[bytes]) -> list[bytes]:
    """The payloads of streams that `encode` made, or any mono 8-bit streams; raises Corrupt when a checksum fails."""
    infos = [stream_info(s) for s in streams]
    parts: list[list[bytes]] = [[] for _ in streams]
    jobs = []
    for i, (data, info) in enumerate(zip(streams, infos, strict=True)):
        if info["bits"] != 8 or info["channels"] != 1:
            raise Corrupt("not a mono 8-bit stream")
        seek = info["seek"]
        if not len(seek) or int(seek["sample"][-1]) + int(seek["n"][-1]) != info["samples"] or (np.diff(seek["sample"].astype(np.int64)) != seek["n"][:-1]).any():
            parts[i] = [(np.array(decode_any(data)[1][0], np.int64) + 128).astype(np.uint8).tobytes()]
            continue
        starts = info["first"] + seek["offset"].astype(np.int64)
        jobs += [(i, s, e) for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(data)], strict=True)]
    for j in range(0, len(jobs), LANES):
        own = jobs[j : j + LANES]
        heads = [_header(streams[i], s, infos[i]) for i, s, _ in own]
        data = np.frombuffer(b"".join(streams[i][s:e] for i, s, e in own) + bytes(16), np.uint8)
        length = np.array([e - s for _, s, e in own])
        at = np.cumsum(length) - length
        crc = crc16_many(data, at, length - 2)
        if (crc != (data[at + length - 2].astype(np.uint32) << 8 | data[at + length - 1])).any():
            raise Corrupt("CRC-16 of a frame")
        size, head = np.array([h[0] for h in heads]), np.array([h[3] for h in heads])
        for (i, s, _), x in zip(own, _decode_lanes(data, at, size, head, at + length), strict=True):
            if x is None:
                x = np.array(decode_frame(streams[i], s, infos[i])[0][0], np.int64)
            parts[i].append((x + 128).astype(np.uint8).tobytes())
    out = [b"".join(p) for p in parts]
    for payload, info in zip(out, infos, strict=True):
        if len(payload) != info["samples"] or any(info["md5"]) and hashlib.md5((np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()).digest() != info["md5"]:
            raise Corrupt("MD5 of the samples")
    return out


def padded(text: bytes) -> bytes:
    """Zeros up to a positive multiple of 64 bytes."""
    return text + bytes(max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text))


def blocks_of(streams: list[bytes], samples: int) -> Iterator[list[tuple[int, bytes]]]:
    """For each stream its PCM blocks (sample offset, signed 8-bit samples), so that sample s is in block s div `samples`."""
    for payload in decode(streams):
        pcm = np.frombuffer(payload, np.uint8) ^ 0x80
        yield [(i, pcm[i : i + samples].tobytes()) for i in range(0, len(pcm), samples)]


class Summary:
    """Digests and features of a payload, gathered from its PCM blocks in order."""

    def __init__(self, blocks: list[tuple[int, bytes]]):
        self.count = self.total = self.squares = self.peak = self.crossings = self.steps = 0
        self._sha, self._tail, self._last = hashlib.sha256(), b"", None
        for offset, pcm in blocks:
            if offset != self.count:
                raise Corrupt("a PCM block is out of its place")
            self._add(pcm)

    def _add(self, pcm: bytes) -> None:
        x = np.frombuffer(pcm, np.int8).astype(np.int64)
        payload = (np.frombuffer(pcm, np.uint8) ^ 0x80).tobytes()
        self._sha.update(payload)
        self._tail = (self._tail + payload)[-UNIT:]
        self.count, self.total, self.squares, self.peak = self.count + len(x), self.total + int(x.sum()), self.squares + int((x * x).sum()), max(self.peak, int(np.abs(x).max(initial=0)))
        y = x if self._last is None else np.concatenate([[self._last], x])
        self.crossings += int(np.count_nonzero((y[1:] < 0) != (y[:-1] < 0)))
        self.steps += int(np.abs(np.diff(y)).sum())
        self._last = int(x[-1])

    @property
    def sha256(self) -> str:
        return self._sha.hexdigest()

    @property
    def tail_crc32(self) -> int:
        return zlib.crc32(self._tail)

    @property
    def feature(self) -> str:
        """Level, peak, offset, zero crossings and mean step of the samples."""
        n = self.count
        return f"rms={np.sqrt(self.squares / n):.6f};peak={self.peak};mean={self.total / n:.6f};zcr={self.crossings / n:.6f};step={self.steps / n:.6f}"


def _texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    return [(t or "").encode() for t in batch.column(text).to_pylist()]


def encode_column(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns, n_bytes long and media binary: each text's UTF-8 bytes, padded by zeros to a positive multiple of 64, as a FLAC stream.

    A null text is empty (64 zeros); columns named n_bytes or media are replaced.  Works row by row: repeated rows give
    equal streams, an empty table stays empty, a very long text is one stream, alone in its slice.
    """
    docs = only_new(docs, "n_bytes", "media")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                texts = _texts(batch, text)
                new = [pa.array([len(t) for t in texts], pa.int64()), pa.array(encode([padded(t) for t in texts]), pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "n_bytes", "media"])

    return docs.mapInArrow(run, grown(docs, n_bytes="long", media="binary"))


def pcm_blocks(media: DataFrame, key: str = "doc_id", column: str = "media", samples: int = PCM_SAMPLES) -> DataFrame:
    """PCM blocks of decoded streams: key, block int, sample_offset long, pcm binary (signed 8-bit), so that sample s is found in block s div `samples`.  Null media give no block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, column):
                rows = [(k, m) for k, m in zip(batch.column(key).to_pylist(), batch.column(column).to_pylist(), strict=True) if m is not None]
                out = [
                    (k, offset // samples, offset, pcm)
                    for (k, _), blocks in zip(rows, blocks_of([m for _, m in rows], samples), strict=True)
                    for offset, pcm in blocks
                ]
                columns = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (batch.schema.field(key).type, pa.int32(), pa.int64(), pa.binary()), strict=True)], [key, "block", "sample_offset", "pcm"])

    return media.mapInArrow(run, grown(media.select(key), block="integer", sample_offset="long", pcm="binary"))


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
)


def read_back(media: DataFrame) -> DataFrame:
    """Digests and features of the PCM blocks that are decoded from column media, beside doc_id and n_bytes; the media must not be null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "media"):
                stored = batch.column("media").to_pylist()
                found = [Summary(blocks) for blocks in blocks_of(stored, 16 * PCM_SAMPLES)]
                columns = [
                    batch.column("doc_id").to_pylist(),
                    batch.column("n_bytes").to_pylist(),
                    [s.count for s in found],
                    [s.sha256 for s in found],
                    [s.tail_crc32 for s in found],
                    [len(m) for m in stored],
                    [hashlib.sha256(m).hexdigest() for m in stored],
                    [s.feature for s in found],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, RESULT.types, strict=True)], schema=RESULT)

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: every text through FLAC and back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_back(encode_column(docs).select("doc_id", "n_bytes", "media"))
