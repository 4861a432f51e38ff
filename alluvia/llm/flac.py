"""FLAC media columns: encode bytes as 8-bit mono FLAC, decode it with every checksum verified, and write PCM blocks.

The encoder cuts the samples (byte - 128) into frames of 1024, and for each frame takes the shortest of verbatim samples, fixed
predictors of order 0 and 1, and a linear predictor of order 4 with quantised coefficients, residuals Rice-coded. A seek table
has a point for every frame, so that any sample can be reached. The decoder handles constant, verbatim, fixed and linear
subframes of 8-bit mono streams whose seek table names every frame; it verifies each frame's CRC-8 and CRC-16, and the MD5 of
all samples. Frames of many files are coded side by side in numpy: all lanes take one sample a step. Integer sums only, so that
equal inputs give equal bytes whatever else is in the batch.

Null texts are empty; a payload is never empty, since zeros are appended up to a positive multiple of 64. Broken media raise
ValueError in decode() and give an error in decoded_blocks(). Repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.llm.arrow_text import row_chunks, strings

FRAME = 1024
ORDER = 4
PRECISION = 10
LANES = 2048
FIELDS = 1 + ORDER + 2 + ORDER + 1  # what may stand before the residuals
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


def _table(polynomial: int, bits: int) -> np.ndarray:
    """A checksum's table for one byte."""
    value = np.arange(256, dtype=np.int64) << (bits - 8)
    for _ in range(8):
        value = np.where(value >> (bits - 1) & 1, value << 1 ^ polynomial, value << 1) & ((1 << bits) - 1)
    return value


CRC8, CRC16 = _table(0x07, 8), _table(0x8005, 16)
_CRC8 = CRC8.tolist()


def crc8(data: bytes) -> int:
    value = 0
    for b in data:
        value = _CRC8[value ^ b]
    return value


def crc16(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-16 of ranges of the data, in lockstep."""
    order = np.argsort(-length, kind="stable")
    at, ends = start[order], length[order]
    value = np.zeros(len(order), np.int64)
    alive = np.searchsorted(-ends, -np.arange(int(ends[0]) if len(ends) else 0), "left")
    for t, n in enumerate(alive.tolist()):
        v = value[:n]
        value[:n] = CRC16[(v >> 8) ^ data[at[:n] + t]] ^ (v << 8 & 0xFFFF)
    out = np.empty_like(value)
    out[order] = value
    return out


def _number(n: int) -> bytes:
    """A frame number in the variable-length code that UTF-8 has."""
    if n < 0x80:
        return bytes([n])
    tail = []
    room = 0x3F
    while n > room:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        room >>= 1
    return bytes([(0xFF ^ (room << 1 | 1)) & 0xFF | n, *reversed(tail)])


def _frame_header(number: int, n: int) -> bytes:
    head = bytes([0xFF, 0xF8, 0xA0 if n == FRAME else 0x70, 0x02]) + _number(number) + (b"" if n == FRAME else struct.pack(">H", n - 1))
    return head + bytes([crc8(head)])


def _zigzag(e: np.ndarray) -> np.ndarray:
    return np.where(e < 0, -2 * e - 1, 2 * e)


def _rice(u: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parameter and bits of Rice codes of each row; what lies outside a row is 0 in u, and not counted."""
    mean = u.sum(1) // np.maximum(count, 1)
    k = np.clip(np.frexp(mean.astype(np.float64))[1] - 1, 0, 14).astype(np.int64)
    return k, (u >> k[:, None]).sum(1) + count * (1 + k)


def _linear(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised predictor coefficients and shifts of each row, by Levinson's recursion on exact autocorrelations."""
    r = [(x[:, i:] * x[:, : x.shape[1] - i]).sum(1).astype(np.float64) for i in range(ORDER + 1)]
    error = r[0] + 1.0
    a = np.zeros((ORDER, len(x)))
    for i in range(ORDER):
        value = r[i + 1].copy()
        for j in range(i):
            value -= a[j] * r[i - j]
        value /= error
        before = a.copy()
        a[i] = value
        for j in range(i):
            a[j] = before[j] - value * before[i - 1 - j]
        error = np.maximum(error * (1 - value * value), 1e-6)
    most = np.maximum(np.abs(a).max(0), 1e-9)
    shift = np.clip(PRECISION - 1 - np.frexp(most)[1], 0, 14).astype(np.int64)
    limit = 1 << (PRECISION - 1)
    return np.clip(np.rint(a * (1 << shift)), -limit, limit - 1).astype(np.int64), shift


def _encode_frames(x: np.ndarray, n: np.ndarray) -> list[bytes]:
    """The subframes of rows of samples, n of each row."""
    lanes, width = x.shape
    inside = np.arange(width) < n[:, None]
    coefficients, shift = _linear(x)
    prediction = np.zeros_like(x)
    for i in range(ORDER):
        prediction[:, i + 1 :] += coefficients[i][:, None] * x[:, : width - i - 1]
    choices = []
    for order, residual in ((0, x), (1, np.diff(x, axis=1, prepend=0)), (ORDER, x - (prediction >> shift[:, None]))):
        u = np.where(inside, _zigzag(residual), 0)
        u[:, :order] = 0
        k, bits = _rice(u, n - order)
        choices.append((order, u, k, bits + 8 * order + 10 + (9 + PRECISION * ORDER) * (order == ORDER)))
    best = np.argmin([8 * n, *(c[3] for c in choices)], 0)
    u, k, order = x & 0xFF, np.full(lanes, 8), np.zeros(lanes, np.int64)
    for c, (o, own, kk, _) in enumerate(choices, 1):
        here = best == c
        u[here], k[here], order[here] = own[here], kk[here], o
    linear, coded = best == 3, best > 0
    value, size = np.zeros((lanes, FIELDS + width), np.int64), np.zeros((lanes, FIELDS + width), np.int64)
    value[:, 0] = np.select([best == 0, linear], [1 << 1, (32 + ORDER - 1) << 1], (8 + order) << 1)
    size[:, 0] = 8
    for i in range(ORDER):
        has = coded & (order > i)
        value[has, 1 + i], size[has, 1 + i] = x[has, i] & 0xFF, 8
        at = ORDER + 3 + i
        value[linear, at], size[linear, at] = coefficients[i][linear] & ((1 << PRECISION) - 1), PRECISION
    value[linear, ORDER + 1], size[linear, ORDER + 1] = PRECISION - 1, 4
    value[linear, ORDER + 2], size[linear, ORDER + 2] = shift[linear], 5
    value[coded, FIELDS - 1], size[coded, FIELDS - 1] = k[coded], 10
    code, kk = value[:, FIELDS:], k[:, None]
    kept = inside & (np.arange(width) >= order[:, None])
    code[:] = np.where(kept, np.where(coded[:, None], u & ((1 << kk) - 1) | 1 << kk, u), 0)
    size[:, FIELDS:] = np.where(kept, np.where(coded[:, None], (u >> kk) + 1 + kk, 8), 0)
    ends = np.cumsum(size, 1)
    length = -(-ends[:, -1] // 8)
    starts = np.cumsum(length) - length
    last = (ends + 8 * starts[:, None] - 1).ravel()
    last = np.maximum(last, 0)
    shifted, byte = value.ravel() << (7 - (last & 7)), last >> 3
    total = int(length.sum())
    data = np.zeros(total + 3)
    for j in range(4):
        part = shifted >> (8 * j) & 0xFF
        some = np.flatnonzero(part)
        data += np.bincount(byte[some] - j + 3, part[some], total + 3)[: total + 3] if j else np.bincount(byte[some] + 3, part[some], total + 3)[: total + 3]
    raw = data[3:].astype(np.uint8).tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), (starts + length).tolist())]


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC files of non-empty payloads, one sample for each byte."""
    counts = [ceil(len(p) / FRAME) for p in payloads]
    samples = [np.frombuffer(p, np.uint8).astype(np.int64) - 128 for p in payloads]
    owner = np.repeat(np.arange(len(payloads)), counts)
    number = np.concatenate([np.arange(c) for c in counts]) if counts else np.zeros(0, np.int64)
    frames: list[bytes] = []
    for at in range(0, len(owner), LANES):
        own, num = owner[at : at + LANES], number[at : at + LANES]
        n = np.array([min(FRAME, len(samples[o]) - FRAME * k) for o, k in zip(own, num)])
        x = np.zeros((len(own), FRAME), np.int64)
        for row, (o, k) in enumerate(zip(own, num)):
            x[row, : n[row]] = samples[o][FRAME * k : FRAME * k + n[row]]
        bodies = [_frame_header(int(k), int(m)) + s for k, m, s in zip(num, n, _encode_frames(x, n))]
        length = np.array([len(f) for f in bodies])
        sums = crc16(np.frombuffer(b"".join(bodies), np.uint8), np.cumsum(length) - length, length)
        frames += [f + struct.pack(">H", c) for f, c in zip(bodies, sums.tolist())]
    out, first = [], 0
    for payload, c, s in zip(payloads, counts, samples):
        own = frames[first : first + c]
        first += c
        sizes = [len(f) for f in own]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        info = struct.pack(">HH", FRAME, FRAME) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
        info += (8000 << 44 | 7 << 36 | len(payload)).to_bytes(8, "big") + hashlib.md5(s.astype(np.int8).tobytes()).digest()
        seek = b"".join(struct.pack(">QQH", k * FRAME, offsets[k], min(FRAME, len(payload) - k * FRAME)) for k in range(c))
        blocks = [bytes([0]) + len(info).to_bytes(3, "big") + info]
        cut = [seek[i : i + 18 * 900_000] for i in range(0, len(seek), 18 * 900_000)]  # a block's length has 24 bits
        blocks += [bytes([3 | 0x80 * (i == len(cut) - 1)]) + len(p).to_bytes(3, "big") + p for i, p in enumerate(cut)]
        out.append(b"fLaC" + b"".join(blocks) + b"".join(own))
    return out


def _metadata(media: bytes) -> tuple[int, bytes, list[tuple[int, int, int]], int]:
    """Samples, MD5, seek points and the first frame's place of a file."""
    if media[:4] != b"fLaC":
        raise ValueError("no FLAC stream")
    at, last, total, md5, points = 4, False, -1, b"", []
    while not last:
        if at + 4 > len(media):
            raise ValueError("metadata are cut off")
        last, kind, size = media[at] >> 7, media[at] & 127, int.from_bytes(media[at + 1 : at + 4], "big")
        block = media[at + 4 : at + 4 + size]
        if kind == 0:
            packed = int.from_bytes(block[10:18], "big")
            total, md5 = packed & ((1 << 36) - 1), block[18:34]
            if packed >> 41 & 7 or (packed >> 36 & 31) != 7:
                raise ValueError("only 8-bit mono is read")
        elif kind == 3:
            points += [p for p in struct.iter_unpack(">QQH", block) if p[0] != 0xFFFFFFFFFFFFFFFF]
        at += 4 + size
    if total < 0 or sum(p[2] for p in points) != total:
        raise ValueError("the seek table doesn't name every frame")
    return total, md5, points, at


def _header(data: bytes, at: int) -> tuple[int, int]:
    """Samples of the frame at this place, and the place of its subframe; the CRC-8 must hold."""
    if data[at : at + 2] != b"\xff\xf8" or data[at + 3] not in (0x02, 0x00):
        raise ValueError("no frame where the seek table has one")
    code, p = data[at + 2] >> 4, at + 4
    lead = data[p]
    p += 1 if lead < 0x80 else 8 - (~lead & 0xFF).bit_length()
    if code == 6:
        n, p = data[p] + 1, p + 1
    elif code == 7:
        n, p = int.from_bytes(data[p : p + 2], "big") + 1, p + 2
    else:
        n = 192 if code == 1 else 576 << (code - 2) if code < 6 else 256 << (code - 8)
    if crc8(data[at:p]) != data[p]:
        raise ValueError("a frame header's CRC-8 doesn't hold")
    return n, p + 1


def _decode_frames(data: bytes, start: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Samples of the frames between these places of the data, all lanes in lockstep."""
    raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.int64)
    if np.any(crc16(raw, start, stop - start - 2) != raw[stop - 2] << 8 | raw[stop - 1]):
        raise ValueError("a frame's CRC-16 doesn't hold")
    heads = [_header(data, a) for a in start.tolist()]
    n, place = np.array([h[0] for h in heads]), np.array([h[1] for h in heads]) * 8
    wide = raw[:-4] << 32 | raw[1:-3] << 24 | raw[2:-2] << 16 | raw[3:-1] << 8 | raw[4:]

    def read(p, bits):
        return wide[p >> 3] >> (40 - (p & 7) - bits) & ((1 << bits) - 1)

    kind = read(place, 8) >> 1
    place = place + 8
    order = np.where(kind >= 32, kind - 31, np.where(kind >= 8, kind - 8, 0))
    out: list[np.ndarray] = [np.zeros(0)] * len(n)
    for i in np.flatnonzero(kind < 8):
        at = place[i] >> 3
        out[i] = raw[at : at + n[i]].astype(np.uint8).view(np.int8) if kind[i] == 1 else np.full(n[i], raw[at].astype(np.uint8).view(np.int8))
    lanes = np.flatnonzero(kind >= 8)
    if not len(lanes):
        return out
    lanes = lanes[np.argsort(-n[lanes], kind="stable")]
    kind, order, n, p = kind[lanes], order[lanes], n[lanes], place[lanes]
    deepest, width = int(order.max()), int(n.max())
    samples = np.zeros((width, len(lanes)), np.int64)
    for t in range(deepest):
        warm = order > t
        samples[t] = np.where(warm, (read(p, 8) ^ 0x80) - 0x80, 0)
        p = p + 8 * warm
    coefficient, shift = np.zeros((deepest, len(lanes)), np.int64), np.zeros(len(lanes), np.int64)
    linear = kind >= 32
    for i in range(deepest):
        coefficient[i] = [FIXED[o][i] if i < min(o, 4) else 0 for o in order.tolist()]
    precision = np.where(linear, read(p, 4) + 1, 0)
    p = p + 4 * linear
    shift = np.where(linear, read(p, 5), 0)
    p = p + 5 * linear
    for i in range(deepest):
        has = linear & (order > i)
        bits = np.where(has, precision, 1)
        value = read(p, bits)
        value -= (value >> (bits - 1)) << bits
        coefficient[i] = np.where(linear, np.where(has, value, 0), coefficient[i])
        p = p + np.where(has, precision, 0)
    if np.any(read(p, 6)):
        raise ValueError("only one partition of Rice codes with 4-bit parameters is read")
    k = read(p + 6, 4)
    p = p + 10
    masks = (1 << k) - 1
    alive = np.searchsorted(-n, -np.arange(width), "left")
    for t, m in enumerate(alive.tolist()):
        own = p[:m]
        window = wide[own >> 3] << (own & 7) & 0xFFFFFFFFFF
        zeros = 40 - np.frexp(window.astype(np.float64))[1]
        long_ = np.flatnonzero(window >> 8 == 0)
        if len(long_):  # more than 32 zeros
            q = own.copy()
            zeros[long_] = 0
            left = long_
            while len(left):
                w = wide[q[left] >> 3] << (q[left] & 7) & 0xFFFFFFFFFF
                none = w >> 8 == 0
                step = np.where(none, 32, 40 - np.frexp(w.astype(np.float64))[1])
                zeros[left] += step
                q[left] += step
                left = left[none]
        after = own + zeros + 1
        u = zeros.astype(np.int64) << k[:m] | (wide[after >> 3] >> (40 - (after & 7) - k[:m]) & masks[:m])
        residual = (u >> 1) ^ -(u & 1)
        total = np.zeros(m, np.int64)
        for i in range(min(deepest, t)):
            total += coefficient[i, :m] * samples[t - 1 - i, :m]
        value = (total >> shift[:m]) + residual
        if t < deepest:
            warm = order[:m] > t
            value = np.where(warm, samples[t, :m], value)
            after = np.where(warm, own, after + k[:m])
        else:
            after = after + k[:m]
        samples[t, :m] = value
        p[:m] = after
    for row, i in enumerate(lanes.tolist()):
        out[i] = samples[: n[row], row].astype(np.int8)
    return out


def decode(files: list[bytes]) -> list[tuple[bytes, list[tuple[int, int, int]]]]:
    """Payload and seek points (first sample, offset, samples) of each file; anything wrong raises ValueError."""
    told = [_metadata(f) for f in files]
    jobs = [(i, at + p[1], at + (points[k + 1][1] if k + 1 < len(points) else len(files[i]) - at)) for i, (_, _, points, at) in enumerate(told) for k, p in enumerate(points)]
    parts: list[list[np.ndarray]] = [[] for _ in files]
    for a in range(0, len(jobs), LANES):
        some = jobs[a : a + LANES]
        data = b"".join([files[i][s:e] for i, s, e in some])
        length = np.array([e - s for _, s, e in some])
        stops = np.cumsum(length)
        for (i, _, _), x in zip(some, _decode_frames(data, stops - length, stops)):
            parts[i].append(x)
    out = []
    for own, (total, md5, points, _) in zip(parts, told):
        samples = np.concatenate(own).astype(np.int8) if own else np.zeros(0, np.int8)
        if len(samples) != total or hashlib.md5(samples.tobytes()).digest() != md5:
            raise ValueError("the samples' MD5 doesn't hold")
        out.append(((samples.view(np.uint8) ^ 0x80).tobytes(), points))
    return out


def _payload(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def _features(payload: bytes, frames: int) -> str:
    """Frames, sum, energy and zero crossings of the samples."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    return f"{frames}:{int(x.sum())}:{int((x * x).sum())}:{int(((x[1:] < 0) != (x[:-1] < 0)).sum())}"


def encoded_media(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_bytes and media: the text's UTF-8 bytes, padded with zeros to a positive multiple of 64, as FLAC."""
    kept = df.select(*keep, F.col(text).alias("__text"))
    types = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])

    def run(batches):
        for batch in batches:
            for start, stop in row_chunks(batch.column(len(keep))):
                b = batch.slice(start, stop - start)
                raw = [x.encode() for x in strings(b.column(len(keep))).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([len(x) for x in raw], pa.int64()), pa.array(encode([_payload(x) for x in raw]), pa.binary())], [*keep, "n_bytes", "media"])

    return kept.mapInArrow(run, f"{types}, n_bytes long, media binary")


def decoded_blocks(df: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """PCM blocks of a media column: doc_id, first_sample, n_samples, pcm (unsigned 8-bit) and error, one row per frame; broken media give one row with an error."""
    kept = df.select(F.col(key).cast("long").alias("doc_id"), F.col(media).alias("media"))

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    [(payload, points)] = decode([data or b""])
                    rows += [(doc_id, first, n, payload[first : first + n], None) for first, _, n in points]
                except (ValueError, IndexError) as error:
                    rows.append((doc_id, None, None, None, str(error) or "broken"))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["doc_id", "first_sample", "n_samples", "pcm", "error"])

    return kept.mapInArrow(run, "doc_id long, first_sample long, n_samples int, pcm binary, error string")


def media_digests(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row the digests of what is stored and of what is read back, in one pass without moving the media: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature and n_frames."""
    kept = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            for start, stop in row_chunks(batch.column(1), 2 << 20):
                b = batch.slice(start, stop - start)
                raw = [x.encode() for x in strings(b.column(1)).to_pylist()]
                files = encode([_payload(x) for x in raw])
                back = decode(files)
                columns = (
                    b.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([len(p) for p, _ in back], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p, _ in back], pa.string()),
                    pa.array([zlib.crc32(p[-64:]) for p, _ in back], pa.int64()), pa.array([len(f) for f in files], pa.int64()), pa.array([hashlib.sha256(f).hexdigest() for f in files], pa.string()),
                    pa.array([_features(p, len(s)) for p, s in back], pa.string()), pa.array([len(s) for _, s in back], pa.int64()),
                )
                yield pa.RecordBatch.from_arrays(list(columns), ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames"])

    return kept.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long")
