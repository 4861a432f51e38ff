import random
import zlib

import pytest

from alluvia.llm.flac import FRAME, _number, crc8, crc16, decode, decoded_blocks, encode, encoded_media, media_digests

import hashlib

import numpy as np


def payloads():
    rng = random.Random(2)
    wave = bytes(int(128 + 60 * np.sin(i / 9) + rng.randint(-2, 2)) for i in range(3000))
    noise = bytes(rng.randrange(256) for _ in range(2500))
    text = ("the quick brown fox " * 200).encode()
    spiky = bytes(0 if i % 700 else 255 for i in range(2048))
    return [wave, noise, text, spiky, bytes(64), bytes([255]) * FRAME, b"a" * (FRAME * 200 + 64), "é①".encode() * 32]


def test_round_trip_and_kinds_of_subframes():
    files = encode(payloads())
    assert [p for p, _ in decode(files)] == payloads()
    assert len(files[0]) < 0.75 * 3000
    assert files == [encode([p])[0] for p in payloads()]


@pytest.mark.parametrize("at", [30, -1, -200])
def test_damage_is_found(at):
    broken = bytearray(encode([payloads()[0]])[0])
    broken[at] ^= 1
    with pytest.raises(ValueError):
        decode([bytes(broken)])


def test_checksums():
    assert crc8(b"123456789") == 0xF4
    assert crc16(np.frombuffer(b"123456789", np.uint8), np.array([0]), np.array([9])).tolist() == [0xFEE8]
    assert [_number(n) for n in (5, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000)] == [chr(n).encode("utf-8", "surrogatepass") for n in (5, 0x80, 0x7FF, 0x800, 0xFFFF, 0x10000)]


def test_query_and_blocks(spark):
    rows = [(1, None), (2, ""), (3, "é" * 40000), (3, "x"), (4, "x" * 64)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in media_digests(df).collect())
    want = []
    for d, t in rows:
        raw = (t or "").encode()
        p = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        want.append((d, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert [g[:5] for g in got] == sorted(want)
    blocks = decoded_blocks(encoded_media(df.where("length(text) = 40000"))).orderBy("first_sample").collect()
    assert b"".join(r["pcm"] for r in blocks) == ("é" * 40000).encode() and blocks[3]["first_sample"] == 3 * FRAME
    assert decoded_blocks(spark.createDataFrame([(1, bytearray(b"no"))], "doc_id long, media binary")).collect()[0]["error"]
