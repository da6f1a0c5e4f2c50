"""MPEG audio streams: round trips, damage, tags and tables."""

import hashlib
from fractions import Fraction
from zlib import crc32

from docketloom.llm import mpeg

from .conftest import ODD


def payload(text):
    raw = (text or "").encode()
    return raw + b" " * (-len(raw) % 192 or (0 if raw else 192))


def test_round_trip_of_odd_texts():
    for text in [*ODD, "a" * 192, "b" * 193, "c" * 768, "d" * 769]:
        data = mpeg.store(text)
        got = mpeg.parse(data)
        assert mpeg.payload_of(got) == payload(text)
        units = len(payload(text)) // 192
        assert got["frames"] == -(-units // 4) == got["table"]["frames"] and got["crc_errors"] == got["resyncs"] == 0
        assert got["samples"] == 1152 * got["frames"] and got["table"]["bytes"] == len(data) - mpeg.tags(data)[0]
        assert Fraction(*mpeg.duration(got)) == Fraction(1152 * got["frames"], 48_000)


def test_known_headers():
    assert mpeg.header(0xFFFB9064)[:6] == (1.0, 3, False, 128, 44100, 417)
    assert mpeg.header(0xFFFD8004)[1] == 2 and mpeg.header(0xFFF30000 | 0x4000 | 0xC0)[0] == 2.0
    assert mpeg.header(0xFFFBF064) is None and mpeg.header(0xFFFB9C64) is None and mpeg.header(0x12345678) is None
    assert mpeg.crc16(b"123456789") == 0xAEE7


def test_resynchronises_behind_damage():
    data = bytearray(mpeg.store("x" * 7680))
    clean = mpeg.parse(bytes(data))
    at = clean["seek"][0] + 960 * 3
    data[at : at + 2] = b"\0\0"
    got = mpeg.parse(bytes(data))
    assert got["frames"] == clean["frames"] - 1 and got["resyncs"] == 1 and got["skipped"] == 960
    data = bytearray(mpeg.store("x" * 7680))
    data[clean["seek"][0] + 10] ^= 1  # inside the protected side information
    assert mpeg.parse(bytes(data))["crc_errors"] == 1


def test_tags_and_junk():
    data = mpeg.store("hello")
    v1 = b"TAG" + b"Title".ljust(30, b"\0") + b"Me".ljust(30, b"\0") + b"".ljust(30, b"\0") + b"1999" + bytes(31)
    got = mpeg.parse(data + v1)
    assert got["tags"]["title"] == "Title" and got["tags"]["year"] == "1999" and mpeg.payload_of(got) == payload("hello")
    start = mpeg.tags(data)[0]
    got = mpeg.parse(b"junk\xff\xfb" + data[start:])
    assert got["skipped"] == 6 and got["frames"] == 1
    for junk in (b"", b"\xff", b"ID3", b"\xff\xfb\x90", b"text only"):
        assert mpeg.parse(junk)["frames"] == 0


def test_vbri():
    word = (0x7FF << 21 | 3 << 19 | 1 << 17 | 1 << 16 | 9 << 12 | 1 << 10 | 1 << 6).to_bytes(4)
    size = mpeg.header(int.from_bytes(word))[5]
    body = b"VBRI" + b"\0\1\0\0\0\x64" + (5000).to_bytes(4) + (2).to_bytes(4) + (2).to_bytes(2) + (3).to_bytes(2) + (2).to_bytes(2) + (1).to_bytes(2) + (10).to_bytes(2) + (20).to_bytes(2)
    stream = (word + bytes(32) + body).ljust(size, b"\0") + (word + bytes(size - 4)) * 2
    got = mpeg.parse(stream)
    assert got["table"] == {"kind": "VBRI", "frames": 2, "bytes": 5000, "seek": [30, 60]} and got["frames"] == 2


def test_frame(spark, odd_docs):
    rows = mpeg.digest(odd_docs).collect()
    texts = [r.text for r in odd_docs.collect()]
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts):
        p = payload(t)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), crc32(p[-16:]))
        stored = mpeg.store(t)
        assert r.media_bytes == len(stored) and r.media_sha256 == hashlib.sha256(stored).hexdigest() and r.crc_errors == 0
    assert mpeg.digest(odd_docs.limit(0)).count() == 0


def test_payload_is_no_trailing_tag():
    for units, at in ((1, 89), (2, 329), (3, 521)):
        for mark, place in ((b"TAG", at), (b"APETAGEX", at + 96)):
            for before in (0, 8):  # whole frames in front
                text = ("a" * (768 * before + place) + mark.decode()).ljust(768 * before + 192 * units, "b")
                got = mpeg.parse(mpeg.store(text))
                assert mpeg.payload_of(got) == payload(text) and got["resyncs"] == 0 and "title" not in got["tags"]
    for n in range(60, 800):
        text = "TAG" * n
        assert mpeg.payload_of(mpeg.parse(mpeg.store(text))) == payload(text)


def bitwise_crc(bits):
    value = 0xFFFF
    for bit in bits:
        top = value >> 15
        value = value << 1 & 0xFFFF
        if top != bit:
            value ^= 0x8005
    return value


def bits_of(number, width):
    return [number >> (width - 1 - k) & 1 for k in range(width)]


#: (version bits, layer bits, bitrate index, rate index, mode, mode extension, bytes of the frame, samples, Hz, bits of each
#: subband's allocation), worked out by hand from the standard's tables.
MADE = {
    "I stereo": (3, 3, 9, 1, 0, 0, 288, 384, 48_000, [4] * 32),
    "I joint": (3, 3, 12, 0, 1, 1, 416, 384, 44_100, [4] * 32),
    "I mono": (3, 3, 5, 2, 3, 0, 240, 384, 32_000, [4] * 32),
    "II stereo a": (3, 2, 8, 1, 0, 0, 384, 1152, 48_000, [4] * 11 + [3] * 12 + [2] * 4),
    "II joint b": (3, 2, 10, 0, 1, 2, 626, 1152, 44_100, [4] * 11 + [3] * 12 + [2] * 7),
    "II mono c": (3, 2, 2, 1, 3, 0, 144, 1152, 48_000, [4] * 2 + [3] * 6),
    "II mono d": (3, 2, 1, 2, 3, 0, 144, 1152, 32_000, [4] * 2 + [3] * 10),
    "II low": (2, 2, 8, 1, 0, 0, 384, 1152, 24_000, [4] * 4 + [3] * 7 + [2] * 19),
    "III stereo": (3, 1, 9, 1, 0, 0, 384, 1152, 48_000, None),
    "III low mono": (2, 1, 8, 1, 3, 0, 192, 576, 24_000, None),
}


def made_frame(rng, kind, damage=False):
    """A protected frame with random protected bits, its checksum made bit by bit, and random bytes behind."""
    version, layer, index, rate, mode, extension, size, _, _, widths = MADE[kind]
    head = [1] * 11 + bits_of(version, 2) + bits_of(layer, 2) + [0] + bits_of(index, 4) + bits_of(rate, 2) + [0, 0] + bits_of(mode, 2) + bits_of(extension, 2) + [0] * 4
    channels = 1 if mode == 3 else 2
    body = []
    if widths is None:
        body = rng.integers(0, 2, 8 * {(3, 2): 32, (2, 1): 9}[version, channels]).tolist()
    else:
        bound = 4 * (extension + 1) if mode == 1 else len(widths)
        selected = 0
        for k, width in enumerate(widths):
            for _ in range(channels if k < bound else 1):
                value = int(rng.integers(0, 1 << width)) * int(rng.integers(0, 2))
                body += bits_of(value, width)
                selected += (value > 0) * (1 if k < bound else channels)
        if layer == 2:
            body += rng.integers(0, 2, 2 * selected).tolist()
    checksum = bitwise_crc(head[16:] + body)
    if damage:
        body[int(rng.integers(len(body)))] ^= 1
    bits = head + bits_of(checksum, 16) + body
    bits += [0] * (-len(bits) % 8)
    raw = bytes(int("".join(map(str, bits[k : k + 8])), 2) for k in range(0, len(bits), 8))
    return raw + rng.integers(0, 255, size - len(raw)).astype("uint8").tobytes().replace(b"\xff", b"\x00")


def test_layers_and_checksums_behind_junk():
    import numpy as np

    rng = np.random.default_rng(11)
    junk = b"\xff\xfb\x90\x00".ljust(417, b"j")  # begins with a header that nothing follows
    for kind, row in MADE.items():
        size, samples, hertz = row[6:9]
        for lead in (b"", junk, b"\xff\xfa" * 75):
            damaged = [False] * 7
            clean = lead + b"".join(made_frame(rng, kind) for _ in damaged)
            got = mpeg.parse(clean, every=1)
            assert (got["frames"], got["samples"], got["rate"], got["checked"], got["crc_errors"]) == (7, 7 * samples, hertz, 7, 0), kind
            assert got["skipped"] == len(lead) and got["seek"] == [len(lead) + k * size for k in range(7)]
            assert Fraction(*mpeg.duration(got)) == Fraction(7 * samples, hertz)
        wrong = [False, True, False, True, False, False]
        if MADE[kind][1] != 2:  # a wrong allocation bit changes what a Layer II checksum covers, so it may be found wrong only as a whole
            got = mpeg.parse(b"".join(made_frame(rng, kind, w) for w in wrong))
            assert (got["checked"], got["crc_errors"]) == (6, 2)
        zero = [made_frame(rng, kind) for _ in range(5)]
        zero = b"".join(f[:4] + bytes(2) + f[6:] for f in zero)
        assert mpeg.parse(zero)["crc_errors"] == 5
        hole = b"".join(made_frame(rng, kind) for _ in range(3)) + b"lost" + b"".join(made_frame(rng, kind) for _ in range(4))
        got = mpeg.parse(hole)
        assert (got["frames"], got["resyncs"], got["skipped"]) == (7, 1, 4)


def test_named_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "ab", "x", "y")], "doc_id long, text string, media string, facts string")
    [row] = mpeg.add_facts(mpeg.add_media(docs)).collect()
    assert row.facts.n_bytes == 2 and bytes(row.media) == mpeg.store("ab") and len(row) == 4
