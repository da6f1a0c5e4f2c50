"""MPEG audio columns: frames, tags, variable-bitrate tables, checksums, exact durations and seek offsets.

:func:`parse` reads any MPEG-1, -2 or -2.5 stream of layers I to III: it skips ID3v2 tags (with extended size and footer),
ID3v1 and APE tags, finds the first frame by a header whose successor at the computed distance is one of the same kind, and
after damage resynchronises in the same way; it reads Xing/Info and VBRI tables, verifies the CRC-16 of protected frames of
all three layers (over the bits that each layer protects), and counts samples, so the duration is an exact fraction of samples and rate. Every ``every``-th frame's byte offset is kept for
seeking.

:func:`store` writes bytes losslessly as a Layer III stream of silence: frames without main data, whose ancillary bytes are
the payload. Units of 192 bytes go into frames of one to four units at the bitrate that holds them, so the bitrate varies
and a Xing table stands in front; the payload's and text's lengths are in an ID3v2 text frame. Payload bytes can look like a
header, so the reader takes frames at their computed distance and never searches inside one that checks out; nor is a
trailing tag one that lies in the last whole frame.

Defined cases: null and empty texts are one unit of padding; bytes without any frame give zero frames, nothing raised; equal
texts give equal values; repeated rows are stored each.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache, lru_cache
from math import gcd
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by bitrate index (1 to 14), and Hz by index for MPEG-1.
BITRATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = (44_100, 48_000, 32_000)
UNIT = 192


@lru_cache(4096)
def header(word: int) -> tuple | None:
    """(version, layer, protected, kbit/s, Hz, bytes of the frame, samples, channels) of a frame header, or None."""
    version = {3: 1.0, 2: 2.0, 0: 2.5}.get(word >> 19 & 3)
    layer = {3: 1, 2: 2, 1: 3}.get(word >> 17 & 3)
    index, rate = word >> 12 & 15, word >> 10 & 3
    if word >> 21 != 0x7FF or version is None or layer is None or index in (0, 15) or rate == 3 or word & 3 == 2:
        return None
    kbit = BITRATES[1 if version == 1 else 2, layer][index - 1]
    hertz = RATES[rate] // {1.0: 1, 2.0: 2, 2.5: 4}[version]
    pad = word >> 9 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or version == 1 else 576
    size = (12 * kbit * 1000 // hertz + pad) * 4 if layer == 1 else samples // 8 * kbit * 1000 // hertz + pad
    return version, layer, not word >> 16 & 1, kbit, hertz, size, samples, 1 if word >> 6 & 3 == 3 else 2


def crc16(data: bytes, value: int = 0xFFFF) -> int:
    """The checksum of MPEG audio: polynomial 0x8005, most significant bit first."""
    table = _crc_table()
    for b in data:
        value = (value << 8 & 0xFFFF) ^ table[value >> 8 ^ b]
    return value


@cache
def _crc_table() -> tuple[int, ...]:
    out = []
    for b in range(256):
        v = b << 8
        for _ in range(8):
            v = (v << 1 ^ (0x8005 if v & 0x8000 else 0)) & 0xFFFF
        out.append(v)
    return tuple(out)


#: Layer III side information is (mono, stereo) bytes long, and the checksum covers it and the last two header bytes.
def side_bytes(version: float, channels: int) -> int:
    return (17 if channels == 1 else 32) if version == 1 else (9 if channels == 1 else 17)


#: Layer II bit allocation by table: (subbands, bits of each one's allocation). Fixed values of ISO/IEC 11172-3 and 13818-3.
ALLOCATION = {
    "a": ((11, 4), (12, 3), (4, 2)),
    "b": ((11, 4), (12, 3), (7, 2)),
    "c": ((2, 4), (6, 3)),
    "d": ((2, 4), (10, 3)),
    "low": ((4, 4), (7, 3), (19, 2)),
}


def allocation_bits(version: float, kbit: int, hertz: int, channels: int) -> list[int]:
    """Bits of each subband's allocation in a Layer II frame."""
    each = kbit // channels
    if version != 1:
        name = "low"
    elif each >= 56 and (hertz == 48_000 or each <= 80):
        name = "a"
    elif each >= 96:
        name = "b"
    else:
        name = "d" if hertz == 32_000 else "c"
    return [bits for count, bits in ALLOCATION[name] for _ in range(count)]


def protected_bits(data: bytes, at: int, found: tuple) -> int | None:
    """How many bits behind the checksum it covers, of the frame at ``at``; None where the frame is too short for them."""
    version, layer, _, kbit, hertz, size, _, channels = found
    if layer == 3:
        bits = 8 * side_bytes(version, channels)
    else:
        mode = data[at + 3]
        widths = [4] * 32 if layer == 1 else allocation_bits(version, kbit, hertz, channels)
        joint = 4 * ((mode >> 4 & 3) + 1) if mode >> 6 == 1 else len(widths)  # from there on both channels share
        bits = sum(w * (channels if k < joint else 1) for k, w in enumerate(widths))
        if layer == 2:  # two bits of scale factor selection for each channel of a subband that holds anything
            if 6 + -(-bits // 8) > size:
                return None
            value, left = int.from_bytes(data[at + 6 : at + 6 + -(-bits // 8)]), -(-bits // 8) * 8
            chosen = 0
            for k, w in enumerate(widths):
                for _ in range(channels if k < joint else 1):
                    left -= w
                    chosen += (value >> left & ((1 << w) - 1) > 0) * (1 if k < joint else channels)
            bits += 2 * chosen
    return bits if 48 + bits <= 8 * size else None


def checksum_holds(data: bytes, at: int, found: tuple) -> bool:
    """Does the CRC-16 of the protected frame at ``at`` hold? It covers the last two header bytes and the protected bits."""
    bits = protected_bits(data, at, found)
    if bits is None:
        return False
    whole, rest = divmod(bits, 8)
    value = _silent_crc(data[at + 2 : at + 4] + data[at + 6 : at + 6 + whole])
    for k in range(rest):
        bit = data[at + 6 + whole] >> (7 - k) & 1
        value = (value << 1 & 0xFFFF) ^ (0x8005 if bit ^ value >> 15 else 0)
    return value == int.from_bytes(data[at + 4 : at + 6])


@lru_cache(4096)
def _silent_crc(data: bytes) -> int:
    return crc16(data)


def synchsafe(data: bytes) -> int:
    return (data[0] & 127) << 21 | (data[1] & 127) << 14 | (data[2] & 127) << 7 | data[3] & 127


def tags(data: bytes, trailing: bool = True) -> tuple[int, int, dict[str, str]]:
    """(first byte behind leading tags, first byte of trailing tags if they are looked for, text fields of the tags)."""
    start, stop, fields = 0, len(data), {}
    while data[start : start + 3] == b"ID3" and len(data) >= start + 10:
        size = synchsafe(data[start + 6 : start + 10])
        end = min(len(data), start + 10 + size)
        at, major = start + 10, data[start + 3]
        while at + 10 <= end and data[at : at + 4].isalnum():
            raw = data[at + 4 : at + 8]
            n = synchsafe(raw) if major >= 4 else int.from_bytes(raw)
            body = data[at + 10 : min(end, at + 10 + n)]
            if data[at : at + 1] == b"T" and body:
                coding = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1")
                text = body[1:].decode(coding, "replace").rstrip("\0")
                name, _, value = text.partition("\0") if data[at : at + 4] == b"TXXX" else (data[at : at + 4].decode("ascii", "replace"), "", text)
                fields[name] = value
            at += 10 + n
        start = end + (10 if data[start + 5] & 16 else 0)
    while trailing:
        if stop - start >= 128 and data[stop - 128 : stop - 125] == b"TAG":
            tag = data[stop - 128 : stop]
            for name, a, b in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97)):
                fields.setdefault(name, tag[a:b].rstrip(b"\0 ").decode("latin-1"))
            stop -= 128
        elif stop - start >= 32 and data[stop - 32 : stop - 24] == b"APETAGEX":
            stop = max(start, stop - int.from_bytes(data[stop - 20 : stop - 16], "little") - (32 if data[stop - 9] & 128 else 0))
        else:
            break
    return start, stop, fields


def table(frame: bytes, version: float, channels: int) -> dict | None:
    """The Xing/Info or VBRI table in a frame: its kind, frames, bytes and seek entries."""
    at = 4 + side_bytes(version, channels)
    for skip in (0, 2):  # encoders disagree whether a checksum moves the table
        kind = frame[at + skip : at + skip + 4]
        if kind in (b"Xing", b"Info"):
            at += skip + 4
            flags, at = int.from_bytes(frame[at : at + 4]), at + 4
            out = {"kind": kind.decode(), "frames": None, "bytes": None, "seek": []}
            for bit, name in ((1, "frames"), (2, "bytes")):
                if flags & bit:
                    out[name], at = int.from_bytes(frame[at : at + 4]), at + 4
            if flags & 4:
                out["seek"] = list(frame[at : at + 100])
            return out
    if frame[36:40] == b"VBRI":
        number = lambda a, n: int.from_bytes(frame[36 + a : 36 + a + n])
        entries, scale, width = number(18, 2), number(20, 2), number(22, 2)
        return {"kind": "VBRI", "frames": number(14, 4), "bytes": number(10, 4), "seek": [number(26 + k * width, width) * scale for k in range(entries)]}
    return None


def _frame_at(data: bytes, at: int, stop: int) -> tuple | None:
    return header(int.from_bytes(data[at : at + 4])) if at + 4 <= stop else None


_SYNC = re.compile(rb"\xff[\xe0-\xff]")


def find_frame(data: bytes, at: int, stop: int) -> int | None:
    """The next place with a whole frame that is followed by one of the same kind, or by the end."""
    for m in _SYNC.finditer(data, at, stop):
        found = _frame_at(data, m.start(), stop)
        if found:
            end = m.start() + found[5]
            if end == stop:
                return m.start()
            after = _frame_at(data, end, stop)
            if after and after[:2] == found[:2] and after[4] == found[4]:
                return m.start()
    return None


def parse(data: bytes, every: int = 64) -> dict:
    """What the stream holds; ``payload`` are the ancillary bytes of frames that :func:`store` wrote."""
    start, stop, fields = tags(data)
    if stop < len(data):  # what looks like a tag is payload where the last whole frame ends with the stream
        out, end = _read(data, every, *tags(data, trailing=False))
        if end == len(data):
            return out
    return _read(data, every, start, stop, fields)[0]


def _read(data: bytes, every: int, start: int, stop: int, fields: dict[str, str]) -> tuple[dict, int | None]:
    """What [start, stop) holds, and where its last frame ends if nothing unread follows."""
    at = find_frame(data, start, stop)
    out = {"frames": 0, "samples": 0, "rate": 0, "version": 0.0, "layer": 0, "channels": 0, "checked": 0, "crc_errors": 0, "resyncs": 0 if at == start else 1, "skipped": (at if at is not None else stop) - start, "low": 0, "high": 0, "seek": [], "table": None, "tags": fields}
    parts: list[bytes] = []
    while at is not None and at + 4 <= stop:
        found = _frame_at(data, at, stop)
        if not found or at + found[5] > stop or (out["frames"] and (found[0], found[1], found[4]) != (out["version"], out["layer"], out["rate"])):
            back = find_frame(data, at + 1, stop)
            out["resyncs"] += 1
            out["skipped"] += (stop if back is None else back) - at
            at = back
            continue
        version, layer, protected, kbit, hertz, size, samples, channels = found
        if not out["frames"] and out["table"] is None:
            out |= {"rate": hertz, "version": version, "layer": layer, "channels": channels}
            if layer == 3 and (t := table(data[at : at + size], version, channels)):
                out["table"] = t
                at += size
                continue
        body = at + 4
        if protected:
            out["checked"] += 1
            out["crc_errors"] += not checksum_holds(data, at, found)
            body += 2
        if layer == 3:
            body += side_bytes(version, channels)
        if out["frames"] % every == 0:
            out["seek"].append(at)
        parts.append(data[body : at + size])
        out["frames"] += 1
        out["samples"] += samples
        out["low"], out["high"] = min(out["low"] or kbit, kbit), max(out["high"], kbit)
        at += size
    out["parts"] = parts
    return out, at


def duration(parsed: dict) -> tuple[int, int]:
    """Seconds as an exact fraction in lowest terms."""
    d = gcd(parsed["samples"], parsed["rate"]) or 1
    return parsed["samples"] // d, parsed["rate"] // d or 1


@cache
def _frame(units: int) -> tuple[bytes, int]:
    """(header, checksum and silent side information; bytes of ancillary data) of the smallest frame for so many units."""
    for index in range(1, 15):
        word = 0x7FF << 21 | 3 << 19 | 1 << 17 | index << 12 | 1 << 10 | 3 << 6
        size = header(word)[5]
        if size - 23 >= units * UNIT:
            lead, side = word.to_bytes(4), bytes(17)
            return lead + crc16(lead[2:] + side).to_bytes(2) + side, size - 23
    raise ValueError(units)


def store(text: str | None) -> bytes:
    """The text's UTF-8 bytes, filled with spaces to a positive multiple of 192, as an MPEG-1 Layer III stream."""
    raw = (text or "").encode()
    payload = raw + b" " * ((-len(raw)) % UNIT or (0 if raw else UNIT))
    units = len(payload) // UNIT
    counts = [4] * (units // 4) + ([units % 4] if units % 4 else [])
    frames, at = [], 0
    for n in counts:
        lead, room = _frame(n)
        piece = payload[at : at + n * UNIT]
        frames.append(lead + piece + bytes(room - len(piece)))
        at += n * UNIT
    ends = np.cumsum([0, *map(len, frames)])
    first, room = _frame(1)
    total = int(ends[-1]) + len(first) + room
    seek = bytes(min(255, int(256 * (len(first) + room + ends[k * len(frames) // 100]) / total)) for k in range(100))
    # the table stands where the side information ends; this frame's checksum is that of silence too
    info = b"Xing" + (7).to_bytes(4) + len(frames).to_bytes(4) + total.to_bytes(4) + seek
    body = b"".join(b"TXXX" + len(x).to_bytes(4) + b"\0\0" + x for x in (b"\x03" + f"{k}\0{v}".encode() for k, v in (("text_bytes", len(raw)), ("payload_bytes", len(payload)))))
    size = len(body)
    tag = b"ID3\x03\0\0" + bytes((size >> s) & 127 for s in (21, 14, 7, 0)) + body
    return tag + first + info + bytes(room - len(info)) + b"".join(frames)


def payload_of(parsed: dict) -> bytes:
    """The payload of a stream that :func:`store` wrote."""
    left, out = int(parsed["tags"]["payload_bytes"]), []
    for part in parsed["parts"]:
        n = min(left, len(part) // UNIT * UNIT, 4 * UNIT)
        out.append(part[:n])
        left -= n
    return b"".join(out)


FACTS = "struct<n_bytes:long,payload_bytes:long,payload_sha256:string,tail_crc32:long,feature:string,frames:int,samples:long,rate:int,crc_errors:int,seek_offsets:array<long>>"


def describe(data: bytes) -> dict:
    """Facts of a stored stream, all read back from its bytes."""
    got = parse(data)
    payload = payload_of(got)
    seconds = duration(got)
    entropy = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    feature = f"mpeg{got['version']:g}-layer{got['layer']} {got['rate']}Hz {got['channels']}ch {got['low']}-{got['high']}kbit/s frames={got['frames']} seconds={seconds[0]}/{seconds[1]} table={got['table'] and got['table']['kind']} crc={got['checked']}/{got['crc_errors']} values={int((entropy > 0).sum())}"
    return {"n_bytes": int(got["tags"]["text_bytes"]), "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": crc32(payload[-16:]), "feature": feature, "frames": got["frames"], "samples": got["samples"], "rate": got["rate"], "crc_errors": got["crc_errors"], "seek_offsets": got["seek"]}


def add_media(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """``df`` with the column ``media``: each text stored as an MPEG audio stream (a column of that name is replaced)."""
    return df.withColumn(media, F.pandas_udf(lambda texts: pd.Series([store(t) for t in texts], dtype="object"), "binary")(F.col(text)))


def add_facts(df: DataFrame, media: str = "media", facts: str = "facts") -> DataFrame:
    """``df`` with the struct ``facts`` read from the column ``media``."""
    return df.withColumn(facts, F.pandas_udf(lambda streams: pd.DataFrame([describe(bytes(x)) for x in streams], columns=_names()), FACTS)(F.col(media)))


def _names() -> list[str]:
    return re.findall(r"(\w+):", FACTS)


def digest(docs: DataFrame) -> DataFrame:
    """One row for each document: what its stored stream holds."""
    made = add_facts(add_media(docs.select("doc_id", "text")).drop("text"))
    own = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32"]
    return made.select("doc_id", *(f"facts.{c}" for c in own), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "facts.feature", "facts.frames", "facts.samples", "facts.rate", "facts.crc_errors", "facts.seek_offsets")
