"""Operator 5: media columns, MPEG audio.

The reader walks a stream frame by frame. It skips ID3v2 tags, resynchronises after damage by looking for a header
whose successor is a header of the same kind, reads Xing, Info and VBRI tables, verifies the checksums of protected
Layer III frames, and keeps exact durations (samples and rate, both integers) and the offset of every frame to seek
by. The writer stores bytes losslessly, a unit of 576 to a protected frame's data area, behind a tag and a table; an
ID3v1 tag ends the stream, so that no reader takes payload bytes at its place for one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.llm.common import small_batches, table

UNIT = 576
# Bit rates in kbit/s by index 1 to 14, for MPEG-1 layers I, II, III and MPEG-2 layer I and layers II and III;
# sampling rates of MPEG-1. Fixed values of the format.
RATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = (44100, 48000, 32000)


@dataclass(frozen=True)
class Header:
    version: str
    layer: int
    bitrate: int
    rate: int
    length: int
    samples: int
    mono: bool
    protected: bool
    side: int

    def like(self, other: "Header | None") -> bool:
        return other is not None and (self.version, self.layer, self.rate) == (other.version, other.layer, other.rate)


@lru_cache(1 << 12)
def header(word: bytes) -> Header | None:
    """The header in four bytes; None if they are none, or of the free format, whose frames carry no length."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version, layer = {0: "2.5", 2: "2", 3: "1"}.get(word[1] >> 3 & 3), 4 - (word[1] >> 1 & 3)
    index, hertz = word[2] >> 4, word[2] >> 2 & 3
    if version is None or layer == 4 or index in (0, 15) or hertz == 3 or word[3] & 3 == 2:
        return None
    first = version == "1"
    bitrate = RATES[1 if first else 2, layer][index - 1] * 1000
    rate = HERTZ[hertz] // {"1": 1, "2": 2, "2.5": 4}[version]
    pad, mono = word[2] >> 1 & 1, word[3] >> 6 == 3
    samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
    length = (12 * bitrate // rate + pad) * 4 if layer == 1 else samples // 8 * bitrate // rate + pad
    side = ((17 if mono else 32) if first else (9 if mono else 17)) if layer == 3 else 0
    return Header(version, layer, bitrate, rate, length, samples, mono, not word[1] & 1, side)


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        c = n << 8
        for _ in range(8):
            c = (c << 1) ^ 0x8005 if c & 0x8000 else c << 1
        out.append(c & 0xFFFF)
    return out


_CRC = _crc_table()


@lru_cache(1 << 12)
def crc16(data: bytes) -> int:
    c = 0xFFFF
    for b in data:
        c = (c << 8 & 0xFF00) ^ _CRC[c >> 8 ^ b]
    return c


@dataclass
class Stream:
    """What a reader found. offsets: where audio frames begin, the table's own frame excluded."""

    offsets: list[int] = field(default_factory=list)
    headers: list[Header] = field(default_factory=list)
    tags: dict[str, str] = field(default_factory=dict)
    table: dict = field(default_factory=dict)
    skipped: int = 0
    resyncs: int = 0
    crc_good: int = 0
    crc_bad: int = 0

    @property
    def samples(self) -> int:
        return sum(h.samples for h in self.headers)

    @property
    def rate(self) -> int:
        return self.headers[0].rate if self.headers else 0

    def seek(self, sample: int) -> int:
        """Offset of the frame that holds a sample."""
        return self.offsets[min(sample // self.headers[0].samples, len(self.offsets) - 1)]


def _syncsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _id3v2(data: bytes, at: int, tags: dict[str, str]) -> int:
    """Size of the ID3v2 tag at an offset, with its text frames added to tags; 0 if there is none."""
    if data[at : at + 3] != b"ID3" or len(data) < at + 10 or max(data[at + 6 : at + 10]) > 127:
        return 0
    major, flags, size = data[at + 3], data[at + 5], _syncsafe(data[at + 6 : at + 10])
    pos, end = at + 10, min(at + 10 + size, len(data))
    while major in (3, 4) and pos + 10 <= end and data[pos : pos + 1].isalpha():
        n = _syncsafe(data[pos + 4 : pos + 8]) if major == 4 else int.from_bytes(data[pos + 4 : pos + 8], "big")
        body = data[pos + 10 : min(pos + 10 + n, end)]
        if data[pos : pos + 1] == b"T" and body:
            name = data[pos : pos + 4].decode("latin-1")
            tags[name] = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be"}.get(body[0], "utf-8"), "replace").rstrip("\0")
        pos += 10 + n
    return 10 + size + (10 if flags & 0x10 else 0)


def _tail(data: bytes, tags: dict[str, str]) -> int:
    """Where the audio ends: before an ID3v1 tag and before an APE tag."""
    end = len(data)
    if data[-128:-125] == b"TAG" and end >= 128:
        for name, a, b in (("TIT2", 3, 33), ("TPE1", 33, 63), ("TALB", 63, 93)):
            if value := data[end - 128 + a : end - 128 + b].rstrip(b"\0 ").decode("latin-1"):
                tags.setdefault(name, value)
        end -= 128
    if data[end - 32 : end - 24] == b"APETAGEX":
        size, _, flags = struct.unpack("<III", data[end - 20 : end - 8])
        end = max(0, end - size - (32 if flags >> 31 else 0))
    return end


def _table(data: bytes, at: int, h: Header) -> dict:
    """The variable-bitrate table in a frame; empty if there is none."""
    x = at + 4 + h.side + (2 if h.protected else 0)
    for x in (x, at + 4 + h.side):  # some writers leave the checksum's place out
        if data[x : x + 4] in (b"Xing", b"Info"):
            flags, pos, out = int.from_bytes(data[x + 4 : x + 8], "big"), x + 8, {"kind": data[x : x + 4].decode()}
            for bit, name in ((1, "frames"), (2, "bytes")):
                if flags & bit:
                    out[name] = int.from_bytes(data[pos : pos + 4], "big")
                    pos += 4
            if flags & 4:
                out["toc"] = list(data[pos : pos + 100])
            return out
    x = at + 36
    if data[x : x + 4] == b"VBRI":
        size, frames, entries, scale, width, per = struct.unpack(">IIHHHH", data[x + 10 : x + 26])
        toc = [int.from_bytes(data[x + 26 + i * width : x + 26 + (i + 1) * width], "big") * scale for i in range(entries)]
        return {"kind": "VBRI", "frames": frames, "bytes": size, "toc": toc, "frames_per_entry": per}
    return {}


def read(data: bytes) -> Stream:
    """Walks a whole stream. Damage is skipped and counted; a stream without frames gives an empty Stream."""
    s = Stream()
    end, at, synced = _tail(data, s.tags), 0, False
    while at + 4 <= end:
        if n := _id3v2(data, at, s.tags):
            at, synced = at + n, False
            continue
        h = header(data[at : at + 4])
        if h is not None and at + h.length <= end and not synced:
            after = at + h.length
            if not (after + 4 > end or h.like(header(data[after : after + 4])) or data[after : after + 3] == b"ID3"):
                h = None
        if h is None or at + h.length > end:
            s.resyncs += synced
            synced = False
            to = data.find(b"\xff", at + 1, end)
            to = end if to < 0 else to
            s.skipped += to - at
            at = to
            continue
        if not s.offsets and not s.table and h.layer == 3 and (found := _table(data, at, h)):
            s.table = found
        else:
            s.offsets.append(at)
            s.headers.append(h)
        if h.protected and h.side:
            good = crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + h.side]) == int.from_bytes(data[at + 4 : at + 6], "big")
            s.crc_good, s.crc_bad = s.crc_good + good, s.crc_bad + (not good)
        at, synced = at + h.length, True
    s.skipped += max(0, end - at)
    return s


#: MPEG-1 Layer III, protected, 224 kbit/s, 48 kHz, stereo: a frame of 672 bytes holds a unit behind its side information.
_WORD = bytes((0xFF, 0xFA, 0xC4, 0x00))
_DATA = 4 + 2 + 32


def _frame(body: bytes = b"") -> bytearray:
    h = header(_WORD)
    out = bytearray(h.length)
    out[:4] = _WORD
    out[4:6] = crc16(_WORD[2:] + bytes(h.side)).to_bytes(2, "big")
    out[_DATA : _DATA + len(body)] = body
    return out


def payload_of(data: bytes) -> bytes:
    """Bytes 255 appended up to a positive multiple of a unit."""
    return data + b"\xff" * (max(1, -(-len(data) // UNIT)) * UNIT - len(data))


def write(payload: bytes) -> bytes:
    """A stream that holds a payload of whole units: a tag, a table, a frame for each unit, and a closing tag."""
    title = b"\x03payload"
    text = b"TIT2" + bytes((0, 0, 0, len(title), 0, 0)) + title
    tag = b"ID3\x04\x00\x00" + bytes((0, 0, 0, len(text))) + text
    units = np.frombuffer(payload, dtype=np.uint8).reshape(-1, UNIT)
    frames = np.tile(np.frombuffer(bytes(_frame()), dtype=np.uint8), (len(units), 1))
    frames[:, _DATA : _DATA + UNIT] = units
    toc = bytes(i * 256 // 100 for i in range(100))
    info = b"Info" + struct.pack(">III", 7, len(units), frames.size) + toc
    return tag + bytes(_frame(info)) + frames.tobytes() + b"TAG" + b"payload".ljust(124, b"\0") + b"\xff"


def stored(data: bytes, s: Stream) -> bytes:
    """The payload in the data areas of the frames that ``write`` made."""
    return b"".join([data[o + _DATA : o + _DATA + UNIT] for o in s.offsets])


def encode(text: Column) -> Column:
    """A text's UTF-8 bytes, padded, as an MPEG stream: binary. A null text is empty."""

    @F.pandas_udf("binary")
    def media(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([write(payload_of(t.encode())) for t in texts], dtype=object)

    return media(F.coalesce(text, F.lit("")))


PROBED = "payload binary, frames long, samples long, rate int, bitrate int, crc_good long, crc_bad long, skipped long, resyncs long, table_kind string, table_frames long, title string, offsets array<long>"


def probe(media: Column) -> Column:
    """struct of what a stream holds. A null or empty stream has no frames and an empty payload."""

    @F.pandas_udf(PROBED)
    def probed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for data in rows:
                data = bytes(data or b"")
                s = read(data)
                size = sum(h.length for h in s.headers)
                bitrate = size * 8 * s.rate // s.samples if s.samples else 0
                out.append(
                    (stored(data, s), len(s.offsets), s.samples, s.rate, bitrate, s.crc_good, s.crc_bad, s.skipped, s.resyncs,
                     s.table.get("kind", ""), s.table.get("frames", 0), s.tags.get("TIT2", ""), np.asarray(s.offsets, dtype=np.int64))
                )
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PROBED.split(", ")])

    return probed(media)


def seconds(found: Column) -> Column:
    """The exact duration, as samples over rate."""
    return F.concat(found["samples"].cast("string"), F.lit("/"), found["rate"].cast("string"))


def op5_mpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    d = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), encode(F.col("text")).alias("media"))
    d = d.withColumn("p", probe(F.col("media")))
    feature = F.concat_ws(
        ";", seconds(F.col("p")), *[F.col(f"p.{c}").cast("string") for c in ("frames", "bitrate", "crc_good", "crc_bad", "skipped", "resyncs", "table_kind", "table_frames", "title")],
        F.get("p.offsets", F.size("p.offsets") - 1).cast("string"),
    )
    return d.select(
        "doc_id",
        "n_bytes",
        F.length("p.payload").cast("long").alias("payload_bytes"),
        F.sha2("p.payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("p.payload", -32, 32)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
    )
