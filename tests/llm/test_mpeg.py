import hashlib
import random
import struct
import zlib

import pytest

from studyloom.llm import mpeg as M


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 6000])
def test_round_trip(n):
    rnd = random.Random(n)
    payload = M.payload_of(rnd.randbytes(n))
    assert len(payload) % 576 == 0 and payload[:n] == rnd.__class__(n).randbytes(n) and set(payload[n:]) <= {255}
    s = M.read(M.write(payload))
    assert M.stored(M.write(payload), s) == payload
    assert (s.skipped, s.resyncs, s.crc_bad, s.crc_good) == (0, 0, 0, len(payload) // 576 + 1)
    assert s.table["kind"] == "Info" and s.table["frames"] == len(s.offsets) and s.tags == {"TIT2": "payload"}
    assert s.samples == 1152 * len(s.offsets) and s.rate == 48000


def frame(word, length, side_at=None, body=b""):
    out = bytearray(length)
    out[:4] = word
    out[4 : 4 + len(body)] = body
    return bytes(out)


def test_headers():
    h = M.header(bytes((0xFF, 0xFB, 0x90, 0x00)))
    assert (h.version, h.layer, h.bitrate, h.rate, h.length, h.samples, h.protected) == ("1", 3, 128000, 44100, 417, 1152, False)
    h = M.header(bytes((0xFF, 0xF3, 0x40, 0xC0)))
    assert (h.version, h.layer, h.bitrate, h.rate, h.length, h.samples, h.mono) == ("2", 3, 32000, 22050, 104, 576, True)
    h = M.header(bytes((0xFF, 0xE3, 0x18, 0xC4)))
    assert (h.version, h.rate, h.samples) == ("2.5", 8000, 576)
    h = M.header(bytes((0xFF, 0xFF, 0xC2, 0x00)))
    assert (h.layer, h.samples, h.length) == (1, 384, (12 * 384000 // 44100 + 1) * 4)
    for bad in (b"\xff\xfb\xf0\x00", b"\xff\xfb\x00\x00", b"\xff\xfb\x9c\x00", b"\xff\xeb\x90\x00", b"\xff\xf9\x90\x00", b"\xfe\xfb\x90\x00", b"\xff\xfb\x90\x02", b"\xff"):
        assert M.header(bad) is None


def test_resynchronises():
    one = frame(b"\xff\xfb\x90\x00", 417)
    noise = b"\xff\xfb\x90junk\xff\xff"
    s = M.read(one * 3 + noise + one * 2 + b"TAG" + b"title".ljust(125, b"\0"))
    assert len(s.offsets) == 5 and s.resyncs == 1 and s.skipped == len(noise)
    assert s.offsets[3] == 3 * 417 + len(noise) and s.seek(3 * 1152 + 5) == s.offsets[3]
    assert s.tags == {"TIT2": "title"}
    cut = M.read(one * 2 + one[:100])
    assert len(cut.offsets) == 2 and cut.skipped == 100


def test_checksums():
    data = bytearray(M.write(M.payload_of(b"x" * 1000)))
    s = M.read(bytes(data))
    data[s.offsets[1] + 6] ^= 1
    assert (M.read(bytes(data)).crc_good, M.read(bytes(data)).crc_bad) == (s.crc_good - 1, 1)


def test_tables_and_tags():
    body = b"\0" * 32 + b"VBRI" + struct.pack(">HHHIIHHHH", 1, 0, 75, 12345, 99, 2, 1, 2, 10) + struct.pack(">HH", 7, 8)
    s = M.read(frame(b"\xff\xfb\x90\x00", 417, body=body) + frame(b"\xff\xfb\xa0\x00", 522) * 2)
    assert s.table == {"kind": "VBRI", "frames": 99, "bytes": 12345, "toc": [7, 8], "frames_per_entry": 10}
    assert [h.bitrate for h in s.headers] == [160000, 160000]
    ape = b"APETAGEX" + struct.pack("<IIII", 2000, 32, 0, 0) + b"\0" * 8
    assert len(M.read(frame(b"\xff\xfb\x90\x00", 417) * 3 + ape).offsets) == 3


@pytest.mark.parametrize("data", [b"", b"\xff", b"\xff" * 5000, b"ID3", b"ID3\x04\0\0\x7f\x7f\x7f\x7f", b"hello" * 100])
def test_not_audio(data):
    s = M.read(data)
    assert s.offsets == [] and s.samples == 0 and s.rate == 0


def test_query(spark, documents, awkward):
    got = M.op5_mpeg(spark, documents(awkward)).collect()
    assert len(got) == len(awkward)
    texts = {r[0]: r[1] for r in awkward}
    for r in got:
        payload = M.payload_of((texts[r.doc_id] or "").encode()) if r.doc_id is not None else None
        if payload is not None:
            media = M.write(payload)
            want = (len((texts[r.doc_id] or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest())
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) == want
    assert M.op5_mpeg(spark, documents([])).collect() == []


@pytest.mark.parametrize("units", [1, 3])
def test_tag_letters_in_the_payload(units):
    payload = M.payload_of(b"a" * (576 * units - 70) + b"TAG" + b"b" * 60)
    media = M.write(payload)
    assert M.stored(media, M.read(media)) == payload
