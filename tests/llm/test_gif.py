import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm.common import limited
from textloom.llm.gif import decode_gif, encode_gif, gif_frames, lzw_decode, lzw_encode, media_digest, pack_codes, payload_of, with_media


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=600))
def test_lzw_round_trip(data):
    assert lzw_decode(lzw_encode(data), 8, len(data)) == data


@pytest.mark.parametrize("data", [bytes(90_000), random.Random(1).randbytes(64 * 2000), bytes(range(256)) * 512, b"ab" * 32 * 4000])
def test_gif_round_trip_over_full_tables_and_frames(data):
    image = encode_gif(data + bytes(-len(data) % 64))
    assert b"".join(f.samples for f in decode_gif(image, paint=False)) == data + bytes(-len(data) % 64)


def test_deferred_clear_and_small_code_sizes():
    # 2-bit samples by hand: clear, 1, 6 (= entry 1 1), 2, stop
    assert lzw_decode(pack_codes([4, 1, 6, 2, 5], np.array([3, 3, 3, 3, 4])), 2, 99) == bytes([1, 1, 1, 2])
    with pytest.raises(ValueError):
        lzw_decode(pack_codes([4, 7], np.array([3, 3])), 2, 99)


def _image(frames, palette=bytes((0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255)), size=(2, 2)):
    parts = [b"GIF89a", struct.pack("<HHBBB", *size, 0x81, 0, 0), palette]
    for disposal, clear, rect, samples, interlaced in frames:
        parts.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (clear is not None), 7, clear or 0, 0))
        parts.append(struct.pack("<BHHHHBB", 0x2C, *rect, 0x40 * interlaced, 2))
        codes, widths = [4], [3]
        for s in samples:  # a clear code before each sample keeps every code three bits wide
            codes += [s, 4]
            widths += [3, 3]
        body = pack_codes([*codes, 5], np.array([*widths, 3]))
        parts.append(bytes((len(body),)) + body + b"\0")
    return b"".join([*parts, b";"])


def test_disposal_and_transparency():
    image = _image([(1, None, (0, 0, 2, 2), [1, 1, 1, 1], 0), (3, 0, (0, 0, 1, 1), [2], 0), (2, 0, (1, 1, 1, 1), [3], 0), (0, 0, (0, 0, 2, 1), [0, 2], 0)])
    a, b, c, d = (f.canvas for f in decode_gif(image))
    red, green, blue = [255, 0, 0, 255], [0, 255, 0, 255], [0, 0, 255, 255]
    assert a.tolist() == [[red, red], [red, red]]
    assert b.tolist() == [[green, red], [red, red]]
    assert c.tolist() == [[red, red], [red, blue]]  # frame 2 is taken back
    assert d.tolist() == [[red, green], [red, [0, 0, 0, 0]]]  # frame 3 is cleared, index 0 shows what is below


def test_interlace():
    rows = list(range(8))
    image = _image([(0, None, (0, 0, 1, 8), [r % 4 for r in (0, 4, 2, 6, 1, 3, 5, 7)], 1)], size=(1, 8))
    assert list(next(iter(decode_gif(image))).samples) == [r % 4 for r in rows]


def test_frames_table(spark):
    df = spark.createDataFrame([(1, encode_gif(bytes([200]) * 64 * 1500)), (2, None), (3, b"GIF89a broken"), (4, b"")], "id long, media binary")
    rows = gif_frames(df, carry=["id"]).orderBy("id", "frame").collect()
    assert [(r.id, r.frame, r.start_cs, r.height) for r in rows] == [(1, 0, 0, 1024), (1, 1, 10, 476)]
    assert rows[0].histogram[12] == 64 * 1024 and sum(rows[0].histogram) == 3 * 64 * 1024


def _read(image):
    """An independent reader of one-block-after-another GIFs: bit by bit, a dictionary of codes, pixels painted one by one."""
    width, height = image[6] | image[7] << 8, image[8] | image[9] << 8
    palette, at = [tuple(image[13 + 3 * i : 16 + 3 * i]) for i in range(256)], 13 + 768
    canvas, samples, frames, time = [(0, 0, 0)] * (width * height), [], 0, 0
    tally = [[0] * 16 for _ in range(3)]
    while image[at] != 0x3B:
        if image[at] == 0x21:
            time += image[at + 4] | image[at + 5] << 8
            at += 8
            continue
        w, h = image[at + 5] | image[at + 6] << 8, image[at + 7] | image[at + 8] << 8
        least, at, body = image[at + 10], at + 11, []
        while image[at]:
            body += image[at + 1 : at + 1 + image[at]]
            at += 1 + image[at]
        at += 1
        bits = (byte >> k & 1 for byte in body for k in range(8))
        book, out, last = {}, [], None
        while True:
            size = next(k for k in range(least + 1, 13) if k == 12 or len(book) < 1 << k) if book else least + 1
            code = sum(next(bits) << k for k in range(size))
            if code == 1 << least:
                book, last = {i: [i] for i in range(1 << least)} | {1 << least: [], (1 << least) + 1: []}, None
                continue
            if code == (1 << least) + 1:
                break
            entry = book[code] if code in book else [*last, last[0]]
            if last is not None and len(book) < 4096:
                book[len(book)] = [*last, entry[0]]
            out += entry
            last = entry
        samples += out
        canvas[: w * h] = [palette[x] for x in out]
        for pixel in canvas:
            for c in range(3):
                tally[c][pixel[c] // 16] += 1
        frames += 1
    shares = "".join(f"{n * 255 // sum(t):02x}" for t in tally for n in t)
    return bytes(samples), f"{shares}:{frames}:{time}"


def test_query_path_against_an_independent_reader(spark):
    rng = random.Random(7)
    texts = ["", "x", "the quick brown fox " * 30, "é🔥" * 500, "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(20_000)), "abc " * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    stored = with_media(df, carry=["doc_id"])
    assert "frame" in media_digest(stored, carry=["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    got = {r.doc_id: r for r in media_digest(stored, carry=["doc_id"]).collect()}
    images = {r.doc_id: bytes(r.media) for r in stored.collect()}
    for i, t in enumerate(texts):
        payload, feature = _read(images[i])
        assert payload == payload_of(t)
        assert (got[i].payload_sha256, got[i].feature) == (hashlib.sha256(payload).hexdigest(), feature)


def test_digest_of_null_damaged_and_many_images(spark):
    whole = encode_gif(bytes(range(64)) * 1500)
    rows = [(1, whole), (2, None), (3, b""), (4, b"GIF89a broken"), (5, whole[: len(whole) - 60]), (1, whole), (6, b"\0" * 9)] + [(k, encode_gif(bytes([k % 251]) * 64)) for k in range(10, 2000)]
    got = media_digest(limited(spark.createDataFrame(rows, "id long, media binary").coalesce(1), rows=97), carry=["id"]).collect()
    by = {r.id: r for r in got}
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(got) == len(rows) and by[2].media_bytes is None and by[2].media_sha256 is None
    for i in (2, 3, 4, 6):
        assert (by[i].payload_bytes, by[i].payload_sha256, by[i].tail_crc32, by[i].feature) == (0, nothing, 0, "00" * 48 + ":0:0")
    assert by[1].payload_bytes == 64 * 1500 and by[1].feature.endswith(":2:20") and 0 < by[5].payload_bytes
    for k in range(10, 2000):
        assert by[k].payload_sha256 == hashlib.sha256(bytes([k % 251]) * 64).hexdigest()


def test_media_digest_edge_cases(spark):
    texts = [None, "", "x", "é" * 32, "a" * 64, "long " * 40_000, "x", "nul\0 end"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    got = {r.doc_id: r for r in media_digest(with_media(df, carry=["doc_id"]), carry=["doc_id", "n_bytes"]).collect()}
    for i, t in enumerate(texts):
        p = payload_of(t or "")
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest())
        assert r.tail_crc32 == zlib.crc32(p[-64:])
        assert (r.media_bytes, r.media_sha256) == (len(encode_gif(p)), hashlib.sha256(encode_gif(p)).hexdigest())
    assert got[2][2:] == got[6][2:]
    assert media_digest(with_media(df.limit(0), carry=["doc_id"]), carry=["doc_id", "n_bytes"]).count() == 0
