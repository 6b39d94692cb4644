"""Media columns: GIF images as lossless carriers of 8-bit samples, and a decoder for any GIF.

The encoder writes timed frames whose palette is the identity grey ramp, so a sample's value is
its palette index. The decoder handles what the format allows: global and local palettes,
interlacing, LZW with deferred clear codes, transparency and the disposal rules 0 to 3.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import kept

WIDTH = 64
#: Rows of one frame; a payload beyond that goes on in the next frame.
FRAME_ROWS = 1024
DELAY_CS = 10
HIST_BINS = 16
_GREY = bytes(v for i in range(256) for v in (i, i, i))


#: Codes that are unpacked at once; more than a table takes to fill, so most runs hold a clear code.
_RUN = 4096


@lru_cache(16)
def _widths(min_bits: int, skip: int = 0) -> np.ndarray:
    """Bits of each code since the last clear code, from the ``skip``-th on.

    Encoder and decoder add an entry a code, so the width follows from the code's place alone.
    """
    entries = (1 << min_bits) + 1 + skip + np.arange(_RUN)
    return np.clip(np.floor(np.log2(entries)).astype(np.int64) + 1, min_bits + 1, 12)


def pack_codes(codes: list[int], widths: np.ndarray) -> bytes:
    """Codes of the given bit widths, least significant bit first."""
    ends = np.cumsum(widths)
    starts = ends - widths
    value = np.asarray(codes, np.int64) << (starts & 7)
    at, size = starts >> 3, int(ends[-1] + 7 >> 3) + 2
    total = sum(np.bincount(at + k, value >> 8 * k & 255, size) for k in range(3))  # no two codes share a bit
    return total[: size - 2].astype(np.uint8).tobytes()


_ROOTS = {chr(i): i for i in range(256)}


def lzw_encode(data: bytes) -> bytes:
    """GIF's LZW over 8-bit samples, a clear code first and whenever the table is full."""
    codes, widths = [256], [np.array([9])]
    put, since, left = codes.append, 1, data.decode("latin-1")
    while left:
        book, following, match, used = dict(_ROOTS), 258, "", 0
        for sample in left:
            longer = match + sample
            if longer in book:
                match = longer
                continue
            put(book[match])
            used += len(match)
            if following == 4096:
                match = ""
                break
            book[longer] = following
            following += 1
            match = sample
        if match:
            put(book[match])
            used += len(match)
        left = left[used:]
        put(256 if left else 257)
        widths.append(_widths(8)[: len(codes) - since])
        since = len(codes)
    if not data:
        put(257)
        widths.append(np.array([9]))
    return pack_codes(codes, np.concatenate(widths))


def lzw_decode(stream: bytes, min_bits: int, most: int) -> bytes:
    """The first ``most`` samples of a code stream of any clear-code policy; a cut stream gives what it holds."""
    clear = 1 << min_bits
    base = [bytes((i,)) for i in range(clear)] + [b"", b""]
    data = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    out: list[bytes] = []
    put, total, bit, since = out.append, 0, 0, 0
    book, last = list(base), b""
    while total < most:
        widths = _widths(min_bits, min(since, _RUN))
        ends = bit + np.cumsum(widths)
        widths = widths[: np.searchsorted(ends, 8 * len(stream), "right")]
        if not len(widths):
            break
        starts = ends[: len(widths)] - widths
        at = starts >> 3
        run = (data[at] | data[at + 1] << 8 | data[at + 2] << 16) >> (starts & 7) & (1 << widths) - 1
        marks = np.flatnonzero(run >> 1 == clear >> 1) if min_bits else np.flatnonzero((run == 1) | (run == 2))
        n = int(marks[0]) if len(marks) else len(run)
        before, add, part = len(out), book.append, run[:n].tolist()
        if part and not last:
            last = book[part.pop(0)] if part[0] < len(book) else b""
            if not last:
                raise ValueError("a code beyond the table")
            put(last)
        room = 4096 - len(book)
        for code in part[:room]:
            try:
                entry = book[code]
            except IndexError:
                if code > len(book):
                    raise ValueError("a code beyond the table") from None
                entry = last + last[:1]
            put(entry)
            add(last + entry[:1])
            last = entry
        for code in part[room:]:
            last = book[code]
            put(last)
        total += sum(map(len, out[before:]))
        if not len(marks):
            bit, since = int(ends[len(widths) - 1]), since + n
            continue
        bit = int(ends[n])
        if run[n] != clear:
            break
        book, last, since = list(base), b"", 0
    return b"".join(out)[:most]


def encode_gif(payload: bytes, width: int = WIDTH, frame_rows: int = FRAME_ROWS, delay_cs: int = DELAY_CS) -> bytes:
    """``payload`` (a positive multiple of ``width`` bytes) as an animation of grey frames, each sample a pixel."""
    if not payload or len(payload) % width:
        raise ValueError("payload must be a positive multiple of the width")
    height = min(frame_rows, len(payload) // width)
    parts = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), _GREY]
    for at in range(0, len(payload), width * frame_rows):
        frame = payload[at : at + width * frame_rows]
        parts.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, delay_cs, 0, 0))
        parts.append(struct.pack("<BHHHHBB", 0x2C, 0, 0, width, len(frame) // width, 0, 8))
        codes = lzw_encode(frame)
        for k in range(0, len(codes), 255):
            piece = codes[k : k + 255]
            parts.append(bytes((len(piece),)) + piece)
        parts.append(b"\0")
    parts.append(b"\x3b")
    return b"".join(parts)


@dataclass
class Frame:
    """One timed frame: its own raster (palette indices), where it lies, and the canvas after it is drawn."""

    index: int
    delay_cs: int
    disposal: int
    left: int
    top: int
    width: int
    height: int
    samples: bytes
    canvas: np.ndarray  # height x width x 4, RGBA


_LANES = ((0, 8), (4, 8), (2, 4), (1, 2))


def _sub_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and (n := data[at]):
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def decode_gif(data: bytes, paint: bool = True) -> Iterator[Frame]:
    """The frames of a GIF, one at a time. With ``paint`` false the canvas is left empty (samples only)."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    across, down, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at, common = 13, None
    if flags & 0x80:
        n = 3 << ((flags & 7) + 1)
        common = np.frombuffer(data[at : at + n].ljust(n, b"\0"), np.uint8).reshape(-1, 3)
        at += n
    canvas = np.zeros((down, across, 4), np.uint8) if paint else np.zeros((0, 0, 4), np.uint8)
    delay, disposal, clear_index, index = 0, 0, None, 0
    while at < len(data) and data[at] != 0x3B:
        kind = data[at]
        at += 1
        if kind == 0x21:
            label = data[at] if at < len(data) else 0
            body, at = _sub_blocks(data, at + 1)
            if label == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, body[1] | body[2] << 8
                clear_index = body[3] if body[0] & 1 else None
            continue
        if kind != 0x2C:
            raise ValueError("an unknown block")
        left, top, w, h, own = struct.unpack_from("<HHHHB", data, at)
        at += 9
        palette = common
        if own & 0x80:
            n = 3 << ((own & 7) + 1)
            palette = np.frombuffer(data[at : at + n].ljust(n, b"\0"), np.uint8).reshape(-1, 3)
            at += n
        bits = data[at]
        codes, at = _sub_blocks(data, at + 1)
        samples = lzw_decode(codes, bits, w * h).ljust(w * h, b"\0")
        if own & 0x40:
            raster = np.frombuffer(samples, np.uint8).reshape(h, w)
            order = [y for first, step in _LANES for y in range(first, h, step)]
            back = np.empty_like(raster)
            back[order] = raster
            samples = back.tobytes()
        if paint:
            before = canvas.copy() if disposal == 3 else None
            raster = np.frombuffer(samples, np.uint8).reshape(h, w)[: max(0, down - top), : max(0, across - left)]
            spot = canvas[top : top + raster.shape[0], left : left + raster.shape[1]]
            colours = np.zeros((256, 3), np.uint8)
            if palette is not None:
                colours[: len(palette)] = palette
            shown = np.ones(raster.shape, bool) if clear_index is None else raster != clear_index
            spot[shown, :3] = colours[raster[shown]]
            spot[shown, 3] = 255
        yield Frame(index, delay, disposal, left, top, w, h, samples, canvas.copy() if paint else canvas)
        if paint and disposal == 2:
            canvas[top : top + h, left : left + w] = 0
        elif paint and disposal == 3:
            canvas = before
        delay, disposal, clear_index, index = 0, 0, None, index + 1


def histogram(rgba: np.ndarray, bins: int = HIST_BINS) -> list[int]:
    """Pixels per channel and bin (red, green, blue in turn); pixels that show nothing don't count."""
    shown = rgba[..., 3] > 0
    pixels = rgba.reshape(-1, 4) if shown.all() else rgba[shown]
    place = np.arange(256) * bins // 256
    return [int(n) for c in range(3) for n in np.bincount(place, np.bincount(pixels[:, c], minlength=256), bins)]


def payload_of(text: str, width: int = WIDTH) -> bytes:
    data = text.encode("utf-8", "surrogatepass")
    return data.ljust(max(width, -(-len(data) // width) * width), b"\0")


def with_media(df: DataFrame, text: str = "text", media: str = "media", carry: list[str] | None = None) -> DataFrame:
    """The carried columns, ``n_bytes`` and a GIF column that stores the text's padded bytes, a row per row.

    A null or empty text is 64 zero bytes; a long one goes on over more frames. Equal texts give equal images;
    columns that aren't carried are left out whatever their names.
    """
    carry = kept(carry, "n_bytes", media)
    narrow = df.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__text"), "n_bytes bigint", f"`{media}` binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, images = [], []
            for value in batch.column(len(carry)):
                value = value.as_py()
                sizes.append(len(value.encode()))
                images.append(encode_gif(payload_of(value)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(sizes, pa.int64()), pa.array(images, pa.binary())], names=[*carry, "n_bytes", media])

    return narrow.mapInArrow(run, schema)


_FRAME_COLUMNS = {"frame": pa.int32(), "start_cs": pa.int64(), "delay_cs": pa.int32(), "disposal": pa.int32(), "width": pa.int32(), "height": pa.int32(), "samples": pa.binary(), "histogram": pa.list_(pa.int64())}


def gif_frames(df: DataFrame, media: str = "media", carry: list[str] | None = None, bins: int = HIST_BINS, keep_empty: bool = False) -> DataFrame:
    """A row per frame of each GIF: timing, geometry, samples, and the colour histogram of the canvas once the frame is
    painted by palette, transparency and disposal.

    Frames of an image follow each other within a partition. A damaged image gives the frames before the damage; a
    null, an empty one and one without any give no row, or with ``keep_empty`` one of nulls. Repeated rows give equal
    frames each, an empty table none; columns that aren't carried are left out whatever their names.
    """
    carry = kept(carry, *_FRAME_COLUMNS)
    narrow = df.select(*carry, F.col(media).alias("__media"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__media"), "frame int, start_cs bigint, delay_cs int, disposal int, width int, height int, samples binary, histogram array<bigint>"])
    names = [*carry, *_FRAME_COLUMNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, held = [], [], 0

            def part() -> pa.RecordBatch:
                own = batch.take(pa.array(rows, pa.int64()))
                return pa.RecordBatch.from_arrays([*own.columns[: len(carry)], *(pa.array([r[k] for r in found], t) for k, t in enumerate(_FRAME_COLUMNS.values()))], names=names)

            for i, value in enumerate(batch.column(len(carry))):
                start, before = 0, len(found)
                try:
                    for f in decode_gif(value.as_py() or b""):
                        found.append((f.index, start, f.delay_cs, f.disposal, f.width, f.height, f.samples, histogram(f.canvas, bins)))
                        rows.append(i)
                        start += f.delay_cs
                        held += len(f.samples)
                        if held > _HELD_BYTES:  # frames of a long image go out as they are decoded
                            yield part()
                            rows, found, held, before = [], [], 0, -1
                except (ValueError, IndexError, struct.error):
                    pass
                if keep_empty and len(found) == before:
                    found.append((None,) * len(_FRAME_COLUMNS))
                    rows.append(i)
            if rows:
                yield part()

    return narrow.mapInArrow(run, schema)


#: Samples that wait to be sent on.
_HELD_BYTES = 8 << 20


def frames_digest(frames: DataFrame, carry: list[str] | None = None, bins: int = HIST_BINS) -> DataFrame:
    """A row per image of what `gif_frames` gives with ``keep_empty``: the payload's length and digests, and a feature.

    Read frame by frame in the order of the partition, so no image has to be whole in memory and nothing is
    shuffled. The feature is the colour histogram over all painted frames (per channel and bin its share in 255ths,
    hexadecimal), the number of frames and the running time. An image without a frame has a payload of no bytes.
    """
    carry = kept(carry, "payload_bytes", "payload_sha256", "tail_crc32", "feature")
    narrow = frames.select(*carry, "frame", "delay_cs", "samples", "histogram")
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes[: len(carry)]), "payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, feature string"])
    names = [*carry, "payload_bytes", "payload_sha256", "tail_crc32", "feature"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, digest, size, tail, counts, n, time = None, hashlib.sha256(), 0, b"", np.zeros(3 * bins, np.int64), 0, 0

        def close() -> tuple:
            channel = max(1, int(counts.sum()) // 3)
            feature = "".join(f"{int(b) * 255 // channel:02x}" for b in counts) + f":{n}:{time}"
            return size, digest.hexdigest(), zlib.crc32(tail), feature

        for batch in batches:
            own = len(carry)
            heads, found = [], []  # carried columns of the images that end in this batch, and what was found of them
            for i, (frame, delay, samples, tally) in enumerate(zip(*(batch.column(own + k) for k in range(4)), strict=True)):
                index = frame.as_py()
                if not index:  # null or 0: the next image begins
                    if first is not None:
                        heads.append(first)
                        found.append(close())
                    first, digest, size, tail, counts, n, time = batch.slice(i, 1), hashlib.sha256(), 0, b"", np.zeros(3 * bins, np.int64), 0, 0
                if index is not None:
                    data = samples.as_buffer()
                    digest.update(data)
                    size += data.size
                    tail = (tail + data.slice(max(0, data.size - 64)).to_pybytes())[-64:]
                    counts += np.asarray(tally.values)
                    n, time = n + 1, time + delay.as_py()
            if heads:
                yield _digested(heads, found, own, types, names)
        if first is not None:
            yield _digested([first], [close()], len(carry), types, names)

    return narrow.mapInArrow(run, schema)


def _digested(heads: list[pa.RecordBatch], found: list[tuple], own: int, types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    carried = [pa.concat_arrays([h.column(k) for h in heads]) for k in range(own)]
    return pa.RecordBatch.from_arrays([*carried, *(pa.array([r[k] for r in found], t) for k, t in enumerate(types))], names=names)


def media_digest(df: DataFrame, media: str = "media", carry: list[str] | None = None) -> DataFrame:
    """What the stored images hold, read back through `gif_frames`: digests of payload and image, and a feature per image.

    A row per row. A damaged image counts as far as it goes; a null, an empty one and one that is no GIF have a payload
    of no bytes and a feature of zeros, and a null one a null length and digest. Repeated rows give equal results, an
    empty table none; of columns that aren't carried, none is given, and a result's own name wins over a carried one.
    """
    carry = kept(carry, "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    stored = df.select(*carry, F.length(media).cast("bigint").alias("media_bytes"), F.sha2(F.col(media), 256).alias("media_sha256"), F.col(media).alias("__image"))
    every = [*carry, "media_bytes", "media_sha256"]
    return frames_digest(gif_frames(stored, "__image", every, keep_empty=True), every)
