"""Media columns: Netpbm and BMP pixels as numpy arrays, area resizing, NPY tiles, difference hashes.

Decoders read PBM, PGM and PPM (plain and raw, one or two bytes a sample) and uncompressed
BMP (1, 4, 8, 24 and 32 bits). Resizing averages exact areas from an integral image, so any
target size works. A tile is an NPY array; its hash has a bit for each pair of neighbours
in a row of the 9 x 8 grey image, set where brightness falls.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_np import slices
from .work import fresh_path, pick

#: A payload is a grey image of this width; 576 samples make a square.
WIDTH, UNIT, PAD, TAIL = 24, 576, 255, 32


def _header(data: bytes, n: int) -> tuple[list[int], int]:
    """The first n numbers after a Netpbm magic, comments skipped, and the place after the one space behind."""
    out, i = [], 2
    while len(out) < n:
        while data[i : i + 1].isspace() or data[i : i + 1] == b"#":
            if data[i : i + 1] == b"#":
                i = data.index(b"\n", i)
            i += 1
        j = i
        while data[j : j + 1].isdigit():
            j += 1
        if j == i:
            raise ValueError("bad Netpbm header")
        out.append(int(data[i:j]))
        i = j
    return out, i + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not Netpbm")
    bits, planes = kind in (b"P1", b"P4"), 3 if kind in (b"P3", b"P6") else 1
    head, at = _header(data, 2 if bits else 3)
    width, height, top = head[0], head[1], 1 if bits else head[2]
    shape = (height, width, 3) if planes == 3 else (height, width)
    n = width * height * planes
    if kind == b"P1":
        values = np.frombuffer(bytes(c for c in data[at - 1 :] if c in b"01"), np.uint8)[:n] - 48
        return ((1 - values) * 255).astype(np.uint8).reshape(shape)
    if kind == b"P4":
        row = (width + 7) // 8
        return ((1 - np.unpackbits(np.frombuffer(data, np.uint8, row * height, at).reshape(height, row), axis=1)[:, :width]) * 255).astype(np.uint8)
    if kind in (b"P2", b"P3"):
        values = np.array(data[at - 1 :].split()[:n], np.uint16)
    else:
        values = np.frombuffer(data, ">u2" if top > 255 else np.uint8, n, at)
    return values.reshape(shape) if top == 255 else (values.astype(np.float64) * 255 / top).round().astype(np.uint8).reshape(shape)


def decode_bmp(data: bytes) -> np.ndarray:
    if data[:2] != b"BM":
        raise ValueError("not BMP")
    start, head, width, height = struct.unpack_from("<IIii", data, 10)
    bits, packed = struct.unpack_from("<HI", data, 28)
    if packed not in (0, 3) or bits not in (1, 4, 8, 24, 32):
        raise ValueError("compressed BMP")
    row, rows = (width * bits + 31) // 32 * 4, abs(height)
    raw = np.frombuffer(data, np.uint8, row * rows, start).reshape(rows, row)
    if bits <= 8:
        used = struct.unpack_from("<I", data, 46)[0] or 1 << bits
        colours = np.zeros((256, 4), np.uint8)
        colours[:used] = np.frombuffer(data, np.uint8, used * 4, 14 + head).reshape(-1, 4)
        index = raw if bits == 8 else np.unpackbits(raw, axis=1).reshape(rows, -1, bits) @ (1 << np.arange(bits)[::-1])
        out = colours[index[:, :width], 2::-1] if bits == 8 else colours[index[:, :width]][..., 2::-1]
    else:
        out = raw[:, : width * bits // 8].reshape(rows, width, bits // 8)[..., 2::-1]
    return np.ascontiguousarray(out[::-1] if height > 0 else out)


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_pgm(pixels: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def grey(pixels: np.ndarray) -> np.ndarray:
    return pixels if pixels.ndim == 2 else pixels[..., :3].astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def _edges(n: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(to + 1) * n / to
    whole = np.minimum(at.astype(np.int64), n - 1)
    return whole, at - whole


def resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the exact area of each target pixel, from the integral image, linear between its entries."""
    table = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1))
    table[1:, 1:] = pixels.astype(np.float64).cumsum(axis=0).cumsum(axis=1)
    (r, fr), (c, fc) = _edges(pixels.shape[0], height), _edges(pixels.shape[1], width)
    rows = table[r] * (1 - fr)[:, None] + table[r + 1] * fr[:, None]
    sums = rows[:, c] * (1 - fc) + rows[:, c + 1] * fc
    return np.diff(np.diff(sums, axis=0), axis=1) * (height * width / pixels.size)


def difference_hash(pixels: np.ndarray) -> str:
    small = resize(grey(pixels), 8, 9).round(6)
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(tile), version=(1, 0))
    return out.getvalue()


def tiles(media: DataFrame, side: int = 16) -> DataFrame:
    """(id, media) -> id, tile (NPY bytes of side x side grey samples), dhash, error. A null or unreadable item gets nulls and a message."""

    def run(batches):
        for batch in batches:
            out = []
            for data in batch.column("media").to_pylist():
                try:
                    pixels = decode(data or b"")
                    out.append((npy(resize(grey(pixels), side, side).round().clip(0, 255).astype(np.uint8)), difference_hash(pixels), None))
                except (ValueError, IndexError, struct.error) as e:
                    out.append((None, None, str(e) or "unreadable"))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], ["id", "tile", "dhash", "error"])

    media = media.select(*pick(media, "id", "media"))
    return media.mapInArrow(run, f"id {media.schema['id'].dataType.simpleString()}, tile binary, dhash string, error string")


def payloads(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the text's bytes as a grey image, stored, read back and measured.

    Columns doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256,
    feature (difference hash and mean of the samples), tile (NPY). The UTF-8 bytes are padded
    with 255 to a positive multiple of 576 and written as a PGM into a Parquet column of the
    shared folder; all figures come from that column read again. Null counts as empty; equal
    texts give equal values; no rows give none; further columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(*pick(docs, "doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def write(batches):
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text"), 1 << 20):
                sizes, out = np.diff(offsets), []
                for i, n in enumerate(sizes.tolist()):
                    padded = np.full(max(UNIT, -(-n // UNIT) * UNIT), PAD, np.uint8)
                    padded[:n] = data[offsets[i] : offsets[i + 1]]
                    out.append(encode_pgm(padded.reshape(-1, WIDTH)))
                yield pa.RecordBatch.from_arrays([batch.slice(a, b - a).column("doc_id"), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n_bytes", "media"])

    def read(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part, out = batch.slice(a, 256), []
                for data in part.column("media").to_pylist():
                    pixels = decode_netpbm(data)
                    payload = pixels.tobytes()
                    out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-TAIL:]), len(data), hashlib.sha256(data).hexdigest(), f"{difference_hash(pixels)}:{pixels.mean():.4f}", npy(resize(pixels, 8, 8).round().astype(np.uint8))))
                columns = list(zip(*out, strict=True))
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", "n_bytes", *NAMES])

    path = fresh_path(spark, "media")
    docs.mapInArrow(write, f"doc_id {kind}, n_bytes long, media binary").write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(f"doc_id {kind}, n_bytes long, media binary").parquet(path)
    return stored.mapInArrow(read, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary").select("doc_id", "n_bytes", *NAMES)


NAMES = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile")
