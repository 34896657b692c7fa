"""Media columns: Netpbm and BMP decoded to arrays, resized by area, written as NPY tiles with difference hashes.

decode() reads P1 to P6 and uncompressed BMP (1, 4, 8, 16, 24, 32 bits, with masks, and the old header of 12 bytes). An image is cut into tiles of TILE x TILE, each stored as a
complete NPY file of 8-bit samples, so nothing is lost. Resizing takes the mean over areas from an integral image, with fractional
borders. A difference hash compares neighbours of the gray image resized to 9 x 8: 64 bits, as 16 hex digits.

Tiles live in an array column beside their row, so a row's media stays together, one task handles one row's image at a time, and
nothing is shuffled. Edge cases: null or broken media gives null tiles: a header without size, samples that are missing or above the
maximum, colours that the palette lacks, compression. Sizes are checked against the bytes there are before anything is allocated. A null text is stored as an empty one. An image smaller
than a tile is one smaller tile. Copies give equal values. An output column replaces an input
column of its name; others are kept.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexatlas.llm.common import ready_python, staged, table

TILE = 64
#: Text payloads are images of this many pixels a row, 3 bytes each: 192 bytes.
WIDTH = 64
TILES = "array<struct<row:int,col:int,npy:binary,dhash:string>>"
_TILES = pa.list_(pa.struct([("row", pa.int32()), ("col", pa.int32()), ("npy", pa.binary()), ("dhash", pa.string())]))


def encode_ppm(image: np.ndarray) -> bytes:
    """An (h, w, 3) or (h, w) array of bytes as P6 or P5."""
    kind = b"P6" if image.ndim == 3 else b"P5"
    return kind + b"\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + np.ascontiguousarray(image, np.uint8).tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    """An (h, w, 3) array as 24-bit BMP."""
    h, w = image.shape[:2]
    rows = np.zeros((h, -(-3 * w // 4) * 4), np.uint8)
    rows[:, : 3 * w] = image[::-1, :, ::-1].reshape(h, 3 * w)
    return b"BM" + struct.pack("<IHHI", 54 + rows.size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, rows.size, 2835, 2835, 0, 0) + rows.tobytes()


def _decode_netpbm(data: bytes) -> np.ndarray:
    kind, at, head = data[:2], 2, []
    need = 2 if kind in (b"P1", b"P4") else 3
    token = re.compile(rb"(?:\s|#[^\n]*\n)*(\d{1,9})(?!\d)")
    while len(head) < need:
        m = token.match(data, at)
        if not m:
            raise ValueError("broken Netpbm header")
        head.append(int(m[1]))
        at = m.end()
    w, h, most = head[0], head[1], head[2] if need == 3 else 1
    channels = 3 if kind in (b"P3", b"P6") else 1
    count = w * h * channels
    if not count or not 0 < most < 65536:
        raise ValueError("no samples")
    if count > 8 * len(data):
        raise ValueError("too few samples")
    if kind in (b"P1", b"P2", b"P3"):
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        values = np.frombuffer(re.sub(rb"\s", b"", body)[:count], np.uint8).astype(np.int64) - 48 if kind == b"P1" else np.array(body.split(None, count)[:count], np.int64)
    elif kind == b"P4":
        rows = np.frombuffer(data, np.uint8, h * -(-w // 8), at + 1).reshape(h, -1)
        values = np.unpackbits(rows, axis=1)[:, :w].ravel().astype(np.int64)
    else:
        values = np.frombuffer(data, ">u2" if most > 255 else np.uint8, count, at + 1)
    if len(values) < count:
        raise ValueError("too few samples")
    if values.min() < 0 or values.max() > most:
        raise ValueError("samples above the maximum")
    if kind in (b"P1", b"P4"):
        values = (1 - values) * 255
    elif most != 255:
        values = (values.astype(np.int64) * 255 + most // 2) // most
    return values.astype(np.uint8).reshape((h, w, 3) if channels == 3 else (h, w))


def _masked(pixels: np.ndarray, mask: int) -> np.ndarray:
    """The part of each pixel under a mask, on a scale of 0 to 255."""
    if not mask:
        return np.zeros(pixels.shape, np.uint8)
    low = (mask & -mask).bit_length() - 1
    most = mask >> low
    return (((pixels & mask) >> low) * 255 + most // 2) // most


def _decode_bmp(data: bytes) -> np.ndarray:
    start, size = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<I", data, 14)[0]
    if size == 12:
        (w, h, _, bits), packing = struct.unpack_from("<HHHH", data, 18), 0
    else:
        w, h, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
    down, h = h < 0, abs(h)
    if packing not in (0, 3) or bits not in (1, 4, 8, 16, 24, 32) or packing == 3 and bits not in (16, 32) or size != 12 and size < 40:
        raise ValueError("unsupported BMP")
    stride = -(-w * bits // 32) * 4
    if w <= 0 or h <= 0 or start + h * stride > len(data):
        raise ValueError("too few samples")
    rows = np.frombuffer(data, np.uint8, h * stride, start).reshape(h, stride)
    if bits <= 8:
        entry = 3 if size == 12 else 4
        colours = max(0, min(1 << bits, (start - 14 - size) // entry))
        palette = np.frombuffer(data, np.uint8, colours * entry, 14 + size).reshape(-1, entry)[:, 2::-1]
        index = np.unpackbits(rows, axis=1).reshape(h, -1, bits) if bits < 8 else None
        index = rows[:, :w] if bits == 8 else (index @ (1 << np.arange(bits)[::-1]))[:, :w]
        if index.max() >= colours:
            raise ValueError("a colour that the palette lacks")
        image = palette[index]
    elif packing == 3 or bits == 16:
        masks = struct.unpack_from("<III", data, 54) if packing == 3 else (0x7C00, 0x3E0, 0x1F)
        pixels = rows.view("<u2" if bits == 16 else "<u4")[:, :w].astype(np.int64)
        image = np.stack([_masked(pixels, m) for m in masks], -1).astype(np.uint8)
    else:
        image = rows[:, : w * bits // 8].reshape(h, w, bits // 8)[:, :, 2::-1]
    return image if down else image[::-1]


def decode(data: bytes) -> np.ndarray:
    """An (h, w) or (h, w, 3) array of bytes."""
    if data[:1] == b"P" and data[1:2] in b"123456":
        return _decode_netpbm(data)
    if data[:2] == b"BM":
        return _decode_bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def area_resize(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Means over the areas of an h x w grid laid over a 2-D image."""
    total = np.zeros((image.shape[0] + 1, image.shape[1] + 1))
    np.cumsum(image, 0, out=total[1:, 1:], dtype=float)
    np.cumsum(total[1:, 1:], 1, out=total[1:, 1:])

    def at(lines: np.ndarray, n: int) -> np.ndarray:
        where = np.arange(n + 1) * ((len(lines) - 1) / n)
        low = np.minimum(where.astype(int), len(lines) - 2)
        part = (where - low)[:, None]
        return lines[low] * (1 - part) + lines[low + 1] * part

    grid = at(at(total, h).T, w).T
    return np.diff(np.diff(grid, axis=0), axis=1) * (h * w / (image.shape[0] * image.shape[1]))


def dhash(image: np.ndarray) -> str:
    gray = image.sum(2, dtype=np.int64) if image.ndim == 3 else image
    small = area_resize(gray, 8, 9).round(6)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def to_npy(image: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(image), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def from_npy(data: bytes) -> np.ndarray:
    return np.lib.format.read_array(io.BytesIO(data), allow_pickle=False)


def cut(image: np.ndarray, tile: int = TILE) -> list[dict]:
    return [
        {"row": r, "col": c, "npy": to_npy(part), "dhash": dhash(part)}
        for r in range(0, image.shape[0], tile)
        for c in range(0, image.shape[1], tile)
        for part in (image[r : r + tile, c : c + tile],)
    ]


def join_tiles(tiles: list[dict]) -> np.ndarray:
    """The image of which these are all tiles."""
    bands: dict[int, list[np.ndarray]] = {}
    for t in sorted(tiles, key=lambda t: (t["row"], t["col"])):
        bands.setdefault(t["row"], []).append(from_npy(t["npy"]))
    return np.concatenate([np.concatenate(b, 1) for b in bands.values()])


def _mapped(df: DataFrame, source: str, added: list[tuple[str, str, pa.DataType]], rows) -> DataFrame:
    """df without `source`, with the columns that rows(values) gives (they replace others of their names), a batch at a time."""
    ready_python(df.sparkSession)
    made_names = {n.lower() for n, _, _ in added}
    kept = [c for c in df.columns if c != source and c.lower() not in made_names]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, T._parse_datatype_string(t)) for n, t, _ in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # a few rows at a time: an image and its tiles take a few times the bytes of its row
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                made = rows(part.column(part.schema.get_field_index(source)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in kept] + [pa.array(v, t) for v, (_, _, t) in zip(made, added, strict=True)],
                    [*kept, *(n for n, _, _ in added)],
                )

    return df.mapInArrow(run, schema)


def resized(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """The image as bytes, its area means rounded."""
    planes = [area_resize(p, h, w) for p in (np.moveaxis(image, 2, 0) if image.ndim == 3 else [image])]
    out = np.clip(np.rint(np.stack(planes, -1)), 0, 255).astype(np.uint8)
    return out if image.ndim == 3 else out[:, :, 0]


def media_tiles(df: DataFrame, *, media_col: str = "media", to: str = "tiles", tile: int = TILE, size: tuple[int, int] | None = None) -> DataFrame:
    """df with the media column replaced by its tiles; with size, of the image resized to that height and width."""

    def rows(media) -> list[list]:
        out = []
        for m in media:
            try:
                image = decode(m.as_py()) if m.is_valid else None
                out.append(None if image is None else cut(resized(image, *size) if size else image, tile))
            except (ValueError, OverflowError, struct.error):
                out.append(None)
        return [out]

    return _mapped(df, media_col, [(to, TILES, _TILES)], rows)


def text_payload(text: str | None) -> bytes:
    """UTF-8, filled up with spaces to a positive multiple of 192 bytes."""
    data = (text or "").encode()
    return data.ljust(max(1, -(-len(data) // (3 * WIDTH))) * 3 * WIDTH)


def text_media(df: DataFrame, *, text_col: str = "text", to: str = "media") -> DataFrame:
    """df with the text column replaced by a P6 image of its payload, and n_bytes, the text's own length."""

    def rows(texts) -> list[list]:
        media, size = [], []
        for t in texts:
            data = t.as_py()
            payload = text_payload(data)
            size.append(len((data or "").encode()))
            media.append(encode_ppm(np.frombuffer(payload, np.uint8).reshape(-1, WIDTH, 3)))
        return [media, size]

    return _mapped(df, text_col, [(to, "binary", pa.binary()), ("n_bytes", "long", pa.int64())], rows)


def tile_features(df: DataFrame, *, tiles_col: str = "tiles") -> DataFrame:
    """df with the tiles replaced by what is read back from them: payload, media_bytes, media_sha256, feature (the whole image's
    difference hash and size), tile_hashes."""

    def rows(tiles) -> list[list]:
        out: list[list] = [[], [], [], [], []]
        for x in tiles:
            got = x.as_py()
            if got is None:
                for o in out:
                    o.append(None)
                continue
            image = join_tiles(got)
            whole = b"".join(t["npy"] for t in got)
            shown = f"{dhash(image)}:{image.shape[1]}x{image.shape[0]}"
            for o, v in zip(out, (image.tobytes(), len(whole), hashlib.sha256(whole).hexdigest(), shown, [t["dhash"] for t in got]), strict=True):
                o.append(v)
        return out

    added = [("payload", "binary", pa.binary()), ("media_bytes", "long", pa.int64()), ("media_sha256", "string", pa.string()), ("feature", "string", pa.string()), ("tile_hashes", "array<string>", pa.list_(pa.string()))]
    return _mapped(df, tiles_col, added, rows)


def op2_media_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = text_media(table(spark, sf_dir, "documents").select("doc_id", "text"))
    stored = staged(media_tiles(media), "media-tiles")
    back = tile_features(stored)
    tail = F.crc32(F.substring("payload", -16, 16))
    return back.select("doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), tail.alias("tail_crc32"), "media_bytes", "media_sha256", "feature")
