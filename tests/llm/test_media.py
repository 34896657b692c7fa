import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexatlas.llm import media
from lexatlas.llm.queries import queries


def test_whole_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    seen: dict = {}
    for r in queries()["op2_media_tiles"](spark, sf_dir).collect():
        data = texts[r["doc_id"]].encode()
        payload = data + b" " * (-len(data) % 192 or (0 if data else 192))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert r["media_bytes"] > len(payload) and seen.setdefault(data, (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])


@pytest.mark.parametrize("shape", [(1, 1, 3), (37, 53, 3), (64, 64, 3), (130, 65, 3)])
def test_round_trips(shape):
    image = np.random.default_rng(0).integers(0, 256, shape).astype(np.uint8)
    for data in (media.encode_ppm(image), media.encode_bmp(image)):
        assert (media.decode(data) == image).all()
    assert (media.decode(media.encode_ppm(image[:, :, 0])) == image[:, :, 0]).all()
    assert (media.join_tiles(media.cut(image, 16)) == image).all()


def test_formats():
    assert media.decode(b"P1\n# c\n3 2\n1 0 1\n010\n").tolist() == [[0, 255, 0], [255, 0, 255]]
    assert media.decode(b"P2 2 1 15 0 15").tolist() == [[0, 255]]
    assert media.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode(b"P4 9 1\n\x80\x80").tolist() == [[0] + [255] * 7 + [0]]
    assert media.decode(b"P5 1 2 65535\n\xff\xff\x00\x00").tolist() == [[255], [0]]
    head = lambda bits, colours, h: b"BM" + (0).to_bytes(8, "little") + (54 + 4 * colours).to_bytes(4, "little") + (40).to_bytes(4, "little") + (3).to_bytes(4, "little") + h.to_bytes(4, "little", signed=True) + (1).to_bytes(2, "little") + bits.to_bytes(2, "little") + (0).to_bytes(24, "little")
    assert media.decode(head(1, 2, 1) + bytes([0, 0, 0, 0, 3, 2, 1, 0]) + b"\xa0\0\0\0").tolist() == [[[1, 2, 3], [0, 0, 0], [1, 2, 3]]]
    assert media.decode(head(8, 2, -1) + bytes([0, 0, 0, 0, 3, 2, 1, 0]) + b"\x01\x00\x01\0").tolist() == [[[1, 2, 3], [0, 0, 0], [1, 2, 3]]]
    assert media.decode(head(32, 0, 1) + bytes([3, 2, 1, 0] * 3)).tolist() == [[[1, 2, 3]] * 3]


def bmp(bits, w, h, body, *, start=54, packing=0, extra=b"", size=40):
    head = (40).to_bytes(4, "little") + w.to_bytes(4, "little", signed=True) + h.to_bytes(4, "little", signed=True) + (1).to_bytes(2, "little") + bits.to_bytes(2, "little") + packing.to_bytes(4, "little") + bytes(20)
    if size == 12:
        head = (12).to_bytes(4, "little") + w.to_bytes(2, "little") + h.to_bytes(2, "little") + (1).to_bytes(2, "little") + bits.to_bytes(2, "little")
    return b"BM" + bytes(8) + start.to_bytes(4, "little") + head + extra + body


def test_masks_and_old_headers():
    assert media.decode(bmp(32, 1, 1, b"\x01\x02\x03\0", start=66, packing=3, extra=b"\xff\0\0\0\0\xff\0\0\0\0\xff\0")).tolist() == [[[1, 2, 3]]]
    assert media.decode(bmp(16, 2, 1, b"\x00\x7c\x1f\x00")).tolist() == [[[255, 0, 0], [0, 0, 255]]]
    assert media.decode(bmp(16, 2, 1, b"\x00\xf8\xe0\x07", start=66, packing=3, extra=b"\0\xf8\0\0\xe0\x07\0\0\x1f\0\0\0")).tolist() == [[[255, 0, 0], [0, 255, 0]]]
    assert media.decode(bmp(1, 3, 1, b"\xa0\0\0\0", start=32, extra=bytes([0, 0, 0, 3, 2, 1]), size=12)).tolist() == [[[1, 2, 3], [0, 0, 0], [1, 2, 3]]]


BROKEN = [
    b"P3 1 1 255 99999999999999999999999 1 1",
    b"", b"P", b"P5", b"P5 0 0 255\n", b"P5 0 9 255\n", b"P6 999999999 999999999 255\nxyz", b"P6 99999999999999999999 1 255\nxyz", b"P5 1 1 0\nx", b"P5 1 1 70000\nxx", b"P2 1 1 3 9", b"P2 1 1 9 -1", b"P1 1 1 7", b"P2 2 1 9 x y",
    b"P4 64 64\n\x01", b"P3 1 1 255 1 2", b"BM", b"BM" + bytes(60), bmp(8, 1, 1, b"\x05\0\0\0", start=58, extra=bytes(4)), bmp(24, 1 << 30, 1 << 30, b"x"), bmp(24, -5, 1, bytes(40)), bmp(24, 1, 0, bytes(4)), bmp(8, 1, 1, b"\0" * 4, packing=1),
    bmp(5, 1, 1, bytes(8)), bmp(24, 1, 1, b"", start=1 << 31), bmp(1, 9, 1, bytes(4), start=20), b"GIF89a",
]


def test_broken_media_is_null(spark):
    for data in BROKEN:
        with pytest.raises((ValueError, OverflowError, media.struct.error)):
            media.decode(data)
    rng = np.random.default_rng(5)
    good = [media.encode_ppm(np.zeros((3, 4, 3), np.uint8)), media.encode_bmp(np.zeros((3, 4, 3), np.uint8)), bmp(8, 1, 1, b"\0" * 4, start=58, extra=bytes(4))]
    odd = []
    for k in range(1500):
        data = bytearray(good[k % 3])
        for _ in range(rng.integers(1, 4)):
            data[rng.integers(len(data))] = rng.integers(256)
        odd.append(data[: rng.integers(len(data) + 1)] if k % 5 == 0 else data)
    df = spark.createDataFrame([(bytearray(x),) for x in BROKEN] + [(x,) for x in odd], "media binary")
    got = media.tile_features(media.media_tiles(df)).collect()
    assert len(got) == len(BROKEN) + len(odd) and sum(r["payload"] is None for r in got) >= len(BROKEN) and any(r["payload"] is not None for r in got)


def test_features_equal_a_plain_version(spark):
    """The difference hash of a text's image by means over areas, pixel after pixel."""
    texts = ["", "abc", "The quick brown fox. " * 40, "é漢" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [r["feature"] for r in media.tile_features(media.media_tiles(media.text_media(df))).collect()]

    def plain(text):
        data = text.encode()
        data += b" " * (-len(data) % 192 or (0 if data else 192))
        rows = [[sum(data[(y * 64 + x) * 3 + c] for c in range(3)) for x in range(64)] for y in range(len(data) // 192)]
        h, w = len(rows), 64

        def mean(i, j):  # the mean over a cell of an 8 x 9 grid, border pixels by their part
            y0, y1, x0, x1 = i * h / 8, (i + 1) * h / 8, j * w / 9, (j + 1) * w / 9
            part = lambda k, a, b: max(0.0, min(k + 1, b) - max(k, a))
            return sum(rows[y][x] * part(y, y0, y1) * part(x, x0, x1) for y in range(h) for x in range(w)) / ((y1 - y0) * (x1 - x0))

        bits = "".join("1" if round(mean(i, j + 1) - mean(i, j), 4) > 0 else "0" for i in range(8) for j in range(8))
        return f"{int(bits, 2):016x}:{w}x{h}"

    assert got == [plain(t) for t in texts]


def test_area_means_and_hashes():
    image = np.random.default_rng(2).integers(0, 256, (36, 50)).astype(float)
    assert np.allclose(media.area_resize(image, 12, 10), image.reshape(12, 3, 10, 5).mean((1, 3)))
    up = media.area_resize(image, 72, 100)
    assert np.allclose(up.reshape(36, 2, 50, 2).mean((1, 3)), image) and np.isclose(media.area_resize(image, 7, 9).mean(), image.mean())
    ramp = np.tile(np.arange(90), (40, 1)).astype(np.uint8)
    assert media.dhash(ramp) == "f" * 16 and media.dhash(ramp[:, ::-1]) == "0" * 16


def test_columns(spark):
    image = np.zeros((5, 7, 3), np.uint8)
    df = spark.createDataFrame([(1, bytearray(media.encode_bmp(image)), "k"), (2, None, "k"), (3, bytearray(b"GIF"), "k"), (4, bytearray(b"P5 9 9 255\nx"), "k")], "i int, media binary, tiles string")
    got = {r["i"]: r["tiles"] for r in media.media_tiles(df).collect()}
    assert [len(got[1]), got[2], got[3], got[4]] == [1, None, None, None]
    small = media.media_tiles(df, size=(2, 3)).where("i = 1").first()["tiles"]
    assert media.from_npy(bytes(small[0]["npy"])).shape == (2, 3, 3)
    assert media.tile_features(media.media_tiles(df)).where(F.col("i") == 2).first()["feature"] is None
    assert media.media_tiles(df.where("false")).count() == 0
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "é" * 100_000)], "i int, text string")
    back = {r["i"]: (r["n_bytes"], len(r["payload"])) for r in media.tile_features(media.media_tiles(media.text_media(texts))).collect()}
    assert back == {1: (0, 192), 2: (0, 192), 3: (200_000, 200_064)}
