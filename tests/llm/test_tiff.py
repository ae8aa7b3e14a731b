import hashlib
import struct
import zlib

import numpy as np
import pytest

from hexfold.llm import tiff


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.LZW, tiff.ADOBE_DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [None, (16, 32)])
def test_round_trip(compression, predictor, tile):
    rng = np.random.default_rng(3)
    pages = [rng.integers(0, 256, (37, 50, 3), dtype=np.uint8), np.zeros((5, 300, 1), np.uint8), np.repeat(rng.integers(0, 9, (200, 64, 3), dtype=np.uint8), 2, axis=1)]
    read = [p for _, p in tiff.decode(tiff.encode(pages, compression, predictor, 8, tile))]
    assert len(read) == 3 and all((a == b).all() for a, b in zip(pages, read, strict=True))


def test_lzw_over_table_resets():
    data = np.random.default_rng(4).integers(0, 256, 60_000, dtype=np.uint8).tobytes()
    assert tiff.unlzw(tiff.lzw(data)) == data
    assert tiff.unlzw(tiff.lzw(b"ab" * 40_000)) == b"ab" * 40_000


def test_known_packbits():
    packed = bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA")
    assert tiff.unpackbits(packed).hex().upper() == "AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA"


def test_big_endian_is_read():
    entries = [(256, 3, 2), (257, 3, 1), (258, 3, 8), (259, 3, 1), (273, 4, 8), (277, 3, 1), (278, 3, 1), (279, 4, 2)]
    data = struct.pack(">2sHI", b"MM", 42, 10) + b"xy" + struct.pack(">H", len(entries))
    for tag, kind, value in entries:
        data += struct.pack(">HHI", tag, kind, 1) + (struct.pack(">HH", value, 0) if kind == 3 else struct.pack(">I", value))
    ((_, page),) = tiff.decode(data + bytes(4))
    assert page.tobytes() == b"xy"


def test_text_digest(docs_of):
    texts = ["", None, "é" * 100, "a" * 192, "x" * 50_000, "é" * 100]
    rows = sorted(tiff.text_digest(docs_of(texts)).collect(), key=lambda r: r.doc_id)
    assert len(rows) == 6
    for r, t in zip(rows, texts, strict=True):
        raw = (t or "").encode()
        padded = raw + b" " * (-len(raw) % 192) or b" " * 192
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
    assert rows[2][1:] == rows[5][1:]


def test_bad_and_null_media(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray(b"no")), (3, bytearray(tiff.encode([np.ones((2, 2, 1), np.uint8)] * 2)))], "page long, _media binary")
    rows = sorted((tuple(r)[0], tuple(r)[1], tuple(r)[-1] is None) for r in tiff.media_pages(df.withColumnRenamed("page", "k"), "_media", ["k"]).collect())
    assert rows == [(2, -1, False), (3, 0, True), (3, 1, True)]


def single(fields, data=b"xy"):
    """A little-endian TIFF of one directory; 273 points at ``data``."""
    out = struct.pack("<2sHI", b"II", 42, 8 + len(data)) + data + struct.pack("<H", len(fields))
    for tag, value in sorted(fields.items()):
        out += struct.pack("<HHII", tag, 4, 1, value)
    return out + bytes(4)


@pytest.mark.parametrize("change", [{256: 0}, {257: 0}, {277: 0}, {256: 200_000, 257: 200_000}, {278: 0}, {279: 1 << 30}, {256: (1 << 32) - 1}, {322: 0, 323: 0, 324: 8, 325: 2}])
@pytest.mark.parametrize("compression", [1, 5, 8, 32773])
def test_false_sizes_are_errors_of_their_row(spark, change, compression):
    fields = {256: 2, 257: 1, 258: 8, 259: compression, 273: 8, 277: 1, 278: 1, 279: 2} | change
    df = spark.createDataFrame([(1, bytearray(single(fields))), (2, bytearray(single({**fields, **{256: 2, 257: 1, 277: 1, 278: 1, 279: 2, 259: 1, 322: 2, 323: 1, 324: 8, 325: 2}})))], "page long, _media binary")
    rows = {r.page_in: (r.page, r.error is None) for r in tiff.media_pages(df, "_media", ["page"]).collect()}
    assert rows == {1: (-1, False), 2: (0, True)}


def test_deflate_stops_at_the_wanted_size():
    bomb = zlib.compress(bytes(50_000_000))
    assert tiff._unpack(bomb, tiff.ADOBE_DEFLATE, 10) == bytes(10)


def test_kept_columns_that_clash(docs_of):
    rows = tiff.text_media(docs_of([(None, "a")]).withColumnRenamed("n_chars", "media"), "text", ["doc_id", "media"]).collect()
    assert [(r.doc_id, r.media_in, r.n_bytes) for r in rows] == [(None, None, 1)]
