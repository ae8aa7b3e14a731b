"""TIFF media columns: write texts as images, walk image directories, one row per page.

``encode`` and ``decode`` handle both byte orders on reading, 8-bit chunky
samples, strips and tiles, no compression, PackBits, LZW and deflate, and the
horizontal predictor.  ``media_pages`` maps them over a binary column: every
image directory gives one row, a null image gives none, and an image that
cannot be read gives one row with ``page`` -1 and the reason in ``error``.
Other columns are dropped but those named in ``keep`` (one with a made
column's name becomes ``<name>_in``); a null key stays null, equal rows give
equal rows, no rows none.  A page is allocated only where its stored bytes can
fill it, so a false size is an error in its row and no failure of the job.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import held

# fixed values of the TIFF 6.0 format
NONE, LZW, ADOBE_DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES = 322, 323, 324, 325
UNITS = {1: "B", 3: "H", 4: "I", 16: "Q"}

#: bytes that one stored byte can stand for at most
MOST = {NONE: 1, PACKBITS: 64, LZW: 4096, ADOBE_DEFLATE: 1040, OLD_DEFLATE: 1040}
ROW = 192  #: bytes of a row: 64 pixels of three samples
STRIP_ROWS = 128


def packbits(data: bytes) -> bytes:
    """Runs of three and more as repeats, all else as literals."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(raw)) + 1, [len(raw)])) if len(raw) else np.zeros(1, int)
    out, literal = bytearray(), bytearray()

    def flush() -> None:
        for i in range(0, len(literal), 128):
            out.append(len(literal[i : i + 128]) - 1)
            out.extend(literal[i : i + 128])
        literal.clear()

    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a < 3:
            literal += data[a:b]
            continue
        flush()
        for i in range(a, b, 128):
            n = min(128, b - i)
            out += bytes([257 - n, data[a]]) if n > 1 else bytes([0, data[a]])
    flush()
    return bytes(out)


def unpackbits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def lzw(data: bytes) -> bytes:
    """Most significant bit first, codes of 9 to 12 bits, early change."""
    bits, held, out = 0, 0, bytearray()

    def put(code: int, width: int) -> None:
        nonlocal bits, held
        bits, held = bits << width | code, held + width
        while held >= 8:
            held -= 8
            out.append(bits >> held & 255)
        bits &= (1 << held) - 1

    table = {bytes([i]): i for i in range(256)}
    width, known = 9, 258
    put(256, width)
    word = b""
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in table:
            word = longer
            continue
        put(table[word], width)
        table[longer] = known
        known += 1
        if known == 4094:
            put(256, width)
            table, width, known = {bytes([i]): i for i in range(256)}, 9, 258
        elif known + 1 > 1 << width:
            width += 1
        word = data[i : i + 1]
    if word:
        put(table[word], width)
        if known + 2 > 1 << width and width < 12:
            width += 1
    put(257, width)
    if held:
        out.append(bits << 8 - held & 255)
    return bytes(out)


def unlzw(data: bytes) -> bytes:
    out, table, width, last = bytearray(), [], 9, b""
    bits, held = 0, 0
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table = list(first)
    for byte in data:
        bits, held = bits << 8 | byte, held + 8
        if held < width:
            continue
        held -= width
        code = bits >> held
        bits &= (1 << held) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = list(first), 9, b""
            continue
        if not last:
            entry = table[code]
        else:
            if code > len(table):
                raise ValueError("LZW code out of range")
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
        out += entry
        last = entry
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    return bytes(out)


def _pack(data: bytes, compression: int) -> bytes:
    if compression in (ADOBE_DEFLATE, OLD_DEFLATE):
        return zlib.compress(data, 1)
    return {NONE: bytes, PACKBITS: packbits, LZW: lzw}[compression](data)


def _unpack(data: bytes, compression: int, size: int) -> bytes:
    if compression in (ADOBE_DEFLATE, OLD_DEFLATE):
        out = zlib.decompressobj().decompress(data, size)  # no more than is wanted
    elif compression in (NONE, PACKBITS, LZW):
        out = {NONE: bytes, PACKBITS: unpackbits, LZW: unlzw}[compression](data)
    else:
        raise ValueError(f"compression {compression}")
    if len(out) < size:
        raise ValueError("short strip or tile")
    return out[:size]


def encode(pages: list[np.ndarray], compression: int = ADOBE_DEFLATE, predictor: int = 2, strip_rows: int = STRIP_ROWS, tile: tuple[int, int] | None = None) -> bytes:
    """Little-endian TIFF of ``height x width x samples`` byte arrays, one image directory each."""
    out = bytearray(struct.pack("<2sHI", b"II", 42, 0))
    link = 4
    for page in pages:
        height, width, samples = page.shape
        blocks = []
        if tile:
            tall, wide = tile
            padded = np.zeros((-(-height // tall) * tall, -(-width // wide) * wide, samples), np.uint8)
            padded[:height, :width] = page
            blocks = [padded[y : y + tall, x : x + wide] for y in range(0, len(padded), tall) for x in range(0, padded.shape[1], wide)]
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, height, strip_rows)]
        places, sizes = [], []
        for block in blocks:
            if predictor == 2:
                block = np.concatenate((block[:, :1], np.diff(block, axis=1)), axis=1)
            data = _pack(np.ascontiguousarray(block).tobytes(), compression)
            places.append(len(out))
            sizes.append(len(data))
            out += data + b"\0" * (len(data) % 2)
        fields = {WIDTH: (4, [width]), HEIGHT: (4, [height]), BITS: (3, [8] * samples), COMPRESSION: (3, [compression]), PHOTOMETRIC: (3, [2 if samples == 3 else 1]), SAMPLES: (3, [samples]), PLANAR: (3, [1]), PREDICTOR: (3, [predictor])}
        if tile:
            fields |= {TILE_WIDTH: (4, [tile[1]]), TILE_HEIGHT: (4, [tile[0]]), TILE_OFFSETS: (4, places), TILE_BYTES: (4, sizes)}
        else:
            fields |= {STRIP_OFFSETS: (4, places), ROWS_PER_STRIP: (4, [strip_rows]), STRIP_BYTES: (4, sizes)}
        entries = b""
        for tag in sorted(fields):
            kind, values = fields[tag]
            value = struct.pack(f"<{len(values)}{UNITS[kind]}", *values)
            if len(value) > 4:
                place = len(out)
                out += value + b"\0" * (len(value) % 2)
                value = struct.pack("<I", place)
            entries += struct.pack("<HHI", tag, kind, len(values)) + value.ljust(4, b"\0")
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes):
    """Yield the fields of each image directory: tag to list of values."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if not order or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        if at in seen:
            raise ValueError("image directories form a loop")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        fields = {}
        for place in range(at + 2, at + 2 + 12 * n, 12):
            tag, kind, count = struct.unpack_from(order + "HHI", data, place)
            if kind in UNITS:
                form = f"{order}{count}{UNITS[kind]}"
                where = place + 8 if struct.calcsize(form) <= 4 else struct.unpack_from(order + "I", data, place + 8)[0]
                fields[tag] = list(struct.unpack_from(form, data, where))
        yield fields
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def decode(data: bytes):
    """Yield ``(fields, height x width x samples array)`` of each page."""
    for fields in directories(data):
        width, height = fields[WIDTH][0], fields[HEIGHT][0]
        samples = fields.get(SAMPLES, [1])[0]
        compression, predictor = fields.get(COMPRESSION, [NONE])[0], fields.get(PREDICTOR, [1])[0]
        if set(fields.get(BITS, [1])) != {8} or fields.get(PLANAR, [1])[0] != 1 or predictor not in (1, 2):
            raise ValueError("only chunky 8-bit samples with predictor 1 or 2 are read")
        if min(width, height, samples) < 1:
            raise ValueError("a page without samples")
        tiled = TILE_OFFSETS in fields
        tall = fields[TILE_HEIGHT][0] if tiled else min(height, fields.get(ROWS_PER_STRIP, [height])[0])
        wide = fields[TILE_WIDTH][0] if tiled else width
        if min(tall, wide) < 1:
            raise ValueError("strips or tiles without samples")
        across = -(-width // wide)
        places, sizes = (fields[TILE_OFFSETS], fields[TILE_BYTES]) if tiled else (fields[STRIP_OFFSETS], fields[STRIP_BYTES])
        if len(places) != across * -(-height // tall):
            raise ValueError("strips or tiles that do not cover the page")
        shape = (-(-height // tall) * tall if tiled else height, across * wide, samples)
        if sum(sizes) > len(data) or math.prod(shape) > MOST.get(compression, 0) * sum(sizes):
            raise ValueError("a page larger than its bytes can hold")
        page = np.empty(shape, np.uint8)
        for i, (place, size) in enumerate(zip(places, sizes, strict=True)):
            y, x = i // across * tall, i % across * wide
            rows = tall if tiled else min(tall, height - y)
            block = np.frombuffer(_unpack(data[place : place + size], compression, rows * wide * samples), np.uint8).reshape(rows, wide, samples)
            page[y : y + rows, x : x + wide] = np.cumsum(block, axis=1, dtype=np.uint8) if predictor == 2 else block
        yield fields, page[:height, :width]


def features(page: np.ndarray) -> str:
    """Size, mean and deviation of the samples, and an 8x8 average hash of the page."""
    height, width, _ = page.shape
    counts = np.bincount(page.ravel(), minlength=256)
    level = np.arange(256)
    mean = float(counts @ level / page.size)
    deviation = float(np.sqrt(max(0.0, counts @ (level * level) / page.size - mean * mean)))
    grey = page.sum(axis=2, dtype=np.int64)
    rows, columns = np.arange(8) * height // 8, np.arange(8) * width // 8
    cells = np.add.reduceat(np.add.reduceat(grey, rows, axis=0), columns, axis=1) if height >= 8 and width >= 8 else np.resize(grey, (8, 8))
    mark = int("".join("1" if x else "0" for x in (cells > cells.mean()).ravel()), 2)
    return f"{width}x{height};mean={mean:.3f};sd={deviation:.3f};hash={mark:016x}"


def text_media(docs: DataFrame, text: str, keep: list[str], compression: int = ADOBE_DEFLATE, predictor: int = 2) -> DataFrame:
    """Store each text as a TIFF: ``keep`` columns, ``n_bytes`` and ``media``.

    The UTF-8 bytes, with spaces up to a positive multiple of 192, are the
    samples of one RGB page 64 pixels wide.  A null text is stored as an empty one.
    """
    source = docs.select(*held(docs, keep, ["n_bytes", "media"]), F.col(text).alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def store(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column("_text").cast(pa.large_binary()), b"")
            media = []
            for value in texts:
                raw = value.as_buffer().to_pybytes()
                raw += b" " * (-len(raw) % ROW or (ROW if not raw else 0))
                media.append(encode([np.frombuffer(raw, np.uint8).reshape(-1, ROW // 3, 3)], compression, predictor))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pc.binary_length(texts).cast(pa.int64()), pa.array(media, pa.binary())], names=schema.names)

    return source.mapInArrow(store, schema)


def media_pages(df: DataFrame, media: str, keep: list[str]) -> DataFrame:
    """One row per TIFF page: ``keep``, page, width, height, samples, compression, predictor, pixels, feature, error."""
    made = [("page", T.IntegerType()), ("width", T.IntegerType()), ("height", T.IntegerType()), ("samples", T.IntegerType()), ("compression", T.IntegerType()), ("predictor", T.IntegerType()), ("pixels", T.BinaryType()), ("feature", T.StringType()), ("error", T.StringType())]
    source = df.select(*held(df, keep, [n for n, _ in made]), F.col(media).alias("_media"))
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(*x) for x in made]])
    kinds = [pa.int32()] * 6 + [pa.binary(), pa.string(), pa.string()]

    def walk(batches):
        for batch in batches:
            rows, at = [], []
            for i, value in enumerate(batch.column("_media")):
                if not value.is_valid:
                    continue
                first = len(rows)
                try:
                    for k, (fields, page) in enumerate(decode(value.as_py())):
                        rows.append((k, page.shape[1], page.shape[0], page.shape[2], fields.get(COMPRESSION, [NONE])[0], fields.get(PREDICTOR, [1])[0], page.tobytes(), features(page), None))
                except (ValueError, KeyError, IndexError, OverflowError, MemoryError, struct.error, zlib.error) as problem:
                    del rows[first:]
                    rows.append((-1, None, None, None, None, None, None, None, f"{type(problem).__name__}: {problem}"))
                at += [i] * (len(rows) - first)
            own = [batch.column(i).take(pa.array(at, pa.int64())) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]], names=schema.names)

    return source.mapInArrow(walk, schema)


def text_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document, from the pages of its stored form."""
    stored = text_media(docs, "text", ["doc_id"])
    read = media_pages(stored.withColumn("_copy", F.col("media")), "media", ["doc_id", "n_bytes", "_copy"])
    return read.select(
        "doc_id",
        "n_bytes",
        F.length("pixels").cast("long").alias("payload_bytes"),
        F.sha2("pixels", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(pixels, -16, 16)")).alias("tail_crc32"),
        F.length("_copy").cast("long").alias("media_bytes"),
        F.sha2("_copy", 256).alias("media_sha256"),
        "feature",
    )
