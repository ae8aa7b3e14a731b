import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from hexfold.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, window):
    known = Tokenizer.from_file(PATH)
    ids = {i: np.array([*known.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in texts}
    places, got = [], dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == got[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length])
        got[r.doc_id] += r.length
        places.append((r.sequence_id * window + r.offset, r.length))
    assert got == {i: len(x) for i, x in ids.items()}
    at = 0
    for place, length in sorted(places):
        assert place == at and place // window == (place + length - 1) // window
        at += length


def test_pieces(docs_of):
    odd = "Don't STOP 12²½ <|endoftext|> a<|startoftext|>b naïve été ΣΑΣ Σ x y a\x1cb 中文 \U0001f600!! \x00\x7f 'sm we're İI"
    texts = [odd, "", None, "word " * 5000, odd, "a" * 3000, "\n\t "]
    rows = packing.packed(docs_of(texts).repartition(3), PATH).collect()
    check(rows, list(enumerate(texts)), 2048)


def test_small_windows_and_no_rows(docs_of):
    texts = ["one two three four", "five", "six seven"]
    check(packing.packed(docs_of(texts), PATH, window=4).collect(), list(enumerate(texts)), 4)
    assert packing.packed(docs_of([]), PATH).count() == 0


def test_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(packing.packed(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()], 2048)
