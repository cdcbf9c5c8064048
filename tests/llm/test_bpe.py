import random

import numpy as np
import pytest
from llm_brute import sha
from tokenizers import Tokenizer

from orderflow.llm import bpe


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.ForcedBoundaryBPE(bpe.default_vocabulary())


PIECES = [" ", "  ", "\n", "\t", "'", "s", "'ll", "é", "ß", "中文", "🙂", "1", "234", ".", "!!", "a", "Zed", "the", " of", "\u00a0",
          "\u2009", "\x1f", "\x85", "<|endoftext|>", "<|endof", "%%%", "ا", "\u0301", "\r\n", "aaaa", "password=9f8e"]


def test_random_texts_encode_and_decode_as_the_library_does(library, own):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for text, packed in zip(texts, own.encode_batch(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(text)
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_every_code_point(library, own):
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x3000, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 500):
        text = "".join(f"a{c} {c}1 {c}" for c in points[i:i + 500])
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_very_long_runs(library, own):
    for text in (" " * 20_000 + "x", "a" * 30_000, "é" * 5000 + "\n" * 999, "thethethe" * 4000):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_certain(own):
    tokens = list(own.bytes_of.values())[:50_256]
    inside = {t[i:i + 2] for t in tokens for i in range(len(t) - 1)}
    raw = "l'été: naïve zebra\u2028x%qz§".encode()
    cuts = own.cuts(np.frombuffer(raw, np.uint8))
    assert cuts == [i for i in range(1, len(raw)) if raw[i - 1:i + 1] not in inside]
    assert cuts


def test_ids_that_are_not_utf8_decode_to_the_replacement_character(library, own):
    ids = own.encode("é")[:4]
    half = np.frombuffer(own.encode("🙂"), "<u4")[:1]
    assert own.decode(half.tobytes()) == library.decode(half.tolist(), skip_special_tokens=False)
    assert own.decode(ids) == "é"


def test_query_columns_nulls_repeated_rows_and_empty_tables(llm_spark, library):
    text = "One two <|endoftext|> three.\n"
    docs = llm_spark.createDataFrame([(1, text, 5), (1, text, 5), (2, None, 6), (None, "", 7)], "doc_id long, text string, n_tokens int")
    rows = sorted(map(tuple, bpe.round_trip(docs).collect()), key=str)
    ids = library.encode(text, add_special_tokens=False).ids
    one = (1, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text))
    assert rows == sorted([one, one, (2, 0, sha(b""), sha(b"")), (None, 0, sha(b""), sha(b""))], key=str)
    encoded = bpe.encode_documents(docs)
    assert {tuple(r["ids"]) for r in encoded.collect()} == {tuple(ids), ()}
    assert sorted(r["text"] for r in bpe.decode_documents(encoded).collect()) == ["", "", text, text]
    none = docs.limit(0)
    assert bpe.round_trip(none).count() == bpe.decode_documents(bpe.encode_documents(none)).count() == 0
