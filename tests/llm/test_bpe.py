import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from linkrank.llm import bpe
from llm.conftest import EDGE

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = (0xE9, 0xDF, 0x3A3, 0x130, 0x2019, 0x663, 0xBD, 0x3000, 0xA0, 0x1C, 0x1F, 0x85, 0x301, 0x300, 0xD55C, 0x65E5, 0x1F642, 0xFB01, 0x2028, 0x200B, 0x0, 0x1E9E)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, "rb") as file:
        return bpe.Encoder(file.read())


def texts():
    rng = random.Random(7)
    pool = [*"abcXYZ éÉ's 12#$%\n\t<>|", "'ve", "'t", "the", "<|endoftext|>", "<|startoftext|>", "<|", *map(chr, ODD)]
    out = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(4000)]
    return [*out, "", "a" * 300, "abcde" * 200, "".join(rng.choice("etaoin") for _ in range(2000)), "!" * 500, "x<|endoftext|>y"]


def test_ids_and_tokens_are_the_library_s(encoder, library):
    sample = texts()
    mine = [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(sample)]
    theirs = library.encode_batch(sample, add_special_tokens=False)
    assert mine == [x.ids for x in theirs]
    with open(VOCABULARY, "rb") as file:
        tokens = pa.array(bpe.tokens_of(file.read()))
    back = bpe.decoded(pa.array([*mine, None], pa.list_(pa.int32())), tokens).to_pylist()
    assert back == [*(library.decode(x, skip_special_tokens=False) for x in mine), ""]


def test_cuts_are_forced(encoder, library):
    """No token holds a pair that is cut, so no merge is lost; some words are cut indeed."""
    letters = bpe.byte_letters()
    of = {c: b for b, c in enumerate(letters)}
    for token in library.get_vocab():
        if token not in encoder.special:
            body = [of[c] for c in token.removesuffix("</w>")]
            assert all(encoder.joined[a, b] for a, b in zip(body, body[1:], strict=False))
    assert not encoder.joined.all() and letters == [letters[b] for b in range(256)] and len(set(letters)) == 256


def test_forgetting_changes_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    monkeypatch.setattr(bpe, "TEXTS", 3)
    sample = texts()[:200]
    assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(sample)] == [x.ids for x in library.encode_batch(sample, add_special_tokens=False)]


def test_documents(documents, library):
    rows = EDGE + [(50 + i, t, "en", "a") for i, t in enumerate(texts()[:50])]
    found = bpe.decode(bpe.encode(documents(rows), VOCABULARY), VOCABULARY).collect()
    expected = []
    for i, t, _, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append(repr((i, ids, library.decode(ids, skip_special_tokens=False))))
    assert sorted(repr((r.doc_id, list(r.ids), r.decoded)) for r in found) == sorted(expected)
    both = bpe.round_trip(documents(rows), VOCABULARY).collect()
    assert sorted(repr((r.doc_id, list(r.ids), r.decoded)) for r in both) == sorted(expected)
    assert bpe.decode(bpe.encode(documents([]), VOCABULARY), VOCABULARY).count() == 0
