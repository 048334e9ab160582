"""Byte-level BPE in chunks against the tokenizer on whole texts."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from martloom.llm import bpe

ODD = ["a", "b", "'", "l", "'ll", "'s", " ", "  ", "\n", " \n ", "é", "日本", "1", "22", "!", "<|endoftext|>", "<|end", "oftext|>"]
ODD += ["foo bar ", ",", "😀", "x" * 50, " ", "́"]


@pytest.fixture(scope="module")
def codes():
    return bpe.codec(bpe.default_tokenizer())


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(bpe.default_tokenizer())

    def run(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False).encode()
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return run


def joined(codes, pieces):
    found = []
    joiner = bpe.Joiner(codes, found.append)
    for record in codes.records([p.encode() for p in pieces]):
        joiner.feed(record)
    joiner.finish()
    return (np.concatenate(found) & bpe._IDS).tolist() if found else []


def test_joins_are_exact_wherever_a_text_is_cut(codes):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 80)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text), rng.randint(0, 5))))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        assert joined(codes, pieces) == codes.tokenizer.encode(text, add_special_tokens=False).ids, pieces


def test_whole_texts_are_exact_in_the_quick_engine_too(codes):
    rng = random.Random(5)
    assert codes.quick is not None
    odd = [*ODD, "\x1c", "\x85", "\xa0", "½", "²", "ª", "\u0149", "y" * 500, " " * 600, "Aǅb"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(chr(rng.randrange(0x250)) for _ in range(40)) for _ in range(3000)]
    found = codes.ids([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert ids.tolist() == codes.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_word_longer_than_any_window(codes):
    text = "x" * 30_000 + " " * 5_000 + "end"
    pieces = [text[a : a + 700] for a in range(0, len(text), 700)]
    assert joined(codes, pieces) == codes.tokenizer.encode(text, add_special_tokens=False).ids


def test_chunks_follow_content():
    rng = random.Random(2)
    prose = lambda n: "".join(rng.choice("abcdeé ß日") for _ in range(n)).encode()
    shared = prose(30_000)
    first, second = prose(999) + shared, prose(12_345) + shared + prose(50)
    one, two = list(bpe.chunks(first)), list(bpe.chunks(second))
    assert b"".join(one) == first and b"".join(two) == second
    assert all(c.decode() and len(c) <= bpe.MOST + 3 for c in one + two)
    assert sum(len(c) for c in set(one) & set(two)) > 0.8 * len(shared)
    assert list(bpe.chunks(b"")) == [] and len(list(bpe.chunks(b"a" * 100_000))) == 13


@pytest.fixture(scope="module")
def rows(odd_rows, copied_rows):
    rng = random.Random(9)
    passage = "".join(rng.choice(ODD) for _ in range(3_000))
    around = lambda n: "".join(rng.choice(ODD) for _ in range(n))
    shared = [(2000 + i, around(rng.randint(0, 900)) + passage + around(rng.randint(0, 900))) for i in range(12)]
    return [*odd_rows, *[(5000 + i, t) for i, t in copied_rows], *shared, (3000, passage), (3001, passage)]


@pytest.mark.parametrize("log2", [bpe.LOG2_MARKS, 15])
def test_encode_equals_the_tokenizer(frame, rows, whole, log2):
    found = sorted((tuple(r) for r in bpe.encode(frame(rows), log2=log2).collect()), key=str)
    assert found == sorted(((i, *whole(t)) for i, t in rows), key=str)


def test_every_chunk_by_the_detour(frame, rows, whole, monkeypatch):
    """All bits set, as on a corpus too large for them: the result stays."""
    monkeypatch.setattr(bpe, "recurring", lambda rows, log2: b"\xff" * (1 << (log2 - 3)))
    found = sorted((tuple(r) for r in bpe.encode(frame(rows), log2=15).collect()), key=str)
    assert found == sorted(((i, *whole(t)) for i, t in rows), key=str)


def test_empty_table(frame):
    assert bpe.encode(frame([])).collect() == []
