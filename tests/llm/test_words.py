import random
import re

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm import words as W

PATTERNS = [(W.LETTERS_AND_DIGITS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (W.NOT_SPACE, r"[^\x20\x09-\x0D]+")]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("piece", [3, 17, 1 << 17])
def test_words_and_shingles(monkeypatch, piece):
    monkeypatch.setattr(W, "PIECE", piece)
    rng, seen = random.Random(piece), {}
    for _ in range(60):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("aBé\n 1-.x ") for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(0, 9))]
        data, offsets = W.buffer_of(pa.array(texts, pa.string()))
        for member, pattern in PATTERNS:
            found = W.words_of(data, offsets, member)
            want = [re.findall(pattern, lower(t)) for t in texts]
            flat = [w for row in want for w in row]
            assert [lower(bytes(data[a:b]).decode()) for a, b in zip(found.start, found.end, strict=True)] == flat
            assert np.diff(found.splits).tolist() == [len(r) for r in want]
            for word, value in zip(flat, found.hash, strict=True):
                assert seen.setdefault(word, value) == value
            hashes, splits = W.shingles_of(found, 5)
            assert np.diff(splits).tolist() == [len(r) - 4 if len(r) >= 5 else min(1, len(r)) for r in want]
            names = [tuple(r[k : k + 5]) for r in want for k in range(max(1, len(r) - 4)) if r]
            for name, value in zip(names, hashes, strict=True):
                assert seen.setdefault(name, value) == value
    assert len(set(seen.values())) == len(seen)


def test_word_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(W, "PIECE", 8)
    data, offsets = W.buffer_of(pa.array(["x" * 20_000 + " y", "z"]))
    found = W.words_of(data, offsets, W.NOT_SPACE)
    assert (found.end - found.start).tolist() == [20_000, 1, 1]


def test_slices_of_a_column():
    column = pa.array(["a b", "c", None, "d e f"]).slice(1)
    assert np.diff(W.words_of(*W.buffer_of(column), W.NOT_SPACE).splits).tolist() == [1, 0, 3]


def test_row_blocks():
    assert list(W.row_blocks(np.array([0, 5, 100, 101, 102]), 10)) == [(0, 1), (1, 2), (2, 4)]
    assert list(W.row_blocks(np.array([0]), 10)) == []
