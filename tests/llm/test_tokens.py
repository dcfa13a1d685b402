"""Token counts against the library on whole texts."""

import random

import pytest

from starloom.llm import tokens

PARTS = ["a", "b", "'s", " ", "  ", "\n", "\t", " \n ", "é", "日本", "1", "22", "<|endoftext|>", "!", "--"]
PARTS += ["\x1c", " ", "　", "word", " the", "don't"]


@pytest.fixture(scope="module")
def library():
    return tokens.load("byte_bpe_50k.json")


def whole(library, text):
    return len(library.encode(text, add_special_tokens=False))


@pytest.mark.parametrize("chunk, overlap", [(20, 4), (50, 10), (7, 1), (400, 3)])
def test_splicing(library, chunk, overlap):
    r = random.Random(chunk)
    for _ in range(150):
        text = "".join(r.choices(PARTS, k=r.randint(1, 400)))
        assert tokens.count_long(library, text, chunk, overlap) == whole(library, text)


def test_texts_without_a_boundary(library):
    for text in ("a" * 500, "日" * 300, " " * 400, "a" * 90 + " " * 200 + "b" * 90):
        assert tokens.count_long(library, text, 50, 5) == whole(library, text)


def test_pieces(library):
    r = random.Random(3)
    texts = ["".join(r.choices(PARTS, k=r.randint(0, 200))) for _ in range(300)]
    assert tokens.PieceCounter(library).count(texts) == [whole(library, t) for t in texts]


def test_both_ways_count_the_same_texts_alike(library):
    r = random.Random(8)
    texts = ["".join(r.choices(PARTS, k=r.randint(0, 500))) for _ in range(200)] + [" " * 90, "x" * 300, "\n \n" * 50]
    pieces = tokens.PieceCounter(library).count(texts)
    assert pieces == [tokens.count_long(library, t, 60, 8) for t in texts] == [whole(library, t) for t in texts]


def test_documents(documents, library, odd_rows):
    found = tokens.token_counts(documents(odd_rows), chunk=500, overlap=20).collect()
    expected = [(d, len((t or "").encode()), whole(library, t or "")) for d, t in odd_rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_empty(documents):
    assert tokens.token_counts(documents([])).collect() == []
