"""Substring dedup against a dictionary of all windows."""

import random

import numpy as np
import pytest

from starloom.llm import substring


def brute(rows, size):
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for s in range(len(words) - size + 1):
            if doc is not None:
                key = tuple(words[s : s + size])
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - size + 1):
            if doc is not None and first[tuple(words[s : s + size])] < doc:
                gone.update(range(s, s + size))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((doc, len(words), len(gone), kept))
    return sorted(out, key=repr)


def test_cover_has_every_difference():
    met = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert met == set(range(substring.PERIOD))


@pytest.mark.parametrize("size", [1, 2, 7, 20, 50])
def test_rolling(size):
    values = np.random.default_rng(size).integers(0, 2**64, 120, dtype=np.uint64)
    values[60:] = values[:60]
    found = substring.rolling(values, size, substring._BASES[0])
    assert len(found) == 121 - size
    assert (found[60:] == found[: len(found) - 60]).all()
    assert len(set(found.tolist())) == len({tuple(values[i : i + size].tolist()) for i in range(121 - size)})


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passages = [r.choices(vocabulary, k=n) for n in (49, 50, 51, 80, 200)]
    line = r.choices(vocabulary, k=12)
    rows = []
    for doc in range(120):
        words = []
        for _ in range(r.randint(0, 4)):
            words += r.choices(vocabulary, k=r.randint(0, 70))
            pick = r.random()
            if pick < 0.4:
                part = list(r.choice(passages))
                if r.random() < 0.3:
                    part[r.randrange(len(part))] = "edited"
                begin = r.randint(0, len(part) // 3)
                words += part[begin:]
            elif pick < 0.5:
                words += line * r.randint(1, 10)
        rows.append((doc, " ".join(words)))
    rows += [(200 + k, rows[k % 3][1] + " " * (k % 2)) for k in range(40)]  # a hot group of copies
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(documents, odd_rows, seed):
    rows = corpus(seed) + [(d and d + 500, t) for d, t in odd_rows]
    random.Random(seed).shuffle(rows)
    found = substring.without_repeats(documents(rows)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows, 50)


def test_an_id_on_many_rows(documents):
    """Two thousand rows of one id, a passage in all of them: lists stay as long as a row's own text."""
    r = random.Random(4)
    passage = " ".join(r.choices([f"w{i}" for i in range(900)], k=60))
    rows = [(5, f"{' '.join(r.choices('abcdefgh', k=60))} {passage} n{i}") for i in range(2_000)]
    rows += [(1, passage), (9, passage + " end"), (None, passage)]
    docs = documents(rows)
    longest = max(len(x.windows) for x in substring.repeats(docs).collect())
    assert longest <= 60
    assert sorted(map(tuple, substring.without_repeats(docs).collect()), key=repr) == brute(rows, 50)


def test_empty(documents):
    assert substring.without_repeats(documents([])).collect() == []
