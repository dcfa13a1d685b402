"""Fuzzy fingerprints: edit distance by the table, neighbours by sorting, likeness by edits."""

import hashlib
import random

from starloom.llm import fuzzy


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_edit_distances():
    r = random.Random(1)
    sides = [["".join(r.choices("ABCdef", k=r.randint(0, 64))) for _ in range(200)] for _ in range(2)]
    assert fuzzy.edit_distances(*sides).tolist() == [distance(a, b) for a, b in zip(*sides)]


def test_blocks_do_not_matter(monkeypatch):
    text = "".join(random.Random(2).choices("abcdé \n", k=5_000))
    whole = fuzzy.fingerprint(text)
    monkeypatch.setattr(fuzzy, "BLOCK", 100)
    assert fuzzy.fingerprint(text) == whole


def test_edits_and_strangers():
    r = random.Random(3)
    for n in (20, 200, 3_000, 40_000):
        a, b = ("".join(r.choices("abcdefgh ijklé", k=n)) for _ in range(2))
        cut = fuzzy.edited(a, b)
        prints = [fuzzy.fingerprint(t) for t in (a, cut, b)]
        near, far = fuzzy.likenesses([(prints[0], prints[1]), (prints[0], prints[2])])
        assert near > 0.55 and far < 0.4


def test_repeated_lines_have_letters():
    text = "For " * 2_000
    assert len(fuzzy.fingerprint(text).fine) > 8
    near = fuzzy.likenesses([(fuzzy.fingerprint(text), fuzzy.fingerprint(fuzzy.edited(text, "and so on " * 900)))])
    assert near[0] > 0.4


def test_neighbours(documents, odd_rows):
    rows = [(i * 3 % 211, f"text {i} " * (i % 40)) for i in range(211)]
    found = fuzzy.fingerprints(documents(rows)).collect()
    ordered = sorted(rows)
    expected = {}
    for k, (doc, text) in enumerate(ordered):
        cut = fuzzy.edited(text, ordered[(k + 1) % len(ordered)][1])
        expected[doc] = (len(text), hashlib.sha256(cut.encode()).hexdigest(), str(fuzzy.fingerprint(text)))
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint) for r in found} == expected
    assert len(found) == len(rows)


def test_odd_rows(documents, odd_rows):
    found = fuzzy.fingerprints(documents(odd_rows)).collect()
    assert sorted(((r.doc_id, r.n_chars) for r in found), key=repr) == sorted(
        ((d, len(t or "")) for d, t in odd_rows), key=repr
    )
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert fuzzy.fingerprints(documents([])).collect() == []
    one = fuzzy.fingerprints(documents([(1, "alone")])).collect()
    assert one[0].near_next == 1.0


def plain_print(text):
    """Chunks found byte by byte, with the rolling hash computed anew at each."""
    import zlib

    data = text.encode()
    if not data:
        return (0, "", "")

    def ones(i):
        value = 0
        for back in range(min(7, i + 1)):
            value = (value + (data[i - back] + 1) * pow(0x01000193, back + 1, 2**32)) % 2**32
        value ^= value >> 15
        value = value * 0x2C1B3C6D % 2**32
        value ^= value >> 13
        count = 0
        while value >> count & 1:
            count += 1
        return count

    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

    def letters(power):
        out, begin = "", 0
        for i in range(len(data)):
            length = i + 1 - begin
            if len(out) < 63 and i + 1 < len(data) and (ones(i) >= power or length == 4 << power):
                out += alphabet[zlib.crc32(data[begin : i + 1]) >> 7 & 63]
                begin = i + 1
        return out + alphabet[zlib.crc32(data[begin:]) >> 7 & 63]

    power = 0
    while 64 << power < len(data):
        power += 1
    return (power, letters(power), letters(power + 1))


def odd_texts():
    r = random.Random(12)
    texts = ["", "a", "ab", "x" * 64, "x" * 65, "For " * 300, "\x00" * 500, "é" * 200]
    return texts + ["".join(r.choices("abcdefgh \né", k=r.choice([3, 40, 64, 300, 2_000]))) for _ in range(40)]


def test_prints_by_a_plain_chunker():
    for text in odd_texts():
        assert tuple(fuzzy.fingerprint(text)) == plain_print(text)


def test_likeness_of_rows_by_plain_distances(documents):
    """near_edited and near_next of the operator, from plain prints and the table of edit distances."""
    texts = odd_texts()
    rows = list(enumerate(texts))

    def likeness(a, b):
        if a == b:
            return 1.0
        best = 0.0
        for p, x in ((a[0], a[1]), (a[0] + 1, a[2])):
            for q, y in ((b[0], b[1]), (b[0] + 1, b[2])):
                if p == q and a[1] and b[1]:
                    best = max(best, 1 - distance(x, y) / max(len(x), len(y)))
        return best

    for r in fuzzy.fingerprints(documents(rows)).collect():
        own, after = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        cut = len(own) // 4
        changed = own[: len(own) - cut] + after[:cut]
        assert r.near_edited == likeness(plain_print(own), plain_print(changed))
        assert r.near_next == likeness(plain_print(own), plain_print(after))
