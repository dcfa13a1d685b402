"""SimHash groups against all pairs by brute force."""

import random
from itertools import combinations

import pytest
import xxhash

from starloom.llm import simhash
from starloom.llm.components import components

SCHEMA = "doc_id long, text string, fingerprint int, component_id string"


def print_of(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(rows, bits=4):
    prints = [print_of(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= bits:
            root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        out.append((doc, prints[i], min(ids, default=None)))
    return sorted(out, key=repr)


def corpus(seed, size):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "A b c"), (5, "A b c"), (None, "a B c")]
    base = [r.choice(vocabulary) for _ in range(400)]
    for i in range(6, size):
        if i % 3 == 0:  # a third are near copies of one text
            words = list(base)
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
        else:
            words = [r.choice(vocabulary) for _ in range(r.randint(1, 60))]
        rows.append((i, " ".join(words).title() + " " * r.randint(0, 2)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups(spark, seed):
    rows = corpus(seed, 400)
    docs = spark.createDataFrame([(d, t, 7, "x") for d, t in rows], SCHEMA)
    found = simhash.near_copies(docs).collect()
    expected = groups_of(rows)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=repr) == expected


def test_hot_cells_in_chunks_connect_the_same(spark):
    r = random.Random(3)
    prints = {sum(r.choice([0, 0, 1]) << b for b in range(0, 44, 2)) for _ in range(900)}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    whole = components(simhash.links(frame, 4)).collect()
    cut = components(simhash.links(frame, 4, cell_rows=64)).collect()
    assert sorted(whole) == sorted(cut) and len(whole) > 300


def test_one_stays(spark):
    rows = corpus(4, 200)
    docs = spark.createDataFrame([(d, t, 7, "x") for d, t in rows], SCHEMA)
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    expected = {d for d, _, c in groups_of(rows) if d == c}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_empty(spark):
    assert simhash.near_copies(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_long_chain(spark):
    ends = list(range(200))
    random.Random(5).shuffle(ends)
    links = spark.createDataFrame(list(zip(ends, ends[1:])) + [(500, 501), (501, 500), (9, 9)], "a long, b long")
    roots = dict(components(links).collect())
    assert set(roots.values()) == {0, 500} and len(roots) == 202
