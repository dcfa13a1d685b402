"""Importance resampling: n-grams by plain slices, weights, draw and ranks by hand."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from starloom.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def plain_buckets(text, longest=2, buckets=10_000):
    w = plain_words(text)
    return [
        zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets
        for n in range(1, longest + 1)
        for i in range(len(w) - n + 1)
    ]


def by_hand(docs, target, percent=25, fewest=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_buckets(text))
    for text in target:
        t.update(plain_buckets(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        found = plain_buckets(text)
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000) / ((s[b] + 1.0) * (t_all + 10000)))) for b in found]
        weight = sum(gain) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc_id, len(found), weight, score, len(plain_words(text)) >= fewest])
    able = [r for r in out if r[4]]
    order = sorted(able, key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(order[: percent * len(able) // 100], 1):
        row.append(rank)
    return sorted([(*r[:4], r[5] if len(r) > 5 else None) for r in out], key=repr)


def found_rows(df):
    return sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()], key=repr)


def texts(count, seed=2):
    r = random.Random(seed)
    words = ["alpha", "Beta", "γάμμα", "d4", "ÉTÉ", "e"] + [f"w{k}" for k in range(300)]
    marks = [" ", ", ", "\n", "--", "\x7f", "_"]
    return [
        (i, "".join(r.choice(words) + r.choice(marks) for _ in range(r.choice([0, 5, 19, 20, 60, 200]))))
        for i in range(count)
    ]


def test_features_of_pieces(monkeypatch):
    text = "One two  THREE vier-fünf x\x85y " * 40
    for longest in (1, 2, 3, 5):
        right = Counter(plain_buckets(text, longest, 2**32))
        for piece in (1, 7, 64, 1 << 20):
            monkeypatch.setattr(resampling, "PIECE", piece)
            parts = list(resampling.features(text.encode(), longest))
            assert Counter(c for _, found in parts for c in found) == right
            assert sum(n for n, _ in parts) == len(plain_words(text))


def test_draw(spark, documents):
    docs = texts(400)
    target = [t for _, t in texts(30, seed=5)] + [None, ""]
    items = spark.createDataFrame([(9, t, "x") for t in target], "item_id long, text string, weight string")
    found = resampling.resampled(documents(docs).repartition(9), items)
    assert found_rows(found) == by_hand(docs, target)


def test_odd_rows(spark, documents, odd_rows):
    items = spark.createDataFrame([("tie a b c",), (None,)], "text string")
    rows = odd_rows + [(50, "Null\x00byte and 日本語 " * 30)] + [(k, "same words " * 20) for k in range(60, 90)]
    found = resampling.resampled(documents(rows), items, percent=50)
    assert found_rows(found) == by_hand(rows, ["tie a b c", None], percent=50)
    empty = spark.createDataFrame([], "text string")
    assert found_rows(resampling.resampled(documents(rows), empty)) == by_hand(rows, [])
    assert resampling.resampled(documents([]), items).collect() == []


def test_ranks_of_equal_rows(spark, documents):
    """A third of all rows under one id and text: their ranks follow each other, none is lost."""
    docs = [(5, "one and the same text " * 10)] * 300 + [(100 + i, t) for i, t in texts(600)]
    found = resampling.resampled(documents(docs).repartition(6), spark.createDataFrame([("one and",)], "text string"), percent=100)
    rows = [r for r in found.collect() if r["rank"]]
    assert sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1))
    same = sorted(r["rank"] for r in rows if r.doc_id == 5)
    assert len(same) == 300 and same[-1] - same[0] == 299
    ordered = sorted(rows, key=lambda r: r["rank"])
    assert all((a.score, -a.doc_id) >= (b.score, -b.doc_id) for a, b in zip(ordered, ordered[1:]))


def test_draw_prefers_the_target(spark, documents):
    """Documents of the target's words are drawn three times as often as others of the same length."""
    r = random.Random(1)
    near, far = [f"n{k}" for k in range(50)], [f"f{k}" for k in range(50)]
    docs = [(i, " ".join(r.choices(near if i % 4 == 0 else far, k=40))) for i in range(800)]
    target = spark.createDataFrame([(" ".join(r.choices(near, k=400)),)], "text string")
    drawn = [x.doc_id for x in resampling.resampled(documents(docs), target).where("rank IS NOT NULL").collect()]
    near_drawn = sum(i % 4 == 0 for i in drawn)
    assert len(drawn) == 200 and near_drawn / 200 > 3 * (200 - near_drawn) / 600
