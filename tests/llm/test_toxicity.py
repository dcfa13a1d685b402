"""Toxicity: held-out ranking, unseen misspellings, odd rows."""

import random

import pytest

from starloom.llm import toxicity

CALM = ["meadow", "river", "window", "paper", "garden", "music", "number", "window", "teacher"]
RUDE = ["stupid", "worthless", "pathetic", "disgusting"]


def sample(seed, n):
    r = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        words = r.choices(CALM, k=r.randint(5, 80))
        label = int(r.random() < 0.3)
        if label:
            for _ in range(1 + len(words) // 20):
                words.insert(r.randrange(len(words)), r.choice(RUDE))
        texts.append(" ".join(words))
        labels.append(label)
    return texts, labels


@pytest.fixture(scope="module")
def scorer():
    return toxicity.Scorer(toxicity.train(*sample(1, 500)))


def test_held_out(scorer):
    texts, labels = sample(2, 300)
    assert sum((scorer.score(t) >= 0.5) == bool(k) for t, k in zip(texts, labels)) >= 0.97 * 300


def test_unseen_misspellings(scorer):
    calm = "meadow river window paper garden music"
    for rude in ("stupiid", "worthles", "pathetik", "dissgusting"):
        assert scorer.score(f"{calm} {rude}") > 0.5 > scorer.score(calm)


def test_memory_does_not_matter(scorer, monkeypatch):
    texts, _ = sample(3, 30)
    before = [scorer.score(t) for t in texts]
    monkeypatch.setattr(toxicity, "REMEMBERED", 3)
    assert [toxicity.Scorer(scorer.model).score(t) for t in texts] == before


def test_rows(spark, documents, odd_rows, scorer):
    docs = documents(odd_rows)
    found = docs.select("doc_id", "text", toxicity.scorer(scorer.model)("text").alias("s")).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.s <= 1 for r in found)
    assert len({r.s for r in found if not (r.text or "").strip()}) == 1
    assert all(r.s < 0.5 for r in found if not (r.text or "").strip())


def test_learning_from_rows(spark):
    texts, labels = sample(4, 400)

    def learn(rows, **options):
        docs = [(i, t) for i, (t, _) in enumerate(rows)]
        marks = [(i, k) for i, (_, k) in enumerate(rows)] + [(10**6, 1), (None, 0)]
        return toxicity.Scorer(
            toxicity.learn(
                spark.createDataFrame(docs, "doc_id long, text string"),
                spark.createDataFrame(marks, "doc_id long, toxic int"),
                **options,
            )
        )

    rows = [*zip(texts, labels), (None, 0), ("x", None), ("y", 5)]
    assert learn(rows, max_train=150).score("river meadow paper stupid worthless stupid") > 0.5
    assert learn([]).score("any") == 0.5
    assert learn([("a", 0)]).score("any") < 0.5


def test_score_by_plain_loops():
    """The folded score is the softmax of the mean of all subwords' vectors."""
    import math
    import re
    import zlib

    texts, labels = sample(8, 120)
    model = toxicity.train(texts, labels)
    for text in ["", "garden river stupid", "Ünïcode wörthless " * 3, "a b", "x" * 200]:
        total, count = float(model.weights[zlib.crc32(b"</>") % toxicity.BUCKETS]), 1
        for word in re.findall(r"\w{1,64}", text.lower()):
            marked = "<" + word + ">"
            grams = [marked] + [marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)]
            for g in grams:
                total = total + float(model.weights[zlib.crc32(g.encode()) % toxicity.BUCKETS])
                count += 1
        right = 1 / (1 + math.exp(-(total / count + model.bias)))
        assert abs(toxicity.Scorer(model).score(text) - right) < 1e-9


def test_empty_tables(spark, documents):
    none = documents([])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(none, labels)
    assert none.select(toxicity.scorer(model)("text")).collect() == []
    assert toxicity.labelled_sample(documents([(1, "a")]), labels) == ([], [], None)


def test_an_id_on_most_rows(spark):
    """What comes to the driver keeps to the bounds in rows and bytes, whatever an id holds."""
    docs = [(7, f"text number {i}") for i in range(15_000)] + [(100 + i, f"other {i}") for i in range(5_000)]
    labels = [(7, 1)] + [(100 + i, i % 2) for i in range(5_000)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    k = spark.createDataFrame(labels, "doc_id long, toxic int")
    for option in ({"max_train": 100}, {"max_train": 20_000, "max_bytes": 2_000}):
        texts, marks, _ = toxicity.labelled_sample(d, k, **option)
        for label in (0, 1):
            own = [t for t, m in zip(texts, marks) if m == label]
            assert len(own) < 200 and sum(map(len, own)) < 4_000
    once, _, _ = toxicity.labelled_sample(d.unionAll(d), k.unionAll(k))
    assert len(once) == len(set(once))
