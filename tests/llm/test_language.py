"""Language profiles: held-out accuracy, defined results for odd rows."""

import random

import numpy as np

from starloom.llm import language
from tests.conftest import SMALL

SYLLABLES = {"xa": ["ka", "to", "mi", "ru"], "yb": ["ße", "lö", "un", "ger"], "zc": ["ción", "ña", "el", "do"]}


def text_of(lang, r):
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(r.randint(5, 60)))


def test_held_out(documents, odd_rows):
    r = random.Random(4)
    rows = [(i, text_of(lang, r), lang, None) for i, lang in enumerate(r.choices(list(SYLLABLES), k=300))]
    docs = documents(rows)
    profiles = language.learn(docs.where("doc_id < 150"))
    assert profiles.languages == sorted(SYLLABLES)
    found = language.identify(docs.where("doc_id >= 150"), profiles).collect()
    assert sum(x.language.lang_pred == x.lang for x in found) >= 0.98 * len(found)
    odd = language.identify(documents(odd_rows + [(99, "12 ... 34")]), profiles).collect()
    for x in odd:
        letters = any(c.isalpha() for c in x.text or "")
        assert (x.language.lang_pred == "und") == (not letters)
        assert 0 <= x.language.score <= 1
    kept = language.with_language(docs, profiles)
    assert kept.columns == docs.columns and kept.count() == 300


def test_given_documents(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    profiles = language.learn(docs.where("doc_id % 2 = 0"))
    found = language.identify(docs.where("doc_id % 2 = 1"), profiles).collect()
    assert sum(x.language.lang_pred == x.lang for x in found) >= 0.9 * len(found)


def test_blocks_and_memory_do_not_matter(monkeypatch):
    text = "Ärger " + "".join(random.Random(6).choices("abcdé .\n", k=3_000))
    codes, counts = language.trigrams(text)
    unit = language.Bundler().unit(text)
    monkeypatch.setattr(language, "BLOCK", 50)
    again = language.trigrams(text)
    assert np.array_equal(again[0], codes) and np.array_equal(again[1], counts)
    monkeypatch.setattr(language, "REMEMBERED", 40)
    assert np.allclose(language.Bundler().unit(text), unit)


def test_nothing_learned(documents):
    profiles = language.learn(documents([]))
    found = language.identify(documents([(1, "words")]), profiles).collect()
    assert found[0].language.lang_pred == "und"
    assert language.identify(documents([]), profiles).collect() == []


def test_small_languages_and_repeated_texts(documents):
    """Beside a large language five rows are learned whole; a text in a third of the rows counts once."""
    r = random.Random(7)
    rows = [(k, text_of("xa", r), "xa", None) for k in range(1500)]
    rows += [(2000 + k, text_of("yb", r), "yb", None) for k in range(5)]
    rows += [(3000 + k, "miru toka " * 9, "xa", None) for k in range(750)]
    docs = documents(rows)
    sample = language.sample_of(docs, 300).collect()
    assert len({(s.text, s.lang) for s in sample}) == len(sample)
    assert sum(s.lang == "yb" for s in sample) == 5
    assert 200 < sum(s.lang == "xa" for s in sample) < 400
    assert language.learn(docs, 300).languages == ["xa", "yb"]


def test_bound_of_each_language():
    assert language.most_of_each([5, 1500], 300) == 295
    assert language.most_of_each([5, 10], 300) == 300
    assert language.most_of_each([100, 100, 100], 30) == 10
    assert language.most_of_each([], 30) == 30


def test_letterless_rows_go_whatever_was_learned(documents, odd_rows):
    docs = documents(odd_rows + [(99, "12 ... 34"), (98, "٠ ǅ")])
    learned = language.learn(documents([(1, "some words", "xa", None)]))
    kept = [
        sorted(((x.doc_id, x.text) for x in language.with_language(docs, p).collect()), key=repr)
        for p in (learned, language.learn(documents([])))
    ]
    assert kept[0] == kept[1] and (98, "٠ ǅ") in kept[0]
    assert not {1, 2, 3, 99} & {d for d, _ in kept[1]}


def plain_bundle(text):
    """Vectors bound, rolled and summed trigram by trigram, in plain Python."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = [" ", *" ".join(letters.split()), " "] if letters.strip() else [" "]
    n, total = language.DIMENSIONS, [0] * language.DIMENSIONS
    vectors = {c: language._letter_vector(ord(c)).tolist() for c in set(padded)}
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        for i in range(n):
            total[i] += vectors[a][i - 2] * vectors[b][i - 1] * vectors[c][i]
    return total


def test_bundles_by_plain_loops():
    for text in ["a", "ab", "Guten Tag, schöne Welt 42!", "ñandú   el-niño\n", "ça va? ÇA VA"]:
        right = np.array(plain_bundle(text), float)
        assert np.allclose(language.Bundler().unit(text), right / np.sqrt(right @ right), atol=1e-6)
    assert language.Bundler().unit("12 - 34") is None


def test_predictions_by_plain_cosines(documents):
    r = random.Random(11)
    rows = [(i, text_of(lang, r), lang, None) for i, lang in enumerate(r.choices(list(SYLLABLES), k=24))]
    profiles = language.learn(documents(rows))
    sums = {}
    for _, text, lang, _ in rows:
        v = np.array(plain_bundle(text), float)
        sums[lang] = sums.get(lang, 0) + v / np.sqrt(v @ v)
    tests = [(100 + k, text_of(lang, r)) for k, lang in enumerate(list(SYLLABLES) * 2)]
    for x in language.identify(documents(tests), profiles).collect():
        v = np.array(plain_bundle(x.text), float)
        cosines = {lang: v @ p / np.sqrt((v @ v) * (p @ p)) for lang, p in sums.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert x.language.lang_pred == best and abs(x.language.score - cosines[best]) < 1e-5


def test_stage_fills_missing_languages(documents):
    r = random.Random(5)
    rows = [(i, text_of(lang, r), lang if i % 4 else None, None) for i, lang in enumerate(list(SYLLABLES) * 20)]
    rows += [(200, "12 ...", "xa", None), (201, None, None, None), (202, text_of("yb", r), "stated", None)]
    docs = documents(rows)
    stage = language.with_language(docs, language.learn(docs.where("doc_id < 100")))
    assert stage._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    kept = {x.doc_id: x.lang for x in stage.collect()}
    assert kept == {**{i: list(SYLLABLES)[i % 3] for i in range(60)}, 202: "stated"}
