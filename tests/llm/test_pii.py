"""Personal data: base patterns by plain search, the random field on held-out entities."""

import random
import re

import numpy as np
import pytest

from starloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORDS = ["meadow", "River", "window", "über", "garden", "music", "number", "teacher", "canción"]


@pytest.fixture(scope="module")
def model():
    return pii.train(pii.made_regions(WORDS, 500, 1))


def plain(text):
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [
        (m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))
    ]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
        if 12 <= len(digits) <= 19 and doubled % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [
        (m.start(), m.end(), 3)
        for m in PHONE.finditer(text)
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15
    ]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_patterns():
    r = random.Random(2)
    parts = ["a", "b.", "@", "@", "1", "25", "999", ".", "-", "_", "+", "+1", " ", "(", ")", "é", "c.d", "007"]
    parts.append("4111 1111 1111 1111")
    for _ in range(8000):
        text = "".join(r.choices(parts, k=r.randint(0, 30)))
        assert pii.base_spans(text) == plain(text)


def test_long_runs_cost_their_length():
    for text in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 50_000, "+1" * 50_000):
        pii.base_spans(text)


def test_held_out_entities(model):
    found = missed = wrong = 0
    for region, gold in pii.made_regions(WORDS + ["unseen", "words"], 200, 77):
        got = set(pii.decode(region, model))
        found, missed, wrong = found + len(got & gold), missed + len(gold - got), wrong + len(got - gold)
    assert found >= 0.95 * (found + missed) and found >= 0.95 * (found + wrong)


def test_best_path_and_gradient_by_enumeration(model):
    """The decoder's path is the best of all; expected counts are those over all paths."""
    region, gold = next(
        (r, g) for r, g in pii.made_regions(WORDS, 50, 5) if g and len(r.segments) in range(3, 7) and len(r.tokens) < 7
    )
    outside, inside = pii._scores(region, model)
    n, options = len(region.tokens), {}
    for i in range(n):
        options.setdefault(i, []).append((i + 1, 0, outside[i]))
    for k, (i, j, _) in enumerate(region.segments):
        options[i] += [(j, label, inside[k, label]) for label in range(1, 5)]
    paths = []

    def walk(at, before, score, spans):
        if at == n:
            paths.append((score, spans))
        for j, label, own in options.get(at, []):
            here = [(*region.span(at, j), label - 1)] if label else []
            walk(j, label, score + own + model.transitions[before, label], spans + here)

    walk(0, 0, 0.0, [])
    assert max(paths, key=lambda p: p[0])[1] == pii.decode(region, model)
    rows, moves = pii._gradient(region, gold, model)
    total = np.logaddexp.reduce([s for s, _ in paths])
    expected = sum(np.exp(s - total) * len(x) for s, x in paths)
    assert np.isclose(sum(sum(v[1:]) for f, v in rows.items() if f == pii._feature("s")), expected - len(gold))


def test_added_spans(model):
    text = "river 4111 1111 1111 1111 4012888888881881 window x1 (at) mail3.example.com, (212) 555-0142 tail"
    base, spans = pii.all_spans(text, model)
    assert base == pii.base_spans(text) and set(base) <= set(spans)
    assert "(212) 555-0142" in {text[s:e] for s, e, k in spans if k == 3}
    clean = "Meadow of 12 rivers, 3.5 windows; version 2.0 in 1999."
    assert pii.all_spans(clean, model) == ([], [])


def test_rows(documents, odd_rows, model):
    rows = odd_rows + [(20, "mail a.b@c.de or 10.0.0.1, +1 (212) 555-0142 é 4111111111111111")]
    docs = documents(rows)
    hidden = pii.without_personal_data(docs, model)
    assert hidden.columns == docs.columns
    got = {(r.doc_id, r.text): r.n_chars for r in hidden.collect()}
    assert {k for k in got if k[0] != 20} == {r for r in odd_rows}
    text = "mail [EMAIL] or [IP], [PHONE] é [CARD]"
    assert got[(20, text)] == len(text)
    found = docs.where("doc_id = 20").select(pii.finder(model)("text").alias("f")).first().f
    assert (found.n_email, found.n_ip, found.n_card, found.n_phone) == (1, 1, 1, 1)
    assert found.base.startswith("email:5:13,ip:17:25,phone:27:")


def test_learning(documents):
    assert isinstance(pii.learn(documents([]), regions=20), pii.Model)


def test_empty_table(spark, documents, model):
    none = documents([])
    assert none.select(pii.finder(model)("text")).collect() == []
    assert pii.without_personal_data(none, model).collect() == []
    words = pii.learn(none)
    assert pii.all_spans("mail me at joe (at) mail1.example.org", words)[0] == []
