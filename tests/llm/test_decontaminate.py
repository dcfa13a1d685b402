"""Contamination against a search for every window."""

import random
import re

from starloom.llm import decontaminate

NOT_WORD = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return [w for w in NOT_WORD.split((text or "").translate(UPPER)) if w]


def brute(rows, items):
    out = set()
    for doc, text in rows:
        words, hit, met = words_of(text), set(), set()
        for item, content in items:
            parts = words_of(content)
            size = min(13, len(parts))
            windows = {tuple(parts[s : s + size]) for s in range(len(parts) - size + 1)} if parts else set()
            for s in range(len(words) - size + 1) if parts else ():
                if tuple(words[s : s + size]) in windows:
                    hit.update(range(s, s + size))
                    met.add("" if item is None else str(item))
        out.add((doc, len(words), len(hit), tuple(sorted(met))))
    return sorted(out, key=repr)


def found_of(frame):
    rows = frame.collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows), key=repr)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50)] + ["Été", "日本"]
    items = [(k, " ".join(r.choices(vocabulary, k=r.choice([1, 2, 3, 5, 12, 13, 14, 30])))) for k in range(30)]
    items += [(None, "null id of a whole item"), (40, None), (41, ""), (42, items[20][1]), (3, items[3][1])]
    rows = []
    for doc in range(150):
        text = ""
        for _ in range(r.randint(0, 5)):
            text += " " + ", ".join(r.choices(vocabulary, k=r.randint(0, 30)))
            if r.random() < 0.4:
                text += ". " + r.choice(items[:30])[1].upper() + "!"
        rows.append((doc, text))
    return rows + [(200 + k, items[21][1] + " null id of a whole item") for k in range(60)], items


def test_against_all_windows(spark, documents, odd_rows):
    rows, items = corpus(1)
    rows += [(d and d + 500, t) for d, t in odd_rows]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(documents(rows), benchmark)
    assert found_of(found) == brute(rows, items)


def test_blocks_give_the_same(spark, documents, monkeypatch):
    from starloom.llm import shingles

    rows, items = corpus(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(shingles, "BROADCAST_BYTES", 40_000)
    assert found_of(decontaminate.contamination(documents(rows), benchmark)) == brute(rows, items)


def test_clean_rows_stay(spark, documents, odd_rows):
    rows, items = corpus(3)
    rows += [(d and d + 500, t) for d, t in odd_rows]
    docs = documents(rows)
    kept = decontaminate.without_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns
    bad = {(d, t) for d, t in rows for x in brute([(d, t)], items) if x[2] and 20 * x[2] >= x[1]}
    expected = sorted(((d, t) for d, t in rows if (d, t) not in bad), key=repr)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == expected


def test_empty_sides(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents([]), none).collect() == []
    assert found_of(decontaminate.contamination(documents([(1, "a b")]), none)) == [(1, 2, 0, ())]


def test_no_python_in_the_plan(spark, documents):
    rows, items = corpus(4)
    found = decontaminate.contamination(documents(rows), spark.createDataFrame(items, "item_id long, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
