"""License scans against all windows."""

import random

from starloom.llm import licenses
from tests.llm.test_decontaminate import words_of


def brute(rows, templates):
    out = set()
    for doc, text in rows:
        words, met = words_of(text), []
        for name, content in templates:
            own = words_of(content)
            if not own or name is None:
                continue
            size = min(5, len(own))
            grams = [tuple(own[s : s + size]) for s in range(len(own) - size + 1)]
            step = max(1, len(grams) // 4)
            span, best = len(grams) + step - 1, 0.0
            of_doc = [tuple(words[s : s + size]) for s in range(len(words) - size + 1)]
            for begin in range(0, len(of_doc), step):
                best = max(best, len(set(grams) & set(of_doc[begin : begin + span])) / len(set(grams)))
            if best >= 0.8:
                met.append((name, best))
        out.add((doc, text, tuple(sorted(met))))
    return sorted(((d, m) for d, _, m in out), key=repr)


def found_of(frame):
    rows = frame.collect()
    return sorted(
        ((r.doc_id, tuple((m.license, m.containment) for m in r.matches)) for r in rows), key=repr
    )


def test_against_all_windows(spark, documents, odd_rows):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)]
    templates = [(f"t{n}", " ".join(r.choices(vocabulary, k=n))) for n in (1, 3, 5, 7, 12, 40, 90)]
    templates += [("none", None), ("blank", " .. "), (None, "no name for this one"), ("same", templates[4][1])]
    rows = []
    for doc in range(120):
        words = r.choices(vocabulary, k=r.randint(0, 40))
        if doc % 3 == 0:
            part = r.choice(templates[:7])[1].upper().split()
            if len(part) > 5 and r.random() < 0.6:
                part[r.randrange(len(part))] = "edited"
            words += part + r.choices(vocabulary, k=r.randint(0, 30))
        rows.append((doc, " ".join(words)))
    rows += [(d and d + 500, t) for d, t in odd_rows]
    frame = spark.createDataFrame(templates, "license_id string, text string")
    assert found_of(licenses.license_matches(documents(rows), frame)) == brute(rows, templates)


def test_notices_and_no_templates(spark, documents):
    docs = documents([(1, "x. Released under the MIT license, y"), (2, "released under")])
    notice = spark.createDataFrame([("MIT", "Released under the MIT License.")], "license_id string, text string")
    found = found_of(licenses.license_matches(docs, notice))
    assert found == [(1, (("MIT", 1.0),)), (2, ())]
    none = spark.createDataFrame([], "license_id string, text string")
    assert found_of(licenses.license_matches(docs, none)) == [(1, ()), (2, ())]
    assert licenses.license_matches(documents([]), none).collect() == []


def licenses_of(spark, documents, rows):
    found = licenses.license_matches(documents(rows), licenses.common_licenses(spark)).collect()
    return {r.doc_id: [m.license for m in r.matches] for r in found}


def full_texts():
    """Texts and the licenses in them: bodies, headers, edited ones, and versions that differ in a word."""
    from starloom.llm import license_texts as t

    r = random.Random(9)

    def around(text):
        prose = [" ".join(r.choices(["alpha", "beta", "gamma", "delta"], k=r.randint(3, 40))) for _ in "ab"]
        return f"{prose[0]} {text} {prose[1]}"

    def edited(text):
        words = text.split()
        for at in (len(words) // 5, len(words) // 2):
            words[at] = "edited"
        return " ".join(words)

    mit = t._MIT_GRANT + t._MIT_NOTICE + t._MIT_WARRANTY
    bsd = t._BSD_CONDITIONS + t._BSD_NAMES + t._BSD_WARRANTY
    old_fsf = "This program is free software; you can redistribute it" + t._gnu_header("", "2").split("redistribute it")[1]
    cases = [
        (mit, ["MIT"]),
        (edited(mit), ["MIT"]),
        (mit.replace(t._MIT_NOTICE, ""), ["MIT-0"]),
        (mit[:250], []),
        (bsd, ["BSD-3-Clause"]),
        (edited(bsd), ["BSD-3-Clause"]),
        (bsd.replace(t._BSD_NAMES, ""), ["BSD-2-Clause"]),
        (t._gnu_header("", "3"), ["GPL-3.0"]),
        (old_fsf, ["GPL-2.0"]),
        (t._gnu_header("Affero ", "3"), ["AGPL-3.0"]),
        (t._gnu_header("Lesser ", "3"), ["LGPL-3.0"]),
        (t._gnu_header("Lesser ", "2.1", "This library"), ["LGPL-2.1"]),
        (t._GPL3, ["GPL-3.0"]),
        (t._GPL2, ["GPL-2.0"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", []),
        (t._APACHE, ["Apache-2.0"]),
        (t._APACHE_OPENING + " " + mit, ["Apache-2.0", "MIT"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
    ]
    return [(around(text), names) for text, names in cases]


def test_full_texts_and_versions(spark, documents):
    cases = full_texts()
    found = licenses_of(spark, documents, [(k, text) for k, (text, _) in enumerate(cases)])
    assert found == {k: names for k, (_, names) in enumerate(cases)}


def test_sql_is_of_the_operator(spark, documents, tmp_path):
    """Both engines agree on full, edited and wrong-version texts, and on every template itself."""
    import duckdb
    from pyspark.sql import functions as F

    from starloom.llm.license_texts import TEMPLATES
    from starloom.llm.queries import LLM_QUERIES, LLM_SQL

    texts = [text for text, _ in full_texts()] + [t.text for t in TEMPLATES]
    r = random.Random(3)
    for t in TEMPLATES:
        words = t.text.split()
        for k in range(max(1, len(words) // 9)):
            words[r.randrange(len(words))] = f"changed{k}"
        texts.append("before " + " ".join(words) + " after")
    rows = [*enumerate(texts), (9000, None), (9001, ""), (9002, "gnu general public")]
    documents(rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    other = duckdb.connect()
    other.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    right = other.sql(LLM_SQL["op10_licenses"])
    found = LLM_QUERIES["op10_licenses"](spark, str(tmp_path)).select(*[F.col(c) for c in right.columns]).collect()
    expected = sorted(right.fetchall())
    assert sorted(map(tuple, found)) == expected
    assert sum(n > 0 for _, n, _, _ in expected) > 60


def test_one_match_for_a_license_of_several_sizes(spark, documents):
    templates = spark.createDataFrame(
        [("x", "one two"), ("x", "one two three four five six"), ("x", "nine ten")], "license_id string, text string"
    )
    found = licenses.license_matches(documents([(1, "zero one two three four five six"), (2, "ten")]), templates)
    assert found_of(found) == [(1, (("x", 1.0),)), (2, ())]


def test_each_template_finds_its_own_license(spark, documents):
    from starloom.llm.license_texts import TEMPLATES

    rows = [(k, t.text) for k, t in enumerate(TEMPLATES)]
    found = licenses_of(spark, documents, rows)
    assert found == {k: [t.license_id] for k, t in enumerate(TEMPLATES)}
