import random

import pytest

#: Extra columns with the names of results, to clash with them.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, "
    "fingerprint int, copies string, item_id long, n_words string, pool string"
)


@pytest.fixture
def documents(spark):
    """Documents of (doc_id, text) or (doc_id, text, lang, source), with clashing columns."""
    from starloom.llm.shared import reach_package

    reach_package(spark)

    def make(rows):
        full = [(*r, *((None, None)[len(r) - 2 :] if len(r) < 4 else ())) for r in rows]
        return spark.createDataFrame(
            [(d, t, lang, src, len(t or ""), "x", 7, "y", 9, "z", "p") for d, t, lang, src in full], SCHEMA
        )

    return make


@pytest.fixture
def odd_rows():
    """Null, empty, blank, long, repeated and id-less rows."""
    words = random.Random(8).choices(["alpha", "Beta", "gamma", "δέλτα", "e"], k=3_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one"),
        (5, " ".join(words)),
        (6, " ".join(words)),
        (7, "tie a b c"),
        (7, "tie a b c"),
        (8, "another text"),
        (8, "under one id"),
        (None, "no id"),
        (None, None),
    ]
