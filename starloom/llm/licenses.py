"""License scans by MinHash bands over overlapping text windows, in DataFrame operations only.

A template of n word shingles is looked for in windows of n + s - 1 shingles that
start every s = max(1, n // 4) shingles, so each place where a template could stand
lies whole inside a window. A window that holds ``CONTAINMENT`` of the template has a
Jaccard likeness of 0.55 at least with it, and some of the ``BANDS`` bands of ``ROWS``
minima agree with probability above 0.9998. Agreeing bands retrieve templates; the
share of the template's shingles in the window is then computed exactly, from words.

A window without any shingle of a template of its size can't agree in a band, so
only windows around such shingles get a signature. Template tables are broadcast in
blocks of checked size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.license_texts import TEMPLATES
from starloom.llm.shared import stored
from starloom.llm.shingles import LOWER, UPPER, blocks, hash_at, positions, words

SHINGLE, CONTAINMENT = 5, 0.8
BANDS, ROWS = 24, 2


def common_licenses(spark: SparkSession) -> DataFrame:
    """(license_id, text, required) of ``license_texts.TEMPLATES``."""
    return spark.createDataFrame(TEMPLATES, "license_id string, text string, required array<string>")


def _phrase(text: Column) -> Column:
    """The words of a text between blanks."""
    lowered = F.translate(text, UPPER, LOWER)
    inner = F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.concat(F.lit(" "), inner, F.lit(" "))


def _banded(df: DataFrame) -> DataFrame:
    """``df`` with ``hashes`` (of shingles) replaced by a row for each band: band, band_key.

    The minima are one expression over the seeds, not one for each, so the generated
    code stays small; each row of minima is one explode, each band a hash of its slice.
    """
    seeds = F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1))
    minimum = F.transform(
        seeds, lambda k: F.array_min(F.transform("hashes", lambda x: F.xxhash64(x, k)))
    )
    bands = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    key = F.xxhash64(F.slice("minima", F.col("band") * ROWS + 1, ROWS))
    return (
        df.withColumn("minima", minimum)
        .drop("hashes")
        .withColumn("band", bands)
        .withColumn("band_key", key)
        .drop("minima")
    )


def _hashes(array: str, size: int) -> Column:
    places = F.sequence(F.lit(0), F.size(array) - size)
    return F.transform(places, lambda at: hash_at(array, at, size))


def _shingles(array: str, size: int) -> Column:
    """The distinct shingles of an array of words, as texts."""
    places = F.sequence(F.lit(1), F.size(array) - (size - 1))
    joined = F.transform(places, lambda at: F.concat_ws(" ", F.slice(F.col(array), at, F.lit(size))))
    return F.array_distinct(joined)


def _in_windows(docs: DataFrame, templates: DataFrame, size: int) -> list[DataFrame]:
    """(doc_id, text_key, license, containment, at) for templates of shingles of ``size`` words."""
    length = F.size("template") - (size - 1)
    step = F.greatest(F.lit(1), F.floor(length / 4).cast("int"))
    sized = stored(
        templates.withColumn("step", step)
        .withColumn("span", length + F.col("step") - 1)
        .withColumn("hashes", _hashes("template", size)),
        "license-templates",
    )
    near = sized.select(F.explode(F.array_distinct("hashes")).alias("known"), "step", "span").distinct()
    first = F.greatest(F.lit(0), F.ceil((F.col("at") - F.col("span") + 1) / F.col("step")).cast("int"))
    last = F.floor(F.col("at") / F.col("step")).cast("int")
    placed = positions(docs, size).where("shingle is not null")
    out = []
    for block in blocks(near, F.lit(64)):
        met = placed.join(block, F.col("shingle") == F.col("known"))
        windows = (
            met.withColumn("number", F.explode(F.sequence(first, last)))
            .select(
                "doc_id",
                "text_key",
                "step",
                "span",
                (F.col("number") * F.col("step")).alias("begin"),
                F.slice("doc_words", F.col("number") * F.col("step") + 1, F.col("span") + size - 1).alias("window"),
            )
            .distinct()
        )
        banded = _banded(windows.withColumn("hashes", _hashes("window", size)))
        bands = _banded(sized).select(
            F.col("license_id").alias("license"),
            "template",
            "required",
            F.col("step").alias("its_step"),
            F.col("span").alias("its_span"),
            F.col("band").alias("its_band"),
            F.col("band_key").alias("its_key"),
        )
        row_bytes = F.lit(200) + F.length(F.concat_ws(" ", "template")) * 2
        for some in blocks(bands, row_bytes):
            agree = (
                (F.col("band") == F.col("its_band"))
                & (F.col("band_key") == F.col("its_key"))
                & (F.col("step") == F.col("its_step"))
                & (F.col("span") == F.col("its_span"))
            )
            candidates = (
                banded.join(some, agree)
                .select("doc_id", "text_key", "license", "template", "required", "begin", "window")
                .distinct()
            )
            own = _shingles("template", size)
            held = F.size(F.array_intersect(own, _shingles("window", size))) / F.size(own)
            in_words = F.concat(F.lit(" "), F.concat_ws(" ", "window"), F.lit(" "))
            out.append(
                candidates.where(F.forall("required", lambda phrase: F.contains(in_words, phrase)))
                .withColumn("containment", held)
                .where(F.col("containment") >= CONTAINMENT)
                .select("doc_id", "text_key", "license", "containment", "begin")
            )
    return out


def license_matches(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """A row per document: doc_id, text_key, matches (array of license, containment, begin).

    ``templates``: (license_id, text), any number for a license, and if wanted ``required``:
    an array of phrases. A template is found if a window holds at least ``CONTAINMENT``
    of its shingles of ``SHINGLE`` words (all words of a shorter template) and the words
    of each of its required phrases in a row; ``matches`` has each license once, in order of
    its name, with the best containment of its templates and the first word position of a
    window that has it. ``text_key`` is a hash of the text; rows that repeat doc_id and
    text give one row. Null and empty texts, and templates without words, match nothing;
    null license ids are left out, and so are null phrases and those without words.
    """
    phrases = F.lit(None).cast("array<string>")
    if "required" in templates.columns:
        phrases = F.transform(F.filter("required", lambda p: p.isNotNull()), _phrase)
    phrases = F.array_sort(F.array_distinct(F.coalesce(phrases, F.array().cast("array<string>"))))
    named = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), words("text").alias("doc_words")
    )
    wanted = stored(
        templates.where("license_id is not null")
        .select(
            F.col("license_id").cast("string").alias("license_id"),
            words("text").alias("template"),
            F.filter(phrases, lambda p: F.trim(p) != "").alias("required"),
        )
        .where(F.size("template") > 0)
        .distinct(),
        "license-words",
    )
    size_of = F.least(F.size("template"), F.lit(SHINGLE))
    found = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.lit(None).cast("struct<license: string, less: double, begin: int>").alias("match"),
    )
    for size in sorted(r[0] for r in wanted.select(size_of).distinct().collect()):
        for part in _in_windows(named, wanted.where(size_of == size), size):
            best = part.groupBy("doc_id", "text_key", "license").agg(
                F.min(F.struct((-F.col("containment")).alias("less"), "begin")).alias("best")
            )
            match = F.struct("license", F.col("best.less").alias("less"), F.col("best.begin").alias("begin"))
            found = found.union(best.select("doc_id", "text_key", match.alias("match")))
    # A license may have one row for each size and block; the first of each has the best.
    first_of_each = F.filter(
        "all", lambda m, k: (k == 0) | (m["license"] != F.get(F.col("all"), k - 1)["license"])
    )
    match = F.transform(
        first_of_each,
        lambda m: F.struct(m["license"].alias("license"), (-m["less"]).alias("containment"), m["begin"].alias("begin")),
    )
    return (
        found.groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_list("match")).alias("all"))
        .select("doc_id", "text_key", match.alias("matches"))
    )
