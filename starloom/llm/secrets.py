"""Secrets in texts, told apart by who holds them.

Fixed patterns give the base spans. Wider ones, of names and key forms that the base patterns
don't know, give candidates. Every value found, base or candidate, is hashed, and its hash
aggregated over the whole corpus by distinct repositories and distinct owners. A value that
many owners hold is a widely copied example; one that few owners hold, and that looks as
drawn at random, is a live credential of theirs. Live candidates are added to the spans;
base spans stay, and are told apart in the same way.

Of the values only digests leave a task. They are counted by a plain distinct count, which
combines before its shuffles; digests that hold a ten-thousandth of all spans or more are
ten thousand at most and are broadcast, the spans of the others are joined by their digests.

Rows: null texts are empty, and have no spans. A row is a document of its own, repeated ids
and repeated rows included; rows without a repository count as one repository, those without
an owner as one owner. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import log2
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import map_texts, stored, strings_of

KINDS = ("assign", "access", "hex")

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH = 6

#: Names that the base pattern lacks, before a value of eight characters or more.
NAMED = re.compile(
    r"""(?i:\b(?:pwd|pass|passphrase|auth|authorization|credentials?|access_?key|private_?key|"""
    r"""signing_?key|encryption_?key|session_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{8,})""",
    re.A,
)
#: What follows the name of an HTTP scheme, and a password inside an address.
SCHEME = re.compile(r"(?i:\b(?:bearer|basic))\x20+([A-Za-z0-9+/_.=-]{16,})", re.A)
ADDRESS = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9._%-]{1,64}:([^\s:/@]{6,128})@", re.A)
#: Keys that carry their issuer's mark in front.
MARKED = re.compile(
    r"(?:ASIA[A-Z0-9]|AIza|gh[opsu]_|github_pat_|glpat-|npm_|xox[abprs]-|[rs]k_live_|SG\.)[A-Za-z0-9_.-]{15,}"
)
#: Runs of key characters, and hexadecimal ones that are not all lower case.
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
MIXED_HEX = re.compile(r"[0-9A-Fa-f]{24,}")
#: Parts of values that are meant to be replaced.
PLACEHOLDER = re.compile(
    r"(?i:example|sample|placeholder|changeme|change_me|replace|redacted|dummy|your|xxxx|test|\*\*\*|0123456789|abcdef)"
)
#: Bits a character that a value drawn at random has at least, by its own frequencies.
LEAST_BITS = 2.5
#: Who holds a live value at most. A value beyond either is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 1_000

class Found(NamedTuple):
    start: int
    end: int
    kind: int
    value: str
    base: bool


def base_spans(text: str) -> list[Found]:
    """What the fixed patterns find, by start, then kind.

    A shorter run of the pattern of access keys or hex holds no longer one, so their lengths
    are part of the pattern; a failing assignment uses its characters up, so it is dropped after.
    """
    found = [
        Found(m.start(), m.end(), 0, m.group(1), True)
        for m in ASSIGN.finditer(text)
        if len(m.group(1)) >= ASSIGN_LENGTH
    ]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        found += [Found(m.start(), m.end(), kind, m.group(), True) for m in pattern.finditer(text)]
    return sorted(found, key=lambda s: (s.start, s.kind))


def bits(value: str) -> float:
    """Entropy a character, by the value's own frequencies."""
    size = len(value)
    return -sum(c / size * log2(c / size) for c in Counter(value).values())


def looks_live(value: str) -> bool:
    """Whether a value may have been drawn at random: neither a placeholder nor a word or a pattern."""
    if PLACEHOLDER.search(value) or bits(value) < min(LEAST_BITS, 0.8 * log2(max(2, len(value)))):
        return False
    return any(c.isdigit() for c in value)


def _is_opaque(value: str) -> bool:
    """A run of key characters in both cases with digits among them, as words and paths have not."""
    return (
        any(c.isupper() for c in value)
        and any(c.islower() for c in value)
        and sum(c.isdigit() for c in value) >= 3
        and bits(value) >= 3.5
    )


def candidates(text: str, base: list[Found]) -> list[Found]:
    """Live-looking values outside base spans, leftmost first, none inside another."""
    found = []
    for pattern in (NAMED, SCHEME, ADDRESS) if ":" in text or "=" in text else (SCHEME,):
        found += [Found(m.start(), m.end(), 0, m.group(1), False) for m in pattern.finditer(text)]
    found += [Found(m.start(), m.end(), 1, m.group(), False) for m in MARKED.finditer(text)]
    for m in OPAQUE.finditer(text):
        if MIXED_HEX.fullmatch(m.group()):
            found.append(Found(m.start(), m.end(), 2, m.group(), False))
        elif _is_opaque(m.group()):
            found.append(Found(m.start(), m.end(), 1, m.group(), False))
    out, taken, k = [], -1, 0
    for span in sorted(found, key=lambda s: (s.start, -s.end, s.kind)):
        while k < len(base) and base[k].end <= span.start:
            k += 1
        beside_base = all(b.start >= span.end or b.end <= span.start for b in _near(base, k, span.end))
        if span.start >= taken and beside_base and looks_live(span.value):
            out.append(span)
            taken = span.end
    return out


def _near(base: list[Found], k: int, end: int):
    """Base spans from number k on that start before ``end``."""
    while k < len(base) and base[k].start < end:
        yield base[k]
        k += 1


def digest(value: str) -> bytes:
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:16]


def listed(spans: list[Found]) -> str:
    """kind:start:end, joined by commas; code points, end exclusive."""
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


SPANS = "array<struct<start: bigint, end: bigint, kind: int, digest: binary, base: boolean, live: boolean>>"


def found_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with counts, the listed base spans, and an array of all spans."""
    others = [f for f in docs.schema if f.name != text]
    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), kinds, f"base string, found {SPANS}"])

    def find(batch: pa.RecordBatch) -> dict:
        counts: list[list[int]] = [[] for _ in KINDS]
        base_lists, span_lists = [], []
        for value in strings_of(batch, text):
            base = base_spans(value)
            for kind, column in enumerate(counts):
                column.append(sum(s.kind == kind for s in base))
            base_lists.append(listed(base))
            span_lists.append(
                [
                    (s.start, s.end, s.kind, digest(s.value), s.base, not s.base or looks_live(s.value))
                    for s in [*base, *candidates(value, base)]
                ]
            )
        columns = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in others}
        columns |= {f"n_{k}": c for k, c in zip(KINDS, counts)}
        return columns | {"base": base_lists, "found": span_lists}

    return map_texts(docs, find, schema)


def ownership(spans: DataFrame) -> DataFrame:
    """(digest, repositories, owners, spans) over rows of (digest, repository, owner)."""
    return spans.groupBy("digest").agg(
        F.count_distinct("repository").alias("repositories"),
        F.count_distinct("owner").alias("owners"),
        F.count("*").alias("spans"),
    )


#: A digest with one span in so many, or more, is heavy; there are so many of them at most.
HEAVY_SHARE = 10_000


def with_ownership(spans: DataFrame, counted: DataFrame) -> DataFrame:
    """``spans`` with repositories and owners of their digests; no digest's rows meet in one task."""
    total = counted.agg(F.sum("spans")).first()[0] or 0
    heavy = F.col("spans") * HEAVY_SHARE >= total
    facts = counted.select("digest", "repositories", "owners", heavy.alias("__heavy"))
    common = facts.where("__heavy").drop("__heavy")
    marked = spans.join(F.broadcast(common), "digest", "left")
    rare = marked.where("owners IS NULL").drop("repositories", "owners")
    return marked.where("owners IS NOT NULL").unionByName(
        rare.join(facts.where("NOT __heavy").drop("__heavy"), "digest")
    )


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def secrets(
    docs: DataFrame, repository: str = "doc_id", owner: str = "source", text: str = "text",
    max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """(repository, n_assign, n_access, n_hex, base, spans, live, copied) for each row of ``docs``.

    ``base`` lists the base spans, ``spans`` these and the live candidates, ``live`` those of
    them that look live and that few hold, ``copied`` base spans of values that many hold,
    all by start, then kind.
    """
    holder = F.coalesce(F.col(repository).cast("string"), F.lit(""))
    who = F.coalesce(F.col(owner).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(repository).alias("__id"), holder.alias("__repository"), who.alias("__owner"), F.col(text).alias("__text")
    )
    rows = stored(
        found_spans(narrow, "__text").withColumn("__row", F.monotonically_increasing_id()), "secret-spans"
    )
    spans = rows.where(F.size("found") > 0).select(
        "__row", F.col("__repository").alias("repository"), F.col("__owner").alias("owner"), F.inline("found")
    )
    counted = stored(ownership(spans), "secret-owners")
    few = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    judged = with_ownership(spans, counted).select(
        "__row", F.struct("start", "kind", "end", "base", (F.col("live") & few).alias("live"), (~few).alias("copied")).alias("span")
    )
    kept = judged.where("span.base OR span.live").groupBy("__row").agg(F.array_sort(F.collect_list("span")).alias("all"))
    told = rows.join(kept, "__row", "left")
    spans_of = F.coalesce("all", F.array().cast(kept.schema["all"].dataType))
    return told.select(
        F.col("__id").alias(repository),
        *(f"n_{k}" for k in KINDS),
        "base",
        _listed(spans_of).alias("spans"),
        _listed(F.filter(spans_of, lambda s: s["live"])).alias("live"),
        _listed(F.filter(spans_of, lambda s: s["copied"])).alias("copied"),
    )
