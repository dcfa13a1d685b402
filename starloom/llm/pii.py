"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans. The random field reads white-space tokens and scores
whole candidate segments: every run of up to ``LONGEST`` tokens may be one entity of one
kind, scored by features of the run as a whole (its shape, digit groups, checksum, ranges,
what stands beside it), and every token may be outside. Dynamic programming over the
bounded segments chooses boundaries and kinds together; its weights maximise the
likelihood of labelled regions. It adds spans that the patterns can't see, such as
numbers without a plus sign, dotted cards and addresses with (at) or [.] in them.

An entity must hold a trigger (a digit, an @ or a bracketed at or dot), and added spans
may not overlap base spans. So only regions around triggers outside base spans are
decoded; elsewhere the best path is known to be outside.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Tokens of the longest entity; tokens beside triggers that belong to their region.
LONGEST, CONTEXT = 6, 2
#: Hashed features, passes over the regions, step size, weight decay.
FEATURES, PASSES, RATE, DECAY = 1 << 12, 6, 0.4, 1e-4
#: About so many texts are sampled to learn from, and so many of their words at most.
MAX_TRAIN, MAX_WORDS = 1_000, 20_000

# The base patterns and their bounds.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, LARGEST_PART = (12, 19), (9, 15), 255

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TOKEN = re.compile(r"\S+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TRIGGER = re.compile(r"[0-9@]|[(\[{<](?:at|dot|\.)[)\]}>]", re.I)
_MARKER = re.compile(r"[(\[{<](?:at|dot|\.)[)\]}>]", re.I)

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    """Whether the checksum of a card number holds."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; walks left from each @, so long runs cost their length once."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            found.append((begin, done))
        at = text.find("@", max(at + 1, done))
    return found


def _part_fits(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= LARGEST_PART


def base_spans(text: str) -> list[Span]:
    """(start, end, kind number) of the fixed patterns, by start, then kind."""
    found = [(s, e, 0) for s, e in _emails(text)]
    for m in IP.finditer(text):
        if all(map(_part_fits, m.group().split("."))):
            found.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _NOT_DIGIT.sub("", m.group())
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((m.start(), m.end(), 2))
    for m in PHONE.finditer(text) if "+" in text else ():
        if PHONE_DIGITS[0] <= len(_NOT_DIGIT.sub("", m.group())) <= PHONE_DIGITS[1]:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def listed(spans: list[Span]) -> str:
    """kind:start:end, joined by commas; code points, end exclusive."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


# --- the random field ---------------------------------------------------------------


class Model(NamedTuple):
    """Weights (feature, label) and transitions (label before, label); label 0 is outside."""

    weights: np.ndarray
    transitions: np.ndarray


@lru_cache(maxsize=200_000)
def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


_EDGE_LEFT, _EDGE_RIGHT = "\"'`([{<*#%&$|,;:=", "\"'`.,;:!?*#%&$|)]}>="


def _edges(text: str, begin: int, end: int) -> tuple[int, int]:
    """A token without the punctuation around it; an opening bracket that closes inside stays."""
    while begin < end and text[begin] in _EDGE_LEFT:
        if text[begin] in "([{" and re.search(r"[)\]}]", text[begin + 1 : end]):
            break
        begin += 1
    while end > begin and text[end - 1] in _EDGE_RIGHT:
        if text[end - 1] in ")]}" and re.search(r"[(\[{]", text[begin : end - 1]):
            break
        end -= 1
    return begin, end


def _shape(text: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", text))[:24]


class Region:
    """Tokens around triggers with their candidate segments and features."""

    def __init__(self, text: str, tokens: list[tuple[int, int]]):
        self.text = text
        self.tokens = [_edges(text, *t) for t in tokens]
        words = [text[s:e] for s, e in self.tokens]
        self.trigger = [bool(_TRIGGER.search(text, *t)) for t in tokens]
        marker = [bool(_MARKER.fullmatch(text, *t)) for t in tokens]
        n = len(tokens)
        self.outside = [self._of_token(w, t) for w, t in zip(words, self.trigger)]
        self.segments: list[tuple[int, int, list[int]]] = []
        for i in range(n):
            if not (self.trigger[i] or (i + 1 < n and marker[i + 1])):
                continue
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                last = self.trigger[j - 1] or (j > i + 1 and marker[j - 2])
                if last and self.tokens[i][0] < self.tokens[j - 1][1] and any(self.trigger[i:j]):
                    before = words[i - 1] if i else "<"
                    after = words[j] if j < n else ">"
                    self.segments.append((i, j, self._of_span(i, j, before, after)))

    @staticmethod
    def _of_token(word: str, trigger: bool) -> list[int]:
        if not trigger:
            return [_feature("o plain")]
        names = ["o trigger", "o shape " + _shape(word), f"o digits {min(20, sum(map(str.isdigit, word)))}"]
        return [_feature(x) for x in names]

    def span(self, i: int, j: int) -> tuple[int, int]:
        return self.tokens[i][0], self.tokens[j - 1][1]

    def _of_span(self, i: int, j: int, before: str, after: str) -> list[int]:
        begin, end = self.span(i, j)
        text = self.text[begin:end]
        runs = re.findall(r"[0-9]+", text[:200])
        digits = "".join(runs)
        letters = sum(map(str.isalpha, text[:200]))
        four = len(runs) == 4 and all(len(r) <= 3 and int(r) <= 255 for r in runs)
        card = 12 <= len(digits) <= 19 and luhn(digits)
        shape, beside = _shape(text), re.sub(r"[^a-z]", "", before.lower())[:8]
        at = "@" in text or bool(re.search(r"[(\[{<]at[)\]}>]", text, re.I))
        dots = re.sub(r"[(\[{<](?:\.|dot)[)\]}>]|\s+\.\s+", ".", text, flags=re.I)
        address = bool(re.fullmatch(r"\S+(?:@|\s*[(\[{<]at[)\]}>]\s*)[\w-]+(?:\s*\.\s*[\w-]+)+", dots, re.I))
        names = [
            "s",
            f"s tokens {j - i}",
            "s shape " + shape,
            "s groups " + ".".join(str(min(9, len(r))) for r in runs[:8]),
            f"s digits {min(20, len(digits))}",
            f"s letters {min(3, letters)} at {at}",
            f"s octets {four} {dots.count('.') == 3 and not letters}",
            f"s card {card} {letters == 0}",
            f"s address {address}",
            f"s start {text[:1] if not text[:1].isalnum() else 'x'}",
            f"s marks {''.join(sorted(set(re.sub(r'[\w]', '', text))))[:6]}",
            f"s beside {beside in HINTS} {after[:1] in '%$€'}",
        ]
        return [_feature(x) for x in names]


#: Words that stand before numbers of persons.
HINTS = frozenset(("tel", "phone", "call", "mobile", "fax", "card", "visa", "ip", "host", "mail", "email"))
_LABELS = len(KINDS) + 1


def _scores(region: Region, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores of tokens outside, and of segments by kind (column 0 unused)."""
    outside = np.array([model.weights[f, 0].sum() for f in region.outside])
    inside = np.array([model.weights[f].sum(0) for _, _, f in region.segments])
    return outside, inside.reshape(len(region.segments), _LABELS)


def decode(region: Region, model: Model) -> list[Span]:
    """The best segmentation's entities as (start, end, kind number)."""
    n = len(region.tokens)
    outside, inside = _scores(region, model)
    best = np.full((n + 1, _LABELS), -np.inf)
    best[0, 0] = 0.0
    back: list[list[tuple | None]] = [[None] * _LABELS for _ in range(n + 1)]
    ending: dict[int, list[int]] = {}
    for k, (_, j, _) in enumerate(region.segments):
        ending.setdefault(j, []).append(k)
    for j in range(1, n + 1):
        via = best[j - 1] + model.transitions[:, 0]
        before = int(via.argmax())
        best[j, 0], back[j][0] = via[before] + outside[j - 1], (j - 1, before)
        for k in ending.get(j, ()):
            i = region.segments[k][0]
            through = best[i][:, None] + model.transitions
            before = through.argmax(0)
            for label in range(1, _LABELS):
                value = through[before[label], label] + inside[k, label]
                if value > best[j, label]:
                    best[j, label], back[j][label] = value, (i, int(before[label]))
    out, j, label = [], n, int(best[n].argmax())
    while j:
        i, before = back[j][label]
        if label:
            begin, end = region.span(i, j)
            out.append((begin, end, label - 1))
        j, label = i, before
    return out[::-1]


def _sum_logs(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - top).sum(axis)) + np.squeeze(top, axis)


def _gradient(region: Region, gold: set[Span], model: Model) -> tuple[dict, np.ndarray]:
    """Expected less observed counts of features (by row of labels) and transitions."""
    n = len(region.tokens)
    outside, inside = _scores(region, model)
    forward = np.full((n + 1, _LABELS), -np.inf)
    forward[0, 0] = 0.0
    steps: list[tuple[int, int, int | None]] = [(j, j + 1, None) for j in range(n)]
    steps += [(i, j, k) for k, (i, j, _) in enumerate(region.segments)]
    steps.sort(key=lambda s: s[1])
    scored = []
    for i, j, k in steps:
        own = np.full(_LABELS, -np.inf)
        if k is None:
            own[0] = outside[i]
        else:
            own[1:] = inside[k, 1:]
        scored.append(own)
        reach = _sum_logs(forward[i][:, None] + model.transitions, 0) + own
        forward[j] = np.logaddexp(forward[j], reach)
    backward = np.full((n + 1, _LABELS), -np.inf)
    backward[n] = 0.0
    for (i, j, k), own in sorted(zip(steps, scored), key=lambda s: -s[0][0]):
        reach = _sum_logs(model.transitions + (own + backward[j])[None, :], 1)
        backward[i] = np.logaddexp(backward[i], reach)
    total = _sum_logs(forward[n], 0)
    rows: dict[int, np.ndarray] = {}
    moves = np.zeros_like(model.transitions)

    def count(features: list[int], amount: np.ndarray) -> None:
        for f in features:
            rows[f] = rows.get(f, 0) + amount

    for (i, j, k), own in zip(steps, scored):
        chance = np.exp(forward[i][:, None] + model.transitions + (own + backward[j])[None, :] - total)
        moves += chance
        count(region.outside[i] if k is None else region.segments[k][2], chance.sum(0))
    at, before = 0, 0
    starts = {}
    for k, (i, j, f) in enumerate(region.segments):
        for label in range(1, _LABELS):
            if (*region.span(i, j), label - 1) in gold:
                starts[i] = (j, label, f)
    while at < n:
        j, label, f = starts.get(at, (at + 1, 0, region.outside[at]))
        unit = np.zeros(_LABELS)
        unit[label] = -1.0
        count(f, unit)
        moves[before, label] -= 1
        at, before = j, label
    return rows, moves


def train(labelled: list[tuple[Region, set[Span]]], seed: int = 5) -> Model:
    """Maximum likelihood by AdaGrad over the regions."""
    weights = np.zeros((FEATURES, _LABELS))
    transitions = np.zeros((_LABELS, _LABELS))
    seen, seen_moves = np.full_like(weights, 1e-2), np.full_like(transitions, 1e-2)
    model, order = Model(weights, transitions), random.Random(seed)
    for _ in range(PASSES):
        for at in order.sample(range(len(labelled)), len(labelled)):
            rows, moves = _gradient(*labelled[at], model)
            index = np.fromiter(rows, np.int64, len(rows))
            step = np.stack(list(rows.values())) + DECAY * weights[index]
            seen[index] += step**2
            weights[index] -= RATE * step / np.sqrt(seen[index])
            seen_moves += moves**2
            transitions -= RATE * moves / np.sqrt(seen_moves)
    return model


# --- labelled regions ---------------------------------------------------------------


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _card(r: random.Random) -> str:
    body = r.choice("3456") + _digits(r, 14)
    return next(body + d for d in "0123456789" if luhn(body + d))


def entity(kind: int, r: random.Random, words: list[str]) -> str:
    """An entity of a kind, in a base form or in one that the patterns can't see."""
    if kind == 0:
        name = r.choice(words).lower() + r.choice([".", "_", ""]) + _digits(r, r.randint(0, 3))
        name, host = re.sub(r"[^a-z0-9._]", "", name) or "x1", f"mail{r.randint(0, 99)}"
        top = r.choice(["com", "org", "net", "de"])
        at = r.choice(["@", "@", " (at) ", "(at)", "[at]", " [at] ", " {at} ", "<at>"])
        dot = "." if at == "@" or r.random() < 0.5 else r.choice(["(dot)", " (dot) ", "[.]", " [dot] "])
        return f"{name}{at}{host}{dot}example{dot}{top}"
    if kind == 1:
        dot = r.choice([".", ".", "[.]", "(.)", " . "])
        return dot.join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        number, mark = _card(r), r.choice(["", " ", "-", ".", "/"])
        return mark.join(number[k : k + 4] for k in range(0, 16, 4))
    area, first, last = _digits(r, 3), _digits(r, 3), _digits(r, 4)
    forms = ("+1 ({0}) {1}-{2}", "+1 {0} {1} {2}", "({0}) {1}-{2}", "{0}-{1}-{2}", "{0}.{1}.{2}", "1-{0}-{1}-{2}", "+1.{0}.{1}.{2}")
    return r.choice(forms).format(area, first, last)


def other_number(r: random.Random) -> str:
    """A number or code that is nobody's."""
    forms = (
        lambda: _digits(r, r.randint(1, 8)),
        lambda: _digits(r, r.choice([9, 10, 11, 13, 17, 20, 30])),
        lambda: _not_card(r),
        lambda: f"{r.randint(1900, 2050)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
        lambda: f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1900, 2050)}",
        lambda: f"{r.randint(0, 23)}:{r.randint(0, 59):02}",
        lambda: f"{r.randint(0, 9)}.{r.randint(0, 20)}",
        lambda: f"v{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}",
        lambda: ".".join(str(r.randint(256, 999)) for _ in range(4)),
        lambda: f"{r.randint(1, 999)},{_digits(r, 3)},{_digits(r, 3)}",
        lambda: f"{r.randint(1, 500)}-{r.randint(1, 500)}",
        lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice([8, 32, 40]))),
        lambda: f"{r.randint(1, 99)} {r.randint(1, 99)} {r.randint(1, 99)}",
        lambda: f"@{r.choice(['home', 'all', 'x1'])}",
        lambda: f"({r.randint(1, 99)})",
        lambda: f"{_digits(r, 2)}%",
    )
    return r.choice(forms)()


def _not_card(r: random.Random) -> str:
    while luhn(number := _digits(r, 16)):
        pass
    return number if r.random() < 0.7 else " ".join(number[k : k + 4] for k in range(0, 16, 4))


def made_regions(words: list[str], count: int, seed: int) -> list[tuple[Region, set[Span]]]:
    """Labelled regions: entities and other numbers between words of the corpus."""
    r, out = random.Random(seed), []
    while len(out) < count:
        text, gold = r.choice(words), set()
        for _ in range(r.choice([1, 1, 1, 2, 2, 3])):
            if r.random() < 0.15:
                text += " " + r.choice(sorted(HINTS)) + ":"
            edge = r.choice(["", "", "", "(", '"'])
            text += " " + edge
            if r.random() < 0.55:
                kind = r.randrange(len(KINDS))
                value = entity(kind, r, words)
                gold.add((len(text), len(text) + len(value), kind))
            else:
                value = other_number(r)
            text += value + {"(": ")", '"': '"'}.get(edge, r.choice(["", "", ".", ","]))
            for _ in range(r.choice([0, 1, 2, 3])):
                text += " " + r.choice(words)
        region = Region(text, [m.span() for m in _TOKEN.finditer(text)])
        known = {region.span(i, j) for i, j, _ in region.segments}
        if all((s, e) in known for s, e, _ in gold):
            out.append((region, gold))
    return out


def learn(
    docs: DataFrame, max_train: int = MAX_TRAIN, max_words: int = MAX_WORDS, regions: int = 900
) -> Model:
    """A model from regions made of the corpus' own words.

    The words are ``max_words`` at most, by a hash, of those in about ``max_train`` whole
    texts; they are found on the executors.
    """
    texts = docs.select("text", F.xxhash64("text").alias("key")).where("text is not null")
    share = min(1.0, max_train / max(1, texts.count()))
    sample = texts.where(F.pmod("key", F.lit(1 << 30)) < int(share * (1 << 30)))
    found = F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}{1,20}"), F.lit(0)))
    chosen = sample.select(found.alias("word")).distinct().orderBy(F.xxhash64("word"), "word").limit(max_words)
    words = sorted(r.word for r in chosen.collect()) or ["a", "the", "of"]
    return train(made_regions(words, regions, seed=11))


# --- spans of texts -----------------------------------------------------------------


def _regions(text: str, covered: list[Span]) -> list[Region]:
    """Regions around triggers that no base span covers."""
    marked = bytearray()
    triggers = [m.span() for m in _TRIGGER.finditer(text)]
    if not triggers:
        return []
    if covered:
        marked = bytearray(len(text))
        for s, e, _ in covered:
            marked[s:e] = b"\1" * (e - s)
        triggers = [t for t in triggers if not any(marked[t[0] : t[1]])]
    if not triggers:
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    wanted, k = [], 0
    for number, (begin, end) in enumerate(tokens):
        while k < len(triggers) and triggers[k][0] < begin:
            k += 1
        if k < len(triggers) and triggers[k][0] < end:
            wanted.append(number)
    out, at = [], 0
    while at < len(wanted):
        last = at
        while last + 1 < len(wanted) and wanted[last + 1] - wanted[last] <= 2 * CONTEXT:
            last += 1
        first, final = max(0, wanted[at] - CONTEXT), min(len(tokens), wanted[last] + CONTEXT + 1)
        out.append(Region(text, tokens[first:final]))
        at = last + 1
    return out


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """Spans of the random field that overlap no base span."""
    found = {span for region in _regions(text, base) for span in decode(region, model)}
    return sorted(
        s for s in found if not any(s[0] < e and b < s[1] for b, e, _ in base)
    )


def all_spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans together, both by start, then kind."""
    base = base_spans(text)
    added = added_spans(text, base, model)
    return base, sorted([*base, *added], key=lambda s: (s[0], s[2], s[1]))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    out, done = [], 0
    for begin, end, kind in spans:
        if begin >= done:
            out += [text[done:begin], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


RESULT = (
    "struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint, base: string, "
    "spans: string, masked: string>"
)


def finder(model: Model):
    """A column function of a text: counts, base spans, all spans, and the text without them.

    Null is empty; the masked text of null is null.
    """
    names = [*(f"n_{k}" for k in KINDS), "base", "spans", "masked"]

    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            base, spans = all_spans(text or "", model)
            counts = [sum(k == kind for _, _, k in base) for kind in range(len(KINDS))]
            hidden = None if text is None else masked(text, spans) if spans else text
            rows.append((*counts, listed(base), listed(spans), hidden))
        columns = list(zip(*rows)) or [()] * len(names)
        kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 3
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return F.arrow_udf(find, RESULT)


def sha256_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def without_personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``, all columns, with personal data in ``text`` replaced by its kind in brackets.

    Rows without any keep text and n_chars as they are; others get the new length.
    """
    found = docs.withColumn("__pii", finder(model)("text"))
    changed = F.length("__pii.spans") > 0
    out = found.withColumn("n_chars", F.when(changed, F.length("__pii.masked").cast("long")).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__pii.masked")).select(*docs.columns)
