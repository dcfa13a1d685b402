"""SQL of another engine for the corpus queries that SQL can express."""

from __future__ import annotations

import re

from starloom.llm.license_texts import TEMPLATES
from starloom.llm.mixture import MOST_RATE
from starloom.llm.settings import MIX_SEED, OTHER_WEIGHT, TARGET_WEIGHTS

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), iw AS (
    SELECT DISTINCT item, list_slice(w, s, s + 12) AS win
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT len(win) AS n FROM iw
), dw AS (
    SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)
), hits AS (
    SELECT doc_id, s, n, item FROM dw JOIN iw USING (win)
), places AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRING = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT doc_id, s, md5(array_to_string(list_slice(w, s, s + 49), ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)
), first AS (
    SELECT h, min(doc_id) AS least FROM win GROUP BY h
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p
    FROM win JOIN first USING (h) WHERE doc_id > least
), lists AS (
    SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), placed AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words
    FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_WEIGHTS = ", ".join(f"('{source}', {weight})" for source, weight in TARGET_WEIGHTS.items())

MIXTURE = f"""
WITH w(name, weight) AS (VALUES {_WEIGHTS}), pooled AS (
    SELECT documents.*, name AS pool, coalesce(weight, {OTHER_WEIGHT}) AS weight
    FROM documents LEFT JOIN w ON source = name
), sizes AS (
    SELECT pool, any_value(weight) AS weight, sum(coalesce(length(text), 0) + 1) AS size
    FROM pooled GROUP BY pool
), rates AS (
    SELECT pool, weight / sum(weight) OVER () * CAST(sum(size) OVER () AS DOUBLE) / size AS rate FROM sizes
), parts AS (
    SELECT pool, greatest(1, CAST(ceil(rate / {MOST_RATE}) AS BIGINT)) AS parts, rate / greatest(1, ceil(rate / {MOST_RATE})) AS rate
    FROM rates
), terms AS (
    SELECT pool, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS term
    FROM parts, (SELECT unnest(range(CAST({MOST_RATE} + 25 * sqrt({MOST_RATE}) AS BIGINT))) AS k)
), chances AS (
    SELECT pool, sum(term) OVER (PARTITION BY pool ORDER BY k) AS chance FROM terms
), named AS (
    SELECT *, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')) || '/' || row_number() OVER (
        PARTITION BY doc_id, text, lang, source, n_chars)) AS name, row_number() OVER () AS r
    FROM pooled
), drawn AS (
    SELECT named.*, CAST('0x' || substr(md5('{MIX_SEED}/' || name || CASE part WHEN 0 THEN '' ELSE '/part/' || part END),
        1, 13) AS BIGINT) / 4503599627370496 AS u
    FROM (SELECT named.*, unnest(range(parts)) AS part
          FROM named JOIN parts ON named.pool IS NOT DISTINCT FROM parts.pool) AS named
), counted AS (
    SELECT r, doc_id, text, lang, source, n_chars, CAST(count(*) FILTER (chance <= u) AS INTEGER) AS copies
    FROM drawn JOIN chances ON drawn.pool IS NOT DISTINCT FROM chances.pool
    GROUP BY r, doc_id, text, lang, source, n_chars
)
SELECT * EXCLUDE (r), CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy FROM counted
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _phrase(text: str) -> str:
    return f" {' '.join(re.findall('[0-9a-z]+', text.lower()))} "


_TEMPLATES = ", ".join(
    f"({k}, {_quoted(t.license_id)}, {_quoted(t.text)}, "
    f"CAST([{', '.join(_quoted(_phrase(p)) for p in t.required)}] AS VARCHAR[]))"
    for k, t in enumerate(TEMPLATES)
)

LICENSES = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), t AS (
    SELECT id, license, required, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (VALUES {_TEMPLATES}) v(id, license, text, required)
), sized AS (
    SELECT *, least(5, len(w)) AS size, len(w) - least(5, len(w)) + 1 AS n FROM t WHERE len(w) > 0
), stepped AS (
    SELECT *, greatest(1, n // 4) AS step, n + greatest(1, n // 4) - 1 AS span FROM sized
), ts AS (
    SELECT DISTINCT id, size, list_slice(w, s, s + size - 1) AS shingle
    FROM (SELECT id, size, w, unnest(range(1, n + 1)) AS s FROM stepped)
), owned AS (
    SELECT id, count(*) AS own FROM ts GROUP BY id
), ds AS (
    SELECT doc_id, s - 1 AS p, size, list_slice(w, s, s + size - 1) AS shingle
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
          FROM d, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size)
), met AS (
    SELECT DISTINCT doc_id, id, p, shingle, step, span
    FROM ds JOIN ts USING (size, shingle) JOIN stepped USING (id)
), held AS (
    SELECT doc_id, id, k, count(DISTINCT shingle) AS held
    FROM (
        SELECT *, unnest(range(greatest(0, CAST(ceil((p - span + 1) / step) AS BIGINT)), p // step + 1)) AS k
        FROM met
    )
    GROUP BY doc_id, id, k
), best AS (
    SELECT doc_id, license, max(held / own) AS containment
    FROM held JOIN owned USING (id) JOIN stepped USING (id) JOIN d USING (doc_id)
    WHERE held / own >= 0.8 AND len(list_filter(required, lambda phrase: NOT contains(
        ' ' || array_to_string(list_slice(d.w, k * step + 1, k * step + span + size - 1), ' ') || ' ', phrase))) = 0
    GROUP BY doc_id, license
), listed AS (
    SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS names,
        max(containment) AS most
    FROM best GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_licenses, coalesce(names, '') AS licenses,
    CAST(coalesce(most, 0) AS DOUBLE) AS containment
FROM d LEFT JOIN listed USING (doc_id)
"""

# crc32 bit by bit over the bytes of each distinct n-gram, lowest bit of a byte first
RESAMPLING = rf"""
WITH texts AS (
    SELECT 1 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 2, item_id, text FROM benchmark
), numbered AS (
    SELECT row_number() OVER () AS r, side, id,
        regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), grams AS (
    SELECT r, side, unnest(w) AS gram FROM numbered
    UNION ALL
    SELECT r, side, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM numbered
), counted AS (
    SELECT r, side, gram, count(*) AS n FROM grams GROUP BY ALL
), bytes AS (
    SELECT gram, hex(encode(gram)) AS x FROM (SELECT DISTINCT gram FROM counted)
), hashed AS (
    SELECT gram, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(8 * (len(x) // 2)), lambda i:
            (((instr('0123456789ABCDEF', x[2 * (i // 8) + 1]) - 1) * 16
              + instr('0123456789ABCDEF', x[2 * (i // 8) + 2]) - 1) >> (i % 8)) & 1)),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 10000 AS bucket
    FROM bytes
), bucketed AS (
    SELECT r, side, bucket, n FROM counted JOIN hashed USING (gram)
), sizes AS (
    SELECT count(*) AS n, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS s_all,
        coalesce(sum(n) FILTER (side = 2), 0)::DOUBLE AS t_all
    FROM bucketed
), gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(sum(b.n) FILTER (side = 2), 0) + 1)::DOUBLE * (any_value(s_all) + 10000))
        / ((coalesce(sum(b.n) FILTER (side = 1), 0) + 1)::DOUBLE * (any_value(t_all) + 10000))))::BIGINT AS gain
    FROM bucketed b, sizes GROUP BY bucket
), weights AS (
    SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
    FROM bucketed JOIN gains USING (bucket) WHERE side = 1 GROUP BY r
), scored AS (
    SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(id::VARCHAR, '')), 1, 8) AS BIGINT)
            + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM numbered LEFT JOIN weights USING (r) WHERE side = 1
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS place,
        (SELECT 25 * count(*) // 100 FROM scored WHERE n_words >= 20) AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM placed
"""

CORPUS_SQL: dict[str, str] = {
    "op1_mix_sources": MIXTURE,
    "op6_decontaminate": DECONTAMINATE,
    "op8_substring_dedup": SUBSTRING,
    "op10_licenses": LICENSES,
    "op12_resampling": RESAMPLING,
}
