"""SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

import string

from stopwise.llm import licenses, mixing

SEED = 20240229

NEAR_DUPLICATES = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingled AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM split
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id < b.doc_id
    JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n
    HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), steps AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM split
    UNION
    SELECT r.doc_id, s.b FROM reached r JOIN steps s ON s.a = r.other
), smallest AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM split d JOIN smallest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

#: The letters of base32, and the bits of the hexadecimal digits.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NIBBLES = [f"{k:04b}" for k in range(16)]

WARC = f"""
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hash FROM pages
), bits AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, hash,
        array_to_string(list_transform(string_split(hash, ''), lambda d: {NIBBLES}[strpos('0123456789abcdef', d)]), '') AS bits
    FROM payloads
), kept AS (
    SELECT hash, payload_bytes, max(page_id) AS kept FROM bits GROUP BY ALL
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda k: substr('{BASE32}', ('0b' || bits[5 * k + 1 : 5 * k + 5])::INT + 1, 1)), '') AS payload_digest,
    CASE WHEN kept > page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN kept > page_id THEN kept END AS refers_to
FROM bits JOIN kept USING (hash, payload_bytes)
"""

_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.NOTICES.items())

LICENSES = f"""
WITH templates (license, text) AS (VALUES {_TEMPLATES}),
template_words AS (SELECT license, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM templates),
template_shingles AS (
    SELECT DISTINCT license, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM template_words
),
document_words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
document_shingles AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM document_words
),
sizes AS (SELECT license, count(*) AS n FROM template_shingles GROUP BY license)
SELECT doc_id, license, count(*) / n::DOUBLE AS containment
FROM document_shingles JOIN template_shingles USING (s) JOIN sizes USING (license)
GROUP BY doc_id, license, n HAVING count(*) >= {licenses.CONTAINED} * n
"""


def _rounds(seed: int) -> str:
    return ", ".join(f"({k}, {key}, {factor}, {shift})" for k, (key, factor, shift) in enumerate(mixing.round_keys(seed)))


def _permuted(name: str, rows: str, seed: int) -> str:
    """Rows (rank, slot, x, size, tweak) of ``rows`` with ``x`` permuted, as recursive table ``name``."""
    other = "(((key % size + (tweak * factor) % size - x) % size) + size) % size"
    mixed = f"((greatest(x, {other}) % {mixing.PRIME}) * factor + shift + tweak) % {mixing.PRIME}"
    return f"""
{name}_rounds (round, key, factor, shift) AS (VALUES {_rounds(seed)}),
{name}_steps AS (
    SELECT rank, slot, x, size, tweak, 0 AS done FROM {rows}
    UNION ALL
    SELECT rank, slot, CASE WHEN (({mixed}) // 8192) % 2 = 1 THEN {other} ELSE x END, size, tweak, done + 1
    FROM {name}_steps JOIN {name}_rounds ON round = done
),
{name} AS (SELECT rank, slot, x FROM {name}_steps WHERE done = {mixing.ROUNDS})"""


MIX = f"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3))::INT AS bucket
    FROM documents
), ranked AS (
    SELECT source, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM sized GROUP BY source
), weighed AS (
    SELECT *, (CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight, size * 2.0::DOUBLE AS most FROM ranked
), levels AS (
    SELECT *, (sum(size) OVER () * 1.5::DOUBLE - sum(most) OVER (ORDER BY most / weight, rank) + most)
        / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), level AS (
    SELECT min_by(level, rank_of) AS level FROM (SELECT level, row_number() OVER (ORDER BY most / weight, rank) AS rank_of, most / weight AS ratio FROM levels) WHERE level <= ratio
), targets AS (
    SELECT source, rank, size, least(most, coalesce(level.level * weight, most)) AS target, ceil(size / {mixing.WORDS_PER_BLOCK})::BIGINT AS blocks FROM weighed, level
), counted AS (
    SELECT *, CASE WHEN size > 0 THEN least(blocks * 2, round(target * blocks / size)::BIGINT) ELSE 0 END AS slots FROM targets
), slots AS (
    SELECT rank, slot, slot % blocks AS x, blocks AS size, rank AS tweak FROM (SELECT rank, blocks, unnest(range(slots)) AS slot FROM counted)
), {_permuted("blocks_taken", "slots", SEED + 1)}, times AS (
    SELECT rank, x AS block, count(*) AS times FROM blocks_taken GROUP BY rank, x
), placed AS (
    SELECT s.doc_id, s.size, c.rank, c.size AS source_size, c.target, row_number() OVER () AS id,
        coalesce(sum(s.size) OVER (PARTITION BY c.rank ORDER BY bucket, doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM sized s JOIN counted c ON s.source IS NOT DISTINCT FROM c.source
), pieces AS (
    SELECT id, rank, unnest(range((start // {mixing.WORDS_PER_BLOCK})::BIGINT, ((start + size - 1) // {mixing.WORDS_PER_BLOCK})::BIGINT + 1)) AS block FROM placed WHERE size > 0
), taken AS (
    SELECT p.id, sum(times * (least(start + size, (p.block + 1) * {mixing.WORDS_PER_BLOCK}) - greatest(start, p.block * {mixing.WORDS_PER_BLOCK})))::BIGINT AS taken
    FROM pieces p JOIN placed USING (id) JOIN times t ON t.rank = p.rank AND t.block = p.block GROUP BY p.id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM placed LEFT JOIN taken USING (id)
"""
