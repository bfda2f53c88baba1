"""SQL of the text queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

# Base32 of a SHA-1: four groups of 40 bits, each eight letters of five bits.
OP4 = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), hashed AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM payloads
), letters AS (
  SELECT hex, i, (CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS letter
  FROM (SELECT DISTINCT hex FROM hashed) CROSS JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(32))
), digests AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(letter AS INTEGER) + 1, 1), '' ORDER BY i)
    AS payload_digest
  FROM letters GROUP BY hex
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM hashed
)
SELECT page_id,
  CAST(payload_bytes AS BIGINT) AS payload_bytes,
  payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts JOIN digests USING (hex)
"""


OP5 = """
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS place
  FROM normal
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""


OP12 = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]'), lambda w: w <> '') AS words FROM pieces
), starts AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split
), grams AS (
  SELECT lang, size, words[i : i + size - 1] AS gram
  FROM starts CROSS JOIN (SELECT unnest([1, 2, 3]) AS size)
  WHERE i + size - 1 <= len(words)
), f AS (
  SELECT lang, size, gram, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM f WHERE size > 1 AND a >= 10
), cuts AS (
  SELECT lang, size, gram, a, unnest(range(1, size)) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.size, c.gram, c.a, c.k, l.a AS l, r.a AS r,
    CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.gram = c.gram[1 : c.k]
  JOIN f r ON r.lang = c.lang AND r.gram = c.gram[c.k + 1 : c.size]
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), covers AS (
  SELECT lang, unnest([gram[1 : 2], gram[2 : 3]]) AS gram, a AS holder FROM candidates WHERE size = 3
), named AS (
  SELECT w.*, array_to_string(w.gram, ' ') AS phrase FROM weakest w
  WHERE NOT EXISTS (
    SELECT 1 FROM covers h WHERE h.lang = w.lang AND h.gram = w.gram AND 100 * h.holder >= 50 * w.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM named JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


# CRC-32 byte by byte, with a table of its 256 steps.
OP13 = """
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)
    ORDER BY b) AS step
  FROM (SELECT unnest(range(256)) AS b)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
), lowered AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id,
    translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY ALL
), bytes AS (
  SELECT run, n, hex(encode(id || run)) AS digits FROM lowered WHERE length(run) >= 5
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(1, len(digits), 2), lambda i: CAST('0x' || substr(digits, i, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT))) AS h
  FROM bytes CROSS JOIN steps
), spelled AS (
  SELECT CASE WHEN h % 97 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), holes AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), holed AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM holes
), pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n
  FROM holed a JOIN holed b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holed a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM holed a JOIN words b ON a.rest = b.word
), counted AS (
  SELECT word, count(*) AS n_near FROM pairs GROUP BY word
), largest AS (
  SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
), forms AS (
  SELECT word, near AS form, near_n AS form_n FROM largest WHERE near_n >= 2 * n
), chain AS (
  SELECT word, word AS root FROM words
  UNION SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root
), roots AS (
  SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms)
)
SELECT w.word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words w JOIN roots USING (word) LEFT JOIN forms USING (word) LEFT JOIN counted USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": OP4,
        "op5_exact_dedup": OP5,
        "op12_phrase_collocations": OP12,
        "op13_spelling_variants": OP13,
    }
