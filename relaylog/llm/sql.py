"""The queries of this subpackage in SQL, where SQL can express them over whole tables.

The others have none: tokenizers, trained models, binary files and 64-bit hashes are not SQL, and the patterns of the
secret scan look ahead and behind. Their tests compare with plain versions.
"""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

_RULES = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents
), w AS (SELECT *, regexp_extract_all(text, {_WORDS}) AS words FROM d),
base AS (
  SELECT *, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols
  FROM w
), windows AS (
  SELECT row, i, array_to_string(words[i:i + 7], ' ') AS phrase
  FROM (SELECT row, words, unnest(range(1, n_words - 6)) AS i FROM base WHERE n_words >= 8)
), twice AS (
  SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, phrase) > 1
), repeated AS (
  SELECT row, count(DISTINCT place) AS n_repeat_words FROM (SELECT row, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY row
), lines AS (
  SELECT row, host, line, array_to_string(regexp_extract_all(lower(line), {_WORDS}), ' ') AS own,
    len(regexp_extract_all(line, {_WORDS})) AS n
  FROM (SELECT row, host, unnest(string_split(text, chr(10))) AS line FROM d)
), real AS (SELECT * FROM lines WHERE n > 0),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM real GROUP BY row),
own AS (SELECT row, host, own, sum(n) AS words, min(n) AS n FROM real GROUP BY row, host, own),
texts AS (
  SELECT DISTINCT host, text, own, own.words AS n, string_split(own, ' ') AS words FROM own JOIN d USING (row, host)
), candidates AS (SELECT host, own FROM texts GROUP BY host, own HAVING count(*) > 20),
pieces AS (
  SELECT host, text, own, substr(md5(array_to_string(words[i:i + 4], ' ')), 1, 16) AS h
  FROM (
    SELECT *, unnest(range(1, greatest(len(words) - 3, 2))) AS i
    FROM (SELECT * FROM texts ANTI JOIN candidates USING (host, own) QUALIFY sum(n) OVER (PARTITION BY host, text) >= 5)
  )
), rest AS (
  SELECT host, text, unnest([{{'slot': 0, 'value': min(h)}}, {{'slot': 1, 'value': max(h)}}, {{'slot': 2, 'value': min(reverse(h))}},
    {{'slot': 3, 'value': max(reverse(h))}}], recursive := true)
  FROM pieces WHERE (host, text) IN (SELECT (host, text) FROM texts JOIN candidates USING (host, own)) GROUP BY host, text
), votes AS (SELECT *, count(*) OVER (PARTITION BY host, slot, value) AS n FROM rest),
class AS (SELECT host, text, slot || ':' || value AS class FROM votes QUALIFY row_number() OVER (PARTITION BY host, text ORDER BY n DESC, slot, value) = 1),
above AS (
  SELECT host, own FROM texts JOIN candidates USING (host, own) LEFT JOIN class USING (host, text)
  GROUP BY host, own HAVING count(DISTINCT coalesce(class, '')) > 20
), removed AS (SELECT row, sum(words) AS removed_words FROM own JOIN above USING (host, own) GROUP BY row),
figures AS (
  SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_words, 0)::BIGINT AS removed_words
  FROM base LEFT JOIN repeated USING (row) LEFT JOIN dup USING (row) LEFT JOIN removed USING (row)
), judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures)
SELECT *, NOT base_failed AND n_words - removed_words >= 20 AND 5 * (n_words - removed_words) >= n_words AS kept FROM judged
"""

_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS words
  FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS shingle
  FROM w WHERE len(words) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), named AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(named.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN named USING (doc_id)
"""


_REVISITS = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND original <> page_id THEN original END AS refers_to
FROM q
"""


def all_sql() -> dict[str, str]:
    return {"op4_quality_rules": _RULES, "op9_ngram_join": _JOIN, "op11_warc": _REVISITS}
