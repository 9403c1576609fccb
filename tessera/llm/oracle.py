"""DuckDB SQL of the corpus queries that SQL can express, by query."""

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op11_phrase_collocations": rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, list_filter(string_split_regex(part, '[ \t]+'), lambda w: w <> '') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\n\x0b\x0c\r]')) AS part
      FROM documents))
  WHERE len(words) > 0),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, words[i:i + k - 1] AS words, count(*) AS n
  FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(words)
  GROUP BY 1, 2 HAVING count(*) >= 10),
counts AS (SELECT lang, words, array_to_string(words, ' ') AS phrase, n FROM grams),
cands AS (SELECT lang, words, phrase, n AS a FROM counts WHERE len(words) > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.words, c.a, k, l.n AS l, r.n AS r,
         CAST(c.a AS HUGEINT) * c.a * 1000000 // (CAST(l.n AS HUGEINT) * r.n) AS score
  FROM (SELECT *, unnest(range(1, len(words))) AS k FROM cands) c
  JOIN counts l ON l.lang = c.lang AND l.words = c.words[1:k]
  JOIN counts r ON r.lang = c.lang AND r.words = c.words[k + 1:len(c.words)]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, words[1:2] AS words, a FROM cands WHERE len(words) = 3
  UNION ALL SELECT lang, words[2:3], a FROM cands WHERE len(words) = 3),
kept AS (
  SELECT b.* FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.words = b.words AND 100 * i.a >= 50 * b.a)),
totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
""",
    "op13_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(string_split({LOWER}, chr(10))) AS low,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (SELECT *, trim(low, {BLANKS}) AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.*, coalesce(k.doc_id <> f.last, false) AS gone FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
}
