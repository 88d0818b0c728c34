"""SQL (DuckDB) for the rows of those queries that SQL can express."""

from __future__ import annotations

from plumbline.llm.repetition import LENGTHS, LINE_CHARS_LIMIT, LINES_LIMIT, NGRAM_LIMITS

URL_RULES = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path
  FROM cut
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN suffix('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN suffix('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN suffix('.' || host, '.net') AND starts_with(path, '/') THEN 'net/'
    WHEN suffix('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""

NEAR_DUP = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept FROM least LEFT JOIN sizes USING (doc_id)
"""


def _repetition() -> str:
    lead = lambda n: "concat_ws(' ', word, " + ", ".join(f"lead(word, {k}) OVER o" for k in range(1, n)) + ")"
    each = lambda text, lengths=LENGTHS: ", ".join(text.format(n=n, p=n - 1) for n in lengths)
    grams = ", ".join(f"CASE WHEN i + {n} - 1 <= m THEN {lead(n)} END AS g{n}" for n in (3, *LENGTHS))
    share = "coalesce(c{n}, 0)::BIGINT / greatest(word_chars, 1)"
    within = " AND ".join([
        f"coalesce(dup_line_chars, 0)::BIGINT / greatest(word_chars, 1) <= {LINE_CHARS_LIMIT}",
        f"coalesce(n_dup, 0) / greatest(coalesce(n_lines, 0), 1) <= {LINES_LIMIT}",
        *(f"{share.format(n=n)} <= {limit}" for n, limit in zip(LENGTHS, NGRAM_LIMITS)),
    ])
    return r"""
WITH worded AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM worded
), lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY place) AS seen
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM worded)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), line_sums AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (seen > 1) AS n_dup,
         sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (seen > 1) AS dup_line_chars FROM lines GROUP BY doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS m FROM worded
), grams AS (
  SELECT doc_id, i, length(word) AS chars, """ + grams + """ FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), repeats AS (
  SELECT doc_id, i, chars, g3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g3) > 1 AS d3,
         """ + each("g{n} IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, g{n} ORDER BY i) > 1 AS d{n}") + """ FROM grams
), covered AS (
  SELECT doc_id, chars, """ + each("bool_or(d{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS {p} PRECEDING) AS d{n}", (3, *LENGTHS)) + """ FROM repeats
), sums AS (
  SELECT doc_id, count(*) FILTER (d3) AS n_repeat, """ + each("sum(chars) FILTER (d{n}) AS c{n}") + """ FROM covered GROUP BY doc_id
), judged AS (
  SELECT *, coalesce(n_repeat, 0) AS n_repeat_words, n_words < 50 OR 100 * coalesce(n_repeat, 0) > 50 * n_words AS base_failed
  FROM base LEFT JOIN sums USING (doc_id) LEFT JOIN line_sums USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup, 0) AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND """ + within + """ AS kept,
       coalesce(dup_line_chars, 0)::BIGINT / greatest(word_chars, 1) AS dup_line_char_share,
       coalesce(n_dup, 0) / greatest(coalesce(n_lines, 0), 1) AS dup_line_share,
       """ + each(share + " AS dup_{n}gram_char_share") + """
FROM judged"""


REPETITION = _repetition()

HARD_NEGATIVES = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS positive,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM valid a JOIN valid b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM pairs WHERE positive
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), windows AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS place
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.positive
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM windows WHERE place <= 5
"""
