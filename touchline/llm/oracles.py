"""DuckDB SQL of the queries that SQL can express, written from what they are to
return rather than from how the operators find it."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

REPEATED_PHRASES = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
places AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word,
    unnest(list_transform(range(1, len(words) + 1), lambda i: CASE WHEN i + 19 <= len(words) THEN array_to_string(words[i:i + 19], ' ') END)) AS passage
  FROM docs
),
marked AS (
  SELECT doc_id, i, word, passage IS NOT NULL AND row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1 AS later FROM places
),
gone AS (
  SELECT doc_id, i, word,
    bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS removed
  FROM marked
),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS kept
  FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, least(len(words), 1)) + 1)) AS i FROM docs)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM docs
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN sizes USING (doc_id)"""

_ESCAPED = r"replace(replace(replace(replace(replace({}, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"

CHAT_EXAMPLES = f"""
WITH said AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
turns AS (
  SELECT conv_id, coalesce(role, '') AS said_by, coalesce(text, '') AS said, coalesce(role = 'assistant', FALSE) AS trained,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS nth
  FROM said
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said_by || chr(10) || said || chr(10), '' ORDER BY nth)) AS turns_sha256,
  CAST(coalesce(sum(length(said)) FILTER (WHERE trained), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(said, '' ORDER BY nth) FILTER (WHERE trained), '')) AS loss_sha256,
  CAST(sum(8 + CASE WHEN trained THEN 0 ELSE 15 END + length({_ESCAPED.format("said")})
    + length(replace({_ESCAPED.format("said_by")}, chr(10), '--'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

# tokens of labelled URLs in all combinations; the tables have no URL of more
# tokens than the operator mines
URL_RULES = f"""
WITH parts AS (
  SELECT page_id, url, strpos(coalesce(url, ''), '://') > 0 AS whole,
    {_LOWER.format(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
tokens AS (
  SELECT *, list_sort(list_distinct(
    list_filter(['s:' || CASE WHEN whole THEN split_part(url, '://', 1) ELSE '' END], lambda x: x <> 's:')
    || list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x)
    || list_transform(list_filter(string_split(CASE WHEN whole THEN path ELSE regexp_extract(coalesce(url, ''), '(?s)^([^?#]*)', 1) END, '/'),
         lambda x: x <> ''), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '#', 'g'))
    || list_transform(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\\?([^#]*)', 1), '&'),
         lambda x: split_part(x, '=', 1) <> ''), lambda x: 'q:' || split_part(x, '=', 1))
    || list_filter(['f:' || regexp_extract(coalesce(url, ''), '(?s)^[^#]*#(.*)$', 1)], lambda x: x <> 'f:'))) AS has
  FROM parts
),
labelled AS (
  SELECT has, CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 'block' ELSE 'allow' END AS label
  FROM tokens JOIN labels ON labels.doc_id = TRY_CAST(regexp_extract_all(path, '[0-9]+')[-1] AS BIGINT)
  WHERE toxic IS NOT NULL OR quality IS NOT NULL
),
bounds AS (SELECT count(*) AS total, greatest(20, ceil(round(count(*) * 0.01, 6))) AS least FROM labelled),
subsets AS (
  SELECT label, list_filter(has, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS x
  FROM (SELECT *, unnest(range(0, 1 << len(has))) AS mask FROM labelled)
),
covered AS (SELECT x, count(*) AS covered FROM subsets GROUP BY x),
rated AS (SELECT x, label, count(*) AS n, count(*) / any_value(covered) AS confidence FROM subsets JOIN covered USING (x) GROUP BY x, label),
fewer AS (
  SELECT r.x, r.label, r.n, r.confidence, list_filter(r.x, lambda y, i: i <> gone) AS y
  FROM (SELECT *, unnest(range(1, len(x) + 1)) AS gone FROM rated, bounds WHERE n >= least AND total >= 20 AND confidence >= 0.5) r
),
rules AS (
  SELECT f.x, f.label, any_value(f.n) AS n, any_value(f.confidence) AS confidence
  FROM fewer f LEFT JOIN rated g ON g.x = f.y AND g.label = f.label
  GROUP BY f.x, f.label HAVING any_value(f.confidence) > coalesce(max(g.confidence), -1)
),
best AS (
  SELECT url, x, label, confidence FROM (SELECT DISTINCT url, has FROM tokens WHERE url IS NOT NULL) JOIN rules ON list_has_all(has, x)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY confidence DESC, n DESC, len(x), x, label) = 1
),
given AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' ELSE coalesce(label, 'allow') END AS verdict,
  CASE WHEN rule IS NULL THEN array_to_string(x, ' ') END AS mined, CASE WHEN rule IS NULL THEN confidence END AS confidence
FROM given LEFT JOIN best USING (url)"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
spoken AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM spoken GROUP BY lang),
grams AS (
  SELECT lang, w[i:i + k - 1] AS x, i > 1 AS before, i + k <= len(w) AS after
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM spoken, range(1, 5) t(k))
),
f AS (
  SELECT lang, x, count(*) AS a, count(*) FILTER (WHERE before) AS "left", count(*) FILTER (WHERE after) AS "right"
  FROM grams GROUP BY lang, x HAVING count(*) >= 30
),
cuts AS (SELECT *, unnest(range(1, len(x))) AS k FROM f),
scored AS (
  SELECT c.lang, c.x, c.a, c."left", c."right", l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.x = c.x[:k] JOIN f r ON r.lang = c.lang AND r.x = c.x[k + 1:]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.x ORDER BY score, k) = 1
),
inner_parts AS (
  SELECT lang, x[i:i + m - 1] AS x, max(a) AS around
  FROM (SELECT *, unnest(range(1, len(x) - m + 2)) AS i FROM (SELECT *, unnest(range(2, len(x))) AS m FROM f))
  GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(x, ' '))) AS rank,
  array_to_string(x, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score, "left", "right"
FROM scored JOIN total USING (lang) LEFT JOIN inner_parts USING (lang, x)
WHERE around IS NULL OR 100::HUGEINT * around < 80::HUGEINT * a
QUALIFY rank <= 2000"""

# crc32 a bit at a time: the register shifts right and takes the polynomial in
# where its last bit and the next bit of the text differ
SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-zÀ-ÿ]+')) AS run
  FROM documents
),
of_doc AS (SELECT doc, run, count(*) AS n FROM runs GROUP BY doc, run),
coded AS (SELECT *, hex(encode(doc || ':' || run)) AS code FROM of_doc),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(range(len(code) * 4),
      lambda i: (CAST('0x' || substr(code, 2 * (i // 8) + 1, 2) AS BIGINT) >> (i % 8)) & 1),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS h
  FROM coded
),
spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM holes x JOIN holes y USING (a, b) WHERE x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM holes x JOIN words y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word, x.n FROM holes x JOIN words y ON y.word = x.a || x.b
),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS reached, 0 AS step FROM formed
  UNION ALL SELECT chain.word, formed.form, step + 1 FROM chain JOIN formed ON formed.word = chain.reached WHERE formed.form IS NOT NULL
),
ends AS (SELECT word, arg_max(reached, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""

ORACLES = {
    "op4_repeated_phrases": REPEATED_PHRASES,
    "op7_chat_examples": CHAT_EXAMPLES,
    "op10_chosen_path_join": NEAR_DUPLICATES,
    "op11_url_rules": URL_RULES,
    "op12_collocations": COLLOCATIONS,
    "op13_spelling_variants": SPELLING,
}
