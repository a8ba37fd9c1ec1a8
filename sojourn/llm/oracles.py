"""The operators' queries in DuckDB SQL, where SQL can say them."""

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, {_UPPER}), '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS words FROM pieces),
grams AS (
  SELECT lang, size, words[i : i + size - 1] AS gram
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM w, range(1, 6) t(size) WHERE len(words) >= size)),
f AS (SELECT lang, size, array_to_string(gram, ' ') AS phrase, any_value(gram) AS gram, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang),
cuts AS (
  SELECT c.lang, c.phrase, c.gram, c.f AS a, l.f AS l, r.f AS r, n, k,
         (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.gram[1 : k], ' ') AND l.size = k
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.gram[k + 1 :], ' ') AND r.size = c.size - k
  JOIN totals ON totals.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, phrase, max(f) AS longer
  FROM (SELECT lang, f, array_to_string(gram[1 : size - 1], ' ') AS phrase FROM f WHERE size > 2
        UNION ALL SELECT lang, f, array_to_string(gram[2 :], ' ') FROM f WHERE size > 2)
  GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
       a, l, r, cast(n AS BIGINT) AS n, cast(score AS BIGINT) AS score
FROM best LEFT JOIN around USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""


def _components(width: int, num: int, extra: str = "") -> str:
    """Sets of shingles, links by counting common ones, and the least id that links lead to."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), '[ \\t-\\r]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + {width - 1}], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {width - 1}, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT u, v FROM (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * common >= {num} * (x.n + y.n - common)),
reach AS (
  SELECT doc_id AS node, doc_id AS least FROM n
  UNION
  SELECT links.v, reach.least FROM reach JOIN links ON links.u = reach.node WHERE reach.least < links.v),
c AS (SELECT node, min(least) AS component FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id{extra}
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = doc_id
"""


OP13 = _components(5, 80)
OP4 = _components(3, 85, ", coalesce(component, doc_id) = doc_id AS kept")
# crc32 of the decimal conv_id, bit by bit.
_CRC = (
    "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"
)
OP12 = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id,
         len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS opener, xor({_CRC}, 4294967295) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
p AS (SELECT c.*, (SELECT count(*) FROM t WHERE t.conv_id = opener AND place <= h) AS head FROM c),
rebuilt AS (
  SELECT p.conv_id, place AS depth, id, words FROM p JOIN t ON t.conv_id = opener AND place <= h
  UNION ALL SELECT p.conv_id, place - h + head, id, words FROM p JOIN t ON t.conv_id = p.conv_id AND place > h),
whole AS (SELECT conv_id, list(id ORDER BY depth) FILTER (id IS NOT NULL) AS ids, list(words ORDER BY depth) AS words
          FROM c LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
m AS (
  SELECT conv_id, d AS depth, array_to_string(coalesce(ids, [])[1 : d], ',') AS key, array_to_string(coalesce(ids, [])[1 : d - 1], ',') AS parent,
         CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words, len(coalesce(ids, [])) = d AS ends
  FROM (SELECT *, unnest(range(0, len(coalesce(ids, [])) + 1)) AS d FROM whole)),
nodes AS (
  SELECT key, depth, any_value(parent) AS parent, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends
  FROM m GROUP BY key, depth),
fan AS (SELECT parent AS key, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN fan USING (key, depth)),
below AS (
  SELECT m.key, m.depth, sum((v.n_children = 0)::BIGINT) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved
  FROM full_nodes v JOIN m ON m.conv_id = v.conv_id AND m.depth <= v.depth GROUP BY ALL)
SELECT x.conv_id, x.depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, cast(n_leaves AS BIGINT) AS n_leaves,
       cast(saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM full_nodes x JOIN below USING (key, depth) LEFT JOIN nodes y ON x.depth > 0 AND y.key = x.parent AND y.depth = x.depth - 1
"""

# op7: the longest rule that fits, else the blocked patterns as one regular expression on host and path.
OP7 = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_full_match(host || path,
                 '(?s)([^/]*\.)?ads\.[^/]*/.*|([^/]*\.)?(adserver|tracker)\..*|.*/(ads|adserver|cgi-bin|signin|cart|checkout)/.*|.*/wp-login\.php|.*\.(jpg|jpeg|png|gif|mp4|mp3|zip|exe|iso)') THEN 'block'
            ELSE 'allow' END AS verdict
FROM r
"""

ORACLES = {
    "op4_near_dedup": OP4,
    "op7_url_filter": OP7,
    "op11_collocations": OP11,
    "op12_prefix_trie": OP12,
    "op13_ngram_join": OP13,
}
