"""DuckDB SQL for the corpus queries that SQL can express, written apart from the operators."""
from __future__ import annotations

OP8 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), m AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""

_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    "|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def _spans(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, k, m, g,
         list_sum(list_transform(gaps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT doc_id, gaps, ms, unnest(range(1, len(ms) + 1)) AS k, unnest(ms) AS m, unnest(gs) AS g
        FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS ms,
                     regexp_extract_all(text, '{pattern}', {group}) AS gs FROM documents WHERE text IS NOT NULL))
  WHERE length(g) >= {least}"""


_BASE = (("assign", _ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24))
_MORE = (
    ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    ("forge", "gh[pousr]_[A-Za-z0-9]{36,255}", 0, 40),
    ("jwt", "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}", 0, 30),
)
OP10 = (
    "WITH s AS ("
    + " UNION ALL ".join(_spans(i, *r) for i, r in enumerate(_BASE + _MORE))
    + """
), t AS (SELECT doc_id, rank, kind, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(m) AS BIGINT) AS span FROM s),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM t GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""
)

_WORDS2 = """list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""
OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS2} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS2} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, w[k:k + 12] AS p FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(p) AS n FROM bw),
dw AS (SELECT doc_id, n, k, w[k:k + n - 1] AS p FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, item, n, k FROM dw JOIN bw USING (p)),
hw AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS i FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

def _covered(n: int) -> str:
    """Per word, whether it lies in an n-word window found twice or more in its text."""
    return f"""c{n} AS (
  SELECT doc_id, k, coalesce(max(dup) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 0) AS hit
  FROM w LEFT JOIN (
    SELECT doc_id, k, CASE WHEN count(*) OVER (PARTITION BY doc_id, g) > 1 THEN 1 ELSE 0 END AS dup
    FROM (SELECT doc_id, k, ws[k:k + {n - 1}] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS k FROM d WHERE len(ws) >= {n}))
  ) USING (doc_id, k)
)"""


_LENGTHS = (3, 5, 7, 10)
OP1 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS k, length(unnest(ws)) AS ch FROM d),
{", ".join(_covered(n) for n in _LENGTHS)},
s AS (SELECT doc_id, sum(ch) AS word_chars, {", ".join(f"sum(c{n}.hit) AS words_{n}, sum(c{n}.hit * ch) AS chars_{n}" for n in _LENGTHS)}
      FROM w {" ".join(f"JOIN c{n} USING (doc_id, k)" for n in _LENGTHS)} GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS dup_line_chars
      FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS turn
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]'))
      WHERE turn > 1 GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             CAST(coalesce(words_3, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars,
             {", ".join(f"CAST(coalesce(chars_{n}, 0) AS BIGINT) AS dup_{n}_chars" for n in _LENGTHS[1:])}
      FROM d LEFT JOIN s USING (doc_id) LEFT JOIN l USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= 30 * word_chars AND 100 * dup_5_chars <= 45 * word_chars
          AND 100 * dup_7_chars <= 40 * word_chars AND 100 * dup_10_chars <= 35 * word_chars AS kept
FROM f
"""

OP12 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM d
), total AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM p, (SELECT unnest([1, 2, 3, 4]) AS k)
), c AS (
  SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30
), cut AS (
  SELECT c.lang, c.phrase, c.k, c.a, j, string_split(c.phrase, ' ') AS w FROM c, (SELECT unnest([1, 2, 3]) AS j) WHERE j < c.k
), scored AS (
  SELECT cut.lang, cut.phrase, cut.k, cut.a, j, x.a AS l, y.a AS r, ((2000000::HUGEINT * cut.a) // (x.a + y.a))::BIGINT AS score
  FROM cut JOIN c x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:j], ' ')
           JOIN c y ON y.lang = cut.lang AND y.phrase = array_to_string(w[j + 1:], ' ')
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM c s JOIN c t
    ON s.lang = t.lang AND s.k > 1 AND t.k > s.k AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * t.a >= 80 * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM weakest ANTI JOIN inside USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op1_repetition": OP1, "op2_decontamination": OP2, "op8_url_filter": OP8, "op10_secret_scan": OP10, "op12_collocations": OP12}
