"""DuckDB SQL for the operators that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM twice) GROUP BY doc_id
), ln AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), s AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS letters,
    length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS capitals,
    length(regexp_replace(text, '[^0-9]+', '', 'g')) AS digits
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN ln USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
    OR 10 * n_symbols > n_words OR 10 * capitals > 3 * letters OR 2 * digits > word_chars
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR (n_dup_lines >= 10 AND 2 * n_dup_lines > n_lines)) AS kept
FROM s
"""

SOURCE_MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5(coalesce(text, '')) AS text_md5 FROM documents
), h AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', '17', coalesce(doc_id::VARCHAR, ''), size::VARCHAR, text_md5)), 1, 15))::BIGINT AS h
  FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank FROM s
), w AS (
  SELECT *, ([3.0, 1.0, 2.0])[(rank - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM r
), l AS (
  SELECT *, cap / weight AS ratio,
    (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY cap / weight, weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      AS here
  FROM w
), f AS (
  SELECT (SELECT here FROM l WHERE here <= ratio ORDER BY ratio, weight, rank LIMIT 1) AS level
), t AS (
  SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM l, f
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS repeats FROM t
), c AS (
  SELECT h.*, source_size, target, repeats, target - repeats * source_size AS rest,
    sum(size) OVER (PARTITION BY h.source ORDER BY h, doc_id, size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - sum(size) OVER (PARTITION BY h.source, h, doc_id, size) AS before,
    row_number() OVER (PARTITION BY h.source, h, doc_id, size) AS peer
  FROM h JOIN q ON h.source IS NOT DISTINCT FROM q.source
), k AS (
  SELECT *, repeats + CASE WHEN rest > 0 AND CASE WHEN size > 0
    THEN peer <= floor((2 * (rest - before) + size) / (2 * size)) ELSE before <= rest END THEN 1 ELSE 0 END AS copies
  FROM c
)
SELECT doc_id, source, size, source_size, target, copies::BIGINT AS copies, (copies * size)::BIGINT AS taken
FROM k
"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w
), n AS MATERIALIZED (
  SELECT w.doc_id, count(g.s) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY w.doc_id
), o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT a, b, o = x.n AND o = y.n AS equal_sets
  FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)
), e AS MATERIALIZED (
  SELECT a, b, equal_sets FROM links UNION SELECT b, a, equal_sets FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN e ON r.other = e.a
)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, least(n.doc_id, l.copy_id)::BIGINT AS class_id,
  r.component_id, coalesce(l.n_links, 0)::BIGINT AS n_links
FROM n JOIN (SELECT doc_id, min(other)::BIGINT AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
LEFT JOIN (SELECT a, count(*) AS n_links, min(b) FILTER (WHERE equal_sets) AS copy_id FROM e GROUP BY a) l ON l.a = n.doc_id
"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


_PLAIN = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CHANGED = " || ".join([*[_field(c) for c in ("doc_id", "source", "lang", "n_chars")], _field(_LOWER)])
# CRC-32, bit by bit (the reflected polynomial 0xEDB88320).
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
      lambda r, b: list_reduce(list_concat([xor(r, b)], range(8)),
        lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _tree(name: str, items: str) -> str:
    """The nodes of the trees over items (gid, n, pos, h), level by level."""
    return f"""{name} AS (
  SELECT gid, 0 AS lvl, n, pos, h FROM {items}
  UNION ALL
  SELECT gid, lvl + 1, (n + 7) // 8, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY gid, lvl, n, pos // 8
), {name}_runs AS (
  SELECT gid, lvl, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM {name} WHERE n > 1 GROUP BY gid, lvl, pos // 8
), {name}_sides AS (
  SELECT t.gid, t.lvl, t.pos, array_to_string(hs[1 : t.pos % 8], '') AS pre, array_to_string(hs[t.pos % 8 + 2 : 8], '') AS post
  FROM {name} t JOIN {name}_runs r ON t.gid = r.gid AND t.lvl = r.lvl AND t.pos // 8 = r.run
)"""


MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS gid, sha256({_PLAIN}) AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN sha256({_CHANGED}) ELSE sha256({_PLAIN}) END AS start
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER () AS id, leaf AS h, count(*) OVER (PARTITION BY gid) AS n,
    row_number() OVER (PARTITION BY gid ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM d
), {_tree("low", "leaves")}, subroots AS (
  SELECT 0 AS gid, count(*) OVER () AS n, gid AS pos, h FROM low WHERE n = 1
), {_tree("top", "subroots")}, path AS (
  SELECT l.id, s.lvl AS step, s.pre, s.post FROM leaves l JOIN low_sides s ON s.gid = l.gid AND s.pos = l.pos >> (3 * s.lvl)
  UNION ALL
  SELECT l.id, 100 + s.lvl, s.pre, s.post FROM leaves l JOIN top_sides s ON s.pos = l.gid >> (3 * s.lvl)
), steps AS MATERIALIZED (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY step) AS step, pre, post FROM path
), proofs AS (
  SELECT id, string_agg(pre || post, '' ORDER BY step) AS proof FROM steps GROUP BY id
), climb AS (
  SELECT id, 0::BIGINT AS step, start AS f FROM leaves
  UNION ALL
  SELECT c.id, s.step, sha256(s.pre || c.f || s.post) FROM climb c JOIN steps s ON s.id = c.id AND s.step = c.step + 1
), ends AS (
  SELECT id, arg_max(f, step) AS folded FROM climb GROUP BY id
), r AS (SELECT h AS root FROM top WHERE n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.root, sha256(coalesce(p.proof, '')) AS proof_sha256,
  e.folded AS folded_root, e.folded = r.root AS verified
FROM leaves l JOIN subroots s ON s.pos = l.gid JOIN ends e ON e.id = l.id LEFT JOIN proofs p ON p.id = l.id CROSS JOIN r
"""
