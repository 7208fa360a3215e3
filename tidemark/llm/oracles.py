"""SQL for the operators that SQL can express."""

from __future__ import annotations

from tidemark.llm.licenses import PHRASES as LICENSE_PHRASES
from tidemark.llm.licenses import TEMPLATES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH rows AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(COALESCE(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT row, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM rows),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM each),
repeated AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING COUNT(DISTINCT row) >= 10),
kept AS (
  SELECT row, COUNT(*) AS n, string_agg(line, chr(10) ORDER BY place) AS text
  FROM keyed WHERE key NOT IN (SELECT key FROM repeated) GROUP BY row)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - COALESCE(n, 0) AS BIGINT) AS n_dropped,
       sha256(COALESCE(kept.text, '')) AS kept_sha256
FROM rows LEFT JOIN kept USING (row)"""

_WORDS = "regexp_extract_all(" + _LOWER.format("COALESCE(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = f"""
WITH items AS (SELECT COALESCE(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS words FROM benchmark),
sized AS (SELECT *, LEAST(len(words), 13) AS size FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, size, unnest(list_transform(
           range(1, len(words) - size + 2), lambda i: array_to_string(words[i : i + size - 1], ' '))) AS said
  FROM sized),
rows AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
starts AS (
  SELECT row, size, unnest(range(1, len(words) - size + 2)) AS start,
         unnest(list_transform(
           range(1, len(words) - size + 2), lambda i: array_to_string(words[i : i + size - 1], ' '))) AS said
  FROM rows, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size),
found AS (SELECT row, start, size, item FROM starts JOIN windows USING (size, said)),
hit AS (
  SELECT row, COUNT(DISTINCT place) AS n FROM (SELECT row, unnest(range(start, start + size)) AS place FROM found) GROUP BY 1),
named AS (
  SELECT row, COUNT(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(COALESCE(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(named.n, 0) AS BIGINT) AS n_items, sha256(COALESCE(items, '')) AS items_sha256,
       COALESCE(hit.n, 0) > 0 AND 20 * COALESCE(hit.n, 0) >= len(words) AS contaminated
FROM rows LEFT JOIN hit USING (row) LEFT JOIN named USING (row)"""

_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"
_ROLE = _ESCAPED.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")

CHATS = f"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
whole AS (
  SELECT conv_id, COUNT(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
         SUM(length('<|im_start|>' || {_ROLE} || chr(10) || {_ESCAPED.format("text")} || '<|im_end|>' || chr(10)))
           AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM whole"""

VECTORS = """
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (
  SELECT vec_id AS x, vec_id AS y FROM vectors
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT x AS vec_id, (SELECT COUNT(*) FROM links l WHERE l.x = r.x) AS n_links, MIN(y) AS component_id,
       x = MIN(y) AS kept
FROM reached r GROUP BY x"""

_SPACED = "regexp_extract_all(" + _LOWER.format("COALESCE(text, '')") + r", '[^\x20\x09-\x0D]+')"

NEAR_TEXTS = f"""
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS row, doc_id, {_SPACED} AS words FROM documents),
sets AS (
  SELECT row, doc_id, list_distinct(CASE
           WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) END) AS shingles
  FROM rows),
each AS (SELECT row, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
shared AS (
  SELECT a.row AS x, b.row AS y, a.n + b.n AS sizes, COUNT(*) AS common
  FROM each a JOIN each b ON a.shingle = b.shingle AND a.row <> b.row GROUP BY 1, 2, 3),
links AS (SELECT x, y FROM shared WHERE 100 * common >= 80 * (sizes - common)),
reached AS (
  SELECT row AS x, row AS y FROM sets
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT a.doc_id, CAST(len(a.shingles) AS BIGINT) AS n_shingles, MIN(b.doc_id) AS component_id
FROM reached r JOIN sets a ON a.row = r.x JOIN sets b ON b.row = r.y GROUP BY a.row, a.doc_id, a.shingles"""


def _field(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN '-' "
        f"ELSE octet_length(encode(CAST({column} AS VARCHAR))) || ':' || CAST({column} AS VARCHAR) END"
    )


def _leaf(count: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", count, "text")) + ")"


# CRC-32 bit by bit: each byte of the decimal id is followed by eight shifts (-1).
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""

_ABOVE = """list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || COALESCE(nodes[i + 2], '')))"""
_SIBLING = "COALESCE(nodes[xor(i, 1) + 1], '')"

MANIFEST = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row, doc_id, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND ({_CRC32}) % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS said
  FROM documents),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM rows),
levels AS (
  SELECT tree, 0 AS level, list(leaf ORDER BY i) AS nodes FROM placed GROUP BY tree
  UNION ALL SELECT tree, level + 1, {_ABOVE} FROM levels WHERE len(nodes) > 1),
tops AS (SELECT tree, level, nodes[1] AS subroot FROM levels WHERE len(nodes) = 1),
crown AS (
  SELECT 0 AS level, list(subroot ORDER BY tree) AS nodes FROM tops
  UNION ALL SELECT level + 1, {_ABOVE} FROM crown WHERE len(nodes) > 1),
climb AS (
  SELECT row, tree, CAST(0 AS BIGINT) AS level, i, said AS x, '' AS proof FROM placed
  UNION ALL
  SELECT row, c.tree, c.level + 1, i // 2,
         sha256(CASE WHEN i % 2 = 1 THEN {_SIBLING} || x ELSE x || {_SIBLING} END), proof || {_SIBLING}
  FROM climb c JOIN levels l ON l.tree = c.tree AND l.level = c.level WHERE len(nodes) > 1),
over AS (
  SELECT row, CAST(0 AS BIGINT) AS level, c.tree AS i, x, proof FROM climb c JOIN tops USING (tree, level)
  UNION ALL
  SELECT row, c.level + 1, i // 2,
         sha256(CASE WHEN i % 2 = 1 THEN {_SIBLING} || x ELSE x || {_SIBLING} END), proof || {_SIBLING}
  FROM over c JOIN crown l ON l.level = c.level WHERE len(nodes) > 1)
SELECT doc_id, leaf, subroot, nodes[1] AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = nodes[1] AS verified
FROM placed JOIN over USING (row) JOIN crown ON crown.level = over.level AND len(nodes) = 1
JOIN tops USING (tree)"""


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


LICENSES = f"""
WITH templates AS (
  SELECT id, label, share, {_WORDS} AS words
  FROM ({_values((i, *t) for i, t in enumerate(TEMPLATES))}) AS t(id, label, text, share)),
sets AS (
  SELECT id, label, len(words) AS size, len(list_distinct(words)) AS m, list_distinct(words) AS words,
         CAST(ceil(share * len(list_distinct(words)) - 1e-9) AS BIGINT) AS needed FROM templates),
phrases AS (SELECT label, {_WORDS} AS said FROM ({_values(LICENSE_PHRASES)}) AS t(label, text)),
rows AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
each AS (SELECT row, unnest(words) AS word, unnest(range(len(words))) AS place, len(words) AS n FROM rows),
hits AS (
  SELECT row, id, place, n, word, size, m, needed
  FROM each JOIN (SELECT *, unnest(words) AS word FROM sets) USING (word)),
possible AS (
  SELECT row, id FROM hits GROUP BY row, id HAVING COUNT(DISTINCT word) >= any_value(needed)),
starts AS (
  SELECT row, id, word, m, needed, unnest(range(
           greatest(0, place - least(size, n) + 1), least(place, n - least(size, n)) + 1)) AS start
  FROM hits JOIN possible USING (row, id)),
held AS (
  SELECT row, id, start, COUNT(DISTINCT word) / any_value(m) AS share
  FROM starts GROUP BY row, id, start HAVING COUNT(DISTINCT word) >= any_value(needed)),
found AS (SELECT DISTINCT row, label, MAX(share) OVER (PARTITION BY row) AS share FROM held JOIN sets USING (id)),
base AS (
  SELECT row, label, place FROM each JOIN rows USING (row), phrases
  WHERE word = said[1] AND words[place + 1 : place + len(said)] = said),
based AS (
  SELECT row, COUNT(*) AS n, MIN(place) AS low, MAX(place) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM base GROUP BY row),
named AS (
  SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, MAX(share) AS share
  FROM (SELECT row, label, share FROM found UNION ALL SELECT row, label, 1.0 FROM base) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(based.n, 0) AS n_base, low AS first_word, high AS last_word,
       COALESCE(based.labels, '') AS base_labels, COALESCE(named.labels, '') AS labels,
       CAST(COALESCE(share, 0) AS DOUBLE) AS score
FROM rows LEFT JOIN based USING (row) LEFT JOIN named USING (row)"""

_PIECES = "string_split_regex(" + _LOWER.format("COALESCE(text, '')") + r", '[.,;:!?\x0A-\x0D]')"

PHRASES = f"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, regexp_extract_all(unnest({_PIECES}), '[^\\x20\\x09]+') AS words FROM documents),
totals AS (SELECT lang, SUM(len(words)) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i : i + k - 1], ' '))) AS phrase
  FROM pieces, (SELECT unnest(range(1, 5)) AS k) WHERE len(words) >= k),
f AS (SELECT lang, k, phrase, COUNT(*) AS n, string_split(phrase, ' ') AS words FROM grams GROUP BY ALL HAVING COUNT(*) >= 30),
cuts AS (
  SELECT lang, phrase, n, c, array_to_string(words[1 : c], ' ') AS x, array_to_string(words[c + 1 :], ' ') AS y
  FROM f, (SELECT unnest(range(1, 4)) AS c) WHERE c < k),
weighed AS (
  SELECT cuts.lang, cuts.phrase, cuts.n AS a, c, x.n AS l, y.n AS r,
         CAST(CAST(2000000 AS HUGEINT) * cuts.n // (x.n + y.n) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y),
worst AS (SELECT * FROM weighed QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
parts AS (
  SELECT f.lang, array_to_string(words[i : i + size - 1], ' ') AS phrase, MAX(n) AS n
  FROM f, (SELECT unnest(range(2, 4)) AS size) s, (SELECT unnest(range(1, 4)) AS i) t
  WHERE size < k AND i + size - 1 <= k GROUP BY 1, 2),
kept AS (
  SELECT worst.* FROM worst LEFT JOIN parts ON parts.lang = worst.lang AND parts.phrase = worst.phrase
  WHERE parts.n IS NULL OR CAST(100 AS HUGEINT) * parts.n < CAST(80 AS HUGEINT) * a),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS place FROM kept)
SELECT lang, CAST(place AS BIGINT) AS rank, phrase, a, l, r, CAST(totals.n AS BIGINT) AS n, score
FROM placed JOIN totals USING (lang) WHERE place <= 2000"""
