"""DuckDB SQL over the same tables for the corpus queries that SQL can express."""

from __future__ import annotations

#: CRC-32, byte by byte, over a table made from the reversed polynomial.
_CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    WITH RECURSIVE steps(n, k, c) AS (
      SELECT n, 0, n FROM range(256) r(n)
      UNION ALL
      SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END
      FROM steps WHERE k < 8)
    SELECT n, c FROM steps WHERE k = 8))
"""


def _crc_of(text: str) -> str:
    return f"""xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT,
      list_transform(range(1, 2 * strlen({text}), 2),
        lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


_CRC = f"""{_CRC_TABLE},
crc AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN 0 ELSE {_crc_of("text")} END AS text_crc32
  FROM documents, crc_table)
"""

#: The chat template's escapes: a bar more after each "<|" of a text; roles keep to one line.
_ESCAPED_TEXT = "replace(text, '<|', '<||')"
_ESCAPED_ROLE = r"replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '<|', '<||')"

ORACLES: dict[str, str] = {
    "op1_sharding": f"""
WITH {_CRC},
sized AS (SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, text_crc32 FROM crc),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER () AS total FROM sized),
placed AS (
  SELECT *, least(7, ((2 * upto - size) * 8) // (2 * total))::INT AS shard FROM summed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot,
       CAST(NULL AS INT) AS grown_shard
FROM placed
""",
    "op6_prefix_target_chat": f"""
WITH all_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
placed AS (
  SELECT *, row_number() OVER w AS nth, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length('<|im_start|>' || {_ESCAPED_ROLE} || chr(10) || {_ESCAPED_TEXT}
             || '<|im_end|>' || chr(10))) OVER w AS chars
  FROM all_turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(chars) FILTER (role = 'assistant' OR nth = n)::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant' OR nth = n) AS n_examples
FROM placed GROUP BY conv_id
""",
    "op2_host_rules": r"""
WITH words AS (
  SELECT doc_id, w, i FROM (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents))),
windows AS (
  SELECT doc_id, i, [w, lead(w, 1) OVER d, lead(w, 2) OVER d, lead(w, 3) OVER d, lead(w, 4) OVER d] AS g,
         lead(i, 4) OVER d AS full_window
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows
    WHERE full_window IS NOT NULL) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n, sum(length(w)) AS chars FROM words GROUP BY doc_id),
lines AS (
  SELECT doc_id, sum(n - 1) AS n, sum(n) AS n_lines FROM (
    SELECT doc_id, line, count(*) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line)
  GROUP BY doc_id),
facts AS (
  SELECT d.doc_id, d.source, coalesce(c.n, 0) AS n_words, coalesce(c.chars, 0) AS word_chars,
         coalesce(len(regexp_extract_all(d.text, '[#*$%&|<>]')), 0) AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words,
         coalesce(l.n_lines, 0) AS n_lines
  FROM documents d LEFT JOIN counted c USING (doc_id) LEFT JOIN lines l USING (doc_id)
  LEFT JOIN covered v USING (doc_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         base_failed OR n_symbols > word_chars / 10
           OR 10 * n_dup_lines > 3 * greatest(n_lines, n_words / 10) AS failed
  FROM facts),
counts AS (
  SELECT source, count(*) AS host_docs, count(*) FILTER (failed) AS failures
  FROM judged WHERE source IS NOT NULL GROUP BY source),
moments AS (
  SELECT avg(failures / host_docs) AS m, var_samp(failures / host_docs) AS v FROM counts),
prior AS (
  SELECT CASE WHEN v > 1e-9 AND v < m * (1 - m) THEN m ELSE 0.5 END AS m,
         CASE WHEN v > 1e-9 AND v < m * (1 - m) THEN m * (1 - m) / v - 1 ELSE 2.0 END AS w
  FROM moments),
rates AS (
  SELECT source, host_docs, round((failures + m * w) / (host_docs + w), 6) AS host_rate
  FROM counts, prior)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines, base_failed,
       NOT base_failed AND coalesce(host_rate <= 0.5, true) AS kept, failed, host_docs, host_rate
FROM judged LEFT JOIN rates USING (source)
""",
    "op4_pii_checksums": r"""
WITH
email AS (
  SELECT doc_id, 'email' AS kind, 0 AS kind_no, value,
         (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0))::INT AS start
  FROM (
    SELECT doc_id, gaps, found, unnest(found) AS value, generate_subscripts(found, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS found,
                 regexp_split_to_array(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS gaps FROM documents))
  WHERE true),
ip AS (
  SELECT doc_id, 'ip' AS kind, 1 AS kind_no, value,
         (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0))::INT AS start
  FROM (
    SELECT doc_id, gaps, found, unnest(found) AS value, generate_subscripts(found, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') AS found,
                 regexp_split_to_array(text, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') AS gaps FROM documents))
  WHERE list_max(list_transform(string_split(value, '.'), lambda p: p::HUGEINT)) <= 255),
card AS (
  SELECT doc_id, 'card' AS kind, 2 AS kind_no, value,
         (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0))::INT AS start
  FROM (
    SELECT doc_id, gaps, found, unnest(found) AS value, generate_subscripts(found, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '[0-9](?:[ -]?[0-9])+') AS found,
                 regexp_split_to_array(text, '[0-9](?:[ -]?[0-9])+') AS gaps FROM documents))
  WHERE length(regexp_replace(value, '[ -]', '', 'g')) BETWEEN 14 AND 19
    AND list_sum(list_transform(range(length(regexp_replace(value, '[ -]', '', 'g'))), lambda k: CASE
      WHEN k % 2 = 0 THEN (reverse(regexp_replace(value, '[ -]', '', 'g')))[k + 1]::INT
      WHEN (reverse(regexp_replace(value, '[ -]', '', 'g')))[k + 1]::INT > 4
        THEN 2 * (reverse(regexp_replace(value, '[ -]', '', 'g')))[k + 1]::INT - 9
      ELSE 2 * (reverse(regexp_replace(value, '[ -]', '', 'g')))[k + 1]::INT END)) % 10 = 0),
phone AS (
  SELECT doc_id, 'phone' AS kind, 3 AS kind_no, value,
         (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0))::INT AS start
  FROM (
    SELECT doc_id, gaps, found, unnest(found) AS value, generate_subscripts(found, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '\+[0-9][ ().0-9-]+[0-9]') AS found,
                 regexp_split_to_array(text, '\+[0-9][ ().0-9-]+[0-9]') AS gaps FROM documents))
  WHERE length(regexp_replace(value, '[^0-9]', '', 'g')) BETWEEN 10 AND 15),
iban AS (
  SELECT doc_id, 'iban' AS kind, 4 AS kind_no, value,
         (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
          + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0))::INT AS start
  FROM (
    SELECT doc_id, gaps, found, unnest(found) AS value, generate_subscripts(found, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b') AS found,
                 regexp_split_to_array(text, '\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b') AS gaps FROM documents))
  WHERE list_reduce(list_prepend(0::BIGINT, list_transform(
      string_split(substr(replace(value, ' ', ''), 5) || substr(value, 1, 4), ''),
      lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END::BIGINT)),
      lambda r, d: (r * CASE WHEN d > 9 THEN 100 ELSE 10 END + d) % 97) = 1),
spans AS (
  SELECT *, kind || ':' || start || ':' || (start + length(value)) AS span FROM (
    SELECT * FROM email UNION ALL SELECT * FROM ip UNION ALL SELECT * FROM card
    UNION ALL SELECT * FROM phone UNION ALL SELECT * FROM iban)),
by_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(span, ',' ORDER BY start, kind_no) FILTER (kind_no < 4) AS base,
         string_agg(span, ',' ORDER BY start, kind_no) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN by_doc USING (doc_id)
""",
    "op5_recompression": r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM split),
windows AS (
  SELECT doc_id, i, array_to_string(list(w) OVER (PARTITION BY doc_id ORDER BY i
           ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING), ' ') AS g, n FROM words),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth
    FROM windows WHERE i + 19 <= n) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(20) r(k)),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(len(ws), 0)::BIGINT AS n_words,
       (coalesce(len(ws), 0) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
""",
    "op11_strassen_negatives": """
WITH labelled AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings),
r AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM labelled
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
    "op12_line_bitmaps": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (last_doc IS NOT NULL AND doc_id < last_doc) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                FILTER (last_doc IS NULL OR doc_id >= last_doc), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (key) GROUP BY doc_id
""",
    "op13_fm_spelling": f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run
  FROM documents),
hashed AS (
  SELECT run, {_crc_of("doc_id || ':' || run")} AS h FROM runs, crc_table WHERE length(run) >= 7),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
         ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, count(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
less AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)),
near AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n
  FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
  FROM near GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
followed AS (
  SELECT word, word AS reached, form AS onward FROM formed
  UNION ALL
  SELECT f.word, f.onward, g.form FROM followed f JOIN formed g ON f.onward = g.word)
SELECT word, form, reached AS root, n, n_near, form_n::BIGINT AS form_n
FROM followed JOIN formed USING (word) WHERE onward IS NULL
""",
}
