"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

ORACLES = {
    "op2_chat": """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(replace(replace(role, '<|', '<||'), chr(10), '<|n')) + 1
    + length(replace(text, '<|', '<||')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id""",
    "op10_topk": """
WITH parts AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))),
whole AS (SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM parts),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op7_licenses": """
WITH phrases(label, phrase) AS (VALUES ('gpl', 'gnu general public license'), ('apache', 'apache license'),
  ('cc-by', 'cc by'), ('mit', 'mit license')),
templates(label, words) AS (VALUES
  ('gpl-notice', 'this work is licensed under the gnu general public license version 3'),
  ('gpl-notice', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation'),
  ('apache-notice', 'licensed under the apache license version 2 0'),
  ('apache-notice', 'you may not use this file except in compliance with the license'),
  ('cc-by-nc-notice', 'licensed under cc by nc 4 0'),
  ('mit-notice', 'released under the mit license'),
  ('mit-notice', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction')),
docs AS (
  SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
words AS (SELECT row, doc_id, low,
  regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs),
places AS (
  SELECT row, label, unnest(list_filter(range(len(w)), lambda i: array_to_string(
    w[i + 1:i + len(string_split(phrase, ' '))], ' ') = phrase)) AS start
  FROM words, phrases WHERE contains(' ' || array_to_string(w, ' ') || ' ', ' ' || phrase || ' ')),
base AS (SELECT row, count(*) AS n, min(start) AS first, max(start) AS last,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY row),
blocks AS (
  SELECT row, list_distinct(regexp_extract_all(b, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT row, unnest(regexp_split_to_array(low, '[\r\n]+')) AS b FROM words
    UNION ALL SELECT row, p FROM (SELECT row, unnest(regexp_split_to_array(replace(replace(low, chr(13) || chr(10), chr(10)),
      chr(13), chr(10)), '\n[ \t]*\n')) AS p FROM words) WHERE contains(p, chr(10)) AND length(p) <= 2000)),
hits AS (
  SELECT row, label, len(list_intersect(w, t)) / len(t) AS score
  FROM blocks, (SELECT label, list_distinct(string_split(words, ' ')) AS t FROM templates)
  WHERE len(w) > 0 AND len(list_intersect(w, t)) >= ceil(0.8 * len(t))),
every AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT row, label FROM places UNION ALL SELECT row, label FROM hits) GROUP BY row),
best AS (SELECT row, max(score) AS score FROM hits GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base, base.first AS first_word,
  base.last AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.score, 0.0)::DOUBLE END AS score
FROM words LEFT JOIN base USING (row) LEFT JOIN every USING (row) LEFT JOIN best USING (row)""",
    "op1_substring": """
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT row, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - 11, 1))) AS t(i)),
earliest AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (SELECT DISTINCT row, i + j AS i FROM windows JOIN earliest USING (s), range(13) AS r(j) WHERE first < doc_id),
words AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (row, i) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)""",
    "op12_middle": r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
numbers AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM docs),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
      THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (
  SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle,
    array_to_string(w[b + 1:n], '') AS suffix FROM cuts)
SELECT doc_id, n, form,
  CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts""",
}
