"""SQL that checks the queries of this package, for another engine.

``CRC`` is a table of one row with the 256 steps of CRC-32 a byte; a list of bytes is reduced with it.
"""

from __future__ import annotations

CRC = """
  bytes_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps)"""

RESAMPLING = f"""
WITH {CRC},
texts AS (
  SELECT row_number() OVER () AS row, true AS corpus, doc_id, text FROM documents
  UNION ALL SELECT -row_number() OVER (), false, NULL, text FROM benchmark),
words AS (
  SELECT row, corpus, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
spans AS (
  SELECT row, corpus, array_to_string(words[start:start + size - 1], ' ') AS feature
  FROM (SELECT row, corpus, words, unnest(range(1, len(words) + 1)) AS start FROM words), (SELECT unnest([1, 2, 3]) AS size)
  WHERE start + size - 1 <= len(words)),
features AS (SELECT row, corpus, feature, count(*) AS n FROM spans GROUP BY 1, 2, 3),
hashed AS (
  SELECT feature, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(feature)), '..'),
      lambda x: cast('0x' || x AS bigint))), lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM features), bytes_table),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE corpus), 0) AS s, coalesce(sum(n) FILTER (WHERE NOT corpus), 0) AS t
  FROM features JOIN hashed USING (feature) GROUP BY 1),
gains AS (
  SELECT bucket, cast(floor(1000 * ln(cast(t + 1 AS double) * cast((SELECT sum(s) FROM counts) + 10000 AS double)
      / (cast(s + 1 AS double) * cast((SELECT sum(t) FROM counts) + 10000 AS double)))) AS bigint) AS gain FROM counts),
weights AS (SELECT row, sum(n * gain) AS weight FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE corpus GROUP BY 1),
scored AS (
  SELECT row, doc_id, len(words) AS size, coalesce(weight, 0) AS weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
      (cast('0x' || substr(sha256('42:' || coalesce(cast(doc_id AS varchar), '')), 1, 8) AS bigint) + 0.5) / 4294967296))) AS bigint) AS score
  FROM words LEFT JOIN weights USING (row) WHERE corpus),
ranked AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS able FROM scored WHERE size >= 20)
SELECT doc_id, cast(size + greatest(size - 1, 0) + greatest(size - 2, 0) AS bigint) AS n_features, cast(weight AS bigint) AS weight,
       cast(score AS bigint) AS score, CASE WHEN place <= 5 * able // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (row)
"""

PERIODIC = f"""
WITH {CRC},
docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id AS varchar), ''), lambda x: cast(ascii(x) AS bigint))),
             lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1]))) AS h
  FROM documents, bytes_table),
planned AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN a END AS first, 1 + (n - a) // (3 + g % 8) AS p
  FROM (SELECT *, g % greatest(n, 1) AS a FROM (SELECT *, len(words) AS n, h // 10 AS g FROM docs))),
tokens AS (
  SELECT row, n, i, words[CASE WHEN i >= first THEN first + (i - first) % p ELSE i END + 1] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM planned)),
equal AS (
  SELECT x.row, y.i - x.i AS q, x.i FROM tokens x JOIN tokens y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS run FROM equal)
  GROUP BY row, q, run HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT row, start, length, min(q) AS period FROM stretches GROUP BY row, start, length),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY 1),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY row ORDER BY cast(length AS double) / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM tokens ANTI JOIN gone USING (row, i) GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (row) LEFT JOIN best USING (row) LEFT JOIN kept USING (row)
"""

LANGUAGE = f"""
WITH {CRC},
docs AS (
  SELECT row_number() OVER () AS row, doc_id, lang, lower(coalesce(text, '')) AS low,
         coalesce(xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id AS varchar), ''), lambda x: cast(ascii(x) AS bigint))),
             lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1]))) % 5 = 0, false) AS held
  FROM documents, bytes_table),
words AS (
  SELECT row, word, count(*) AS n
  FROM (SELECT row, ' ' || unnest(regexp_extract_all(low, '\\p{{L}}[\\p{{L}}\\p{{M}}]*')) || ' ' AS word FROM docs) GROUP BY 1, 2),
grams AS (
  SELECT row, gram, sum(n) AS n
  FROM (SELECT row, n, substr(word, start, size) AS gram
        FROM (SELECT row, word, n, unnest(range(1, length(word) + 1)) AS start FROM words), (SELECT unnest([1, 2, 3]) AS size)
        WHERE start + size - 1 <= length(word))
  WHERE gram <> ' ' GROUP BY 1, 2),
coded AS (
  SELECT row, gram, n, CASE length(gram) WHEN 1 THEN unicode(gram) WHEN 2 THEN cast(unicode(gram) AS bigint) * 2097152 + unicode(gram[2])
      ELSE (cast(unicode(gram) AS bigint) * 2097152 + unicode(gram[2])) * 2097152 + unicode(gram[3]) END AS code
  FROM grams WHERE NOT (length(gram) = 3 AND gram[2] = ' ')),
profiles AS (
  SELECT lang, gram, place FROM (
    SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, code) - 1 AS place
    FROM coded JOIN docs USING (row) WHERE NOT held AND doc_id IS NOT NULL AND lang IS NOT NULL GROUP BY lang, gram, code)
  WHERE place < 400),
own AS (
  SELECT row, gram, place FROM (SELECT row, gram, row_number() OVER (PARTITION BY row ORDER BY n DESC, code) - 1 AS place FROM coded)
  WHERE place < 400),
apart AS (
  SELECT o.row, l.lang, sum(CASE WHEN p.place IS NULL THEN 400 ELSE abs(p.place - o.place) END) AS distance, count(*) AS listed
  FROM own o CROSS JOIN (SELECT DISTINCT lang FROM profiles) l LEFT JOIN profiles p ON p.lang = l.lang AND p.gram = o.gram
  GROUP BY 1, 2),
best AS (SELECT row, arg_min(lang, (distance, lang)) AS lang, min(distance) AS distance, any_value(listed) AS listed FROM apart GROUP BY 1)
SELECT doc_id, held AS held_out, coalesce(b.lang, 'und') AS lang_pred,
       CASE WHEN b.lang IS NULL THEN 0.0 ELSE 1 - cast(distance AS double) / cast(400 * listed AS double) END AS score
FROM docs LEFT JOIN best b USING (row)
"""
