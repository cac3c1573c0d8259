"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

OP9 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), lines AS (
  SELECT rid, x, count(*) AS n
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY rid, x
), dup_lines AS (
  SELECT rid, sum(n - 1) AS n_dup_lines FROM lines GROUP BY rid
), starts AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM starts) WHERE n > 1
), repeats AS (
  SELECT rid, count(*) AS n_repeat_words
  FROM (SELECT DISTINCT rid, i + k AS p FROM twice, (SELECT unnest(range(0, 5)) AS k)) GROUP BY rid
), m AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN dup_lines USING (rid) LEFT JOIN repeats USING (rid)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > 3 * n_words) AND NOT (word_chars > 60 * n_words)
    AND NOT (10 * n_dup_lines > 5 * len(string_split(text, chr(10)))) AS kept
FROM b
"""


OP4 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents
), starts AS (
  SELECT rid, doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM starts) WHERE first < doc_id
), gone AS (
  SELECT DISTINCT rid, i + k AS p FROM repeated, (SELECT unnest(range(0, 50)) AS k)
), words AS (
  SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT rid, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

OP6 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT rid, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), held AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), kept AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY p) AS t, count(*) AS n
  FROM keyed LEFT JOIN held USING (key) WHERE first IS NULL OR first = doc_id GROUP BY rid
)
SELECT doc_id, len(l)::BIGINT AS n_lines, (len(l) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

LOWER_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP8 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {LOWER_WORDS} AS w FROM documents
), items AS (
  SELECT item_id, {LOWER_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS g, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), starts AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
  SELECT rid, i, n, item_id FROM starts JOIN windows USING (g, n)
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid
), which AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list(DISTINCT item_id::VARCHAR) FILTER (WHERE item_id IS NOT NULL)), ',') AS ids FROM found GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN which USING (rid)
"""

OP11 = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM d
), said AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS c FROM said GROUP BY ALL HAVING count(*) >= 30
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2
), cuts AS (
  SELECT lang, phrase, k, a, w, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)
), scored AS (
  SELECT x.lang, x.phrase, x.a, x.j, l.c AS l, r.c AS r, ((2000000::HUGEINT * x.a) // (l.c + r.c))::BIGINT AS score
  FROM cuts AS x JOIN f AS l ON l.lang = x.lang AND l.phrase = x.head AND l.k = x.j JOIN f AS r ON r.lang = x.lang AND r.phrase = x.rest AND r.k = x.k - x.j
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM scored) WHERE o = 1
), inside AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS part
    FROM candidates, (SELECT unnest(range(2, 4)) AS m) WHERE m < k) GROUP BY ALL
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.part = lowest.phrase WHERE most IS NULL OR 100 * most < 80 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

CRC_OF_ID = """
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda y, k: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT)
"""

OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w, CASE WHEN doc_id IS NOT NULL THEN {CRC_OF_ID} END AS h FROM documents
), shaped AS (
  SELECT rid, doc_id, w, len(w)::BIGINT AS n, coalesce(h % 10 = 0 AND len(w) > 0, false) AS again,
    CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS f FROM d
), p AS (
  SELECT rid, doc_id, n, CASE WHEN again
    THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // f) END]) ELSE w END AS w
  FROM shaped
), starts AS (
  SELECT rid, i, array_to_string(w[i + 1:i + 6], ' ') AS g FROM (SELECT rid, w, unnest(range(0, n - 5)) AS i FROM p WHERE n >= 12)
), numbered AS (
  SELECT rid, i, min(i) OVER (PARTITION BY rid, g) AS g, count(*) OVER (PARTITION BY rid, g) AS c FROM starts
), pairs AS (
  SELECT x.rid, x.i, y.i - x.i AS q FROM (SELECT * FROM numbered WHERE c > 1) AS x JOIN (SELECT * FROM numbered WHERE c > 1) AS y USING (rid, g) WHERE x.i < y.i
), diagonals AS (
  SELECT rid, q, min(i) AS s, count(*) + 5 + q AS m FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM pairs) GROUP BY rid, q, k
), runs AS (
  SELECT rid, s, m, min(q) AS q FROM diagonals WHERE m >= greatest(12, 2 * q) GROUP BY rid, s, m
), listed AS (
  SELECT rid, count(*)::BIGINT AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY rid
), best AS (
  SELECT rid, s, m, q FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY m DESC, s, q) AS k FROM runs) WHERE k = 1
), gone AS (
  SELECT DISTINCT rid, unnest(range(s + q, s + m)) AS i FROM runs
), words AS (
  SELECT rid, unnest(w) AS x, unnest(range(0, n)) AS i FROM p
), kept AS (
  SELECT rid, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, m::BIGINT AS length, q::BIGINT AS period, (1000 * m // q)::BIGINT AS exponent_milli,
  sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM p LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)
"""

OP13 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents
), starts AS (
  SELECT rid, i, md5(b[i:i + 399]) AS g FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 398)) AS i FROM d WHERE octet_length(b) >= 400)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS c FROM starts) WHERE c > 1
), marked AS (
  SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM repeated
), runs AS (
  SELECT rid, min(i) AS s, max(i) + 399 AS e FROM (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS k FROM marked) GROUP BY rid, k
), pieces AS (
  SELECT rid, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS a, s AS z FROM runs
  UNION ALL SELECT rid, coalesce(max(e), 0), octet_length(any_value(b)) + 1 FROM d LEFT JOIN runs USING (rid) GROUP BY rid
), kept AS (
  SELECT rid, list_reduce(list(b[a + 1:z - 1] ORDER BY a), lambda x, y: x || y) AS t FROM (SELECT * FROM pieces WHERE z > a + 1) JOIN d USING (rid) GROUP BY rid
), spans AS (
  SELECT rid, count(*)::BIGINT AS n_spans, sum(e - s + 1)::BIGINT AS n_removed FROM runs GROUP BY rid
)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(coalesce(t, ''::BLOB)) AS kept_sha256
FROM d LEFT JOIN spans USING (rid) LEFT JOIN kept USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_substring_dedup": OP4,
        "op6_line_dedup": OP6,
        "op8_decontaminate": OP8,
        "op9_quality_rules": OP9,
        "op11_collocations": OP11,
        "op12_periodic_runs": OP12,
        "op13_suffix_dedup": OP13,
    }
