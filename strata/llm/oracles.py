"""SQL that must give the rows of a corpus query, for those that SQL can express."""

from __future__ import annotations

from strata.llm.quality_rules import FURNITURE, MENU, SEPARATOR, SPACE, SYMBOLS

# Windows of 100 bytes, as 200 hexadecimal digits, that are not the first of their kind.
OP1 = """
    WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    places AS (
        SELECT doc_id, x, unnest(range(greatest(len(x) // 2 - 99, 0))) AS i FROM bytes
    ),
    windows AS (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS s FROM places),
    firsts AS (SELECT s, min({'d': doc_id, 'i': i}) AS f FROM windows GROUP BY s),
    repeated AS (
        SELECT w.doc_id, w.i FROM windows w JOIN firsts USING (s)
        WHERE f.d <> w.doc_id OR f.i <> w.i
    ),
    marked AS (
        SELECT *, i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 100 AS opens
        FROM repeated
    ),
    numbered AS (
        SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM marked
    ),
    spans AS (SELECT doc_id, n, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY ALL),
    gaps AS (
        SELECT doc_id, n, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY n) AS a, a AS b FROM spans
        UNION ALL
        SELECT doc_id, 1e9, max(b), NULL FROM spans GROUP BY doc_id
        UNION ALL
        SELECT doc_id, 0, 0, NULL FROM bytes WHERE doc_id NOT IN (SELECT doc_id FROM spans)
    ),
    kept AS (
        SELECT doc_id, string_agg(substr(x, 2 * a + 1, 2 * (coalesce(b, len(x) // 2) - a)), '' ORDER BY n) AS k
        FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
    )
    SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, ((len(x) - len(k)) // 2)::BIGINT AS n_removed,
           (SELECT count(*) FROM spans s WHERE s.doc_id = kept.doc_id) AS n_spans,
           sha256(unhex(k)) AS kept_sha256
    FROM kept JOIN bytes USING (doc_id)
"""

OP7 = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    sets AS (
        SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                   ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END)) AS s
        FROM words
    ),
    classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
    parts AS (SELECT rep, n, unnest(s) AS shingle FROM classes),
    links AS (
        SELECT x.rep AS a, y.rep AS b
        FROM parts x JOIN parts y ON x.shingle = y.shingle AND x.rep < y.rep
        GROUP BY x.rep, y.rep, x.n, y.n
        HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
    ),
    sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reached AS (
        SELECT rep AS a, rep AS b FROM classes
        UNION
        SELECT r.a, l.b FROM reached r JOIN sides l ON l.a = r.b
    ),
    least AS (SELECT a AS rep, min(b) AS component FROM reached GROUP BY a)
    SELECT t.doc_id, len(t.s)::BIGINT AS n_shingles, coalesce(l.component, t.doc_id) AS component_id,
           t.doc_id = coalesce(l.component, t.doc_id) AS kept
    FROM sets t LEFT JOIN classes c ON c.s = t.s LEFT JOIN least l ON l.rep = c.rep
"""

# CRC-32 bit by bit over the bytes of the text, which the sizes of test tables allow.
OP8 = """
    WITH RECURSIVE steps AS (
        SELECT v, 0 AS k, v AS c FROM range(256) t(v)
        UNION ALL
        SELECT v, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
    ),
    crcs AS (SELECT list(c ORDER BY v) AS crc FROM steps WHERE k = 8),
    docs AS (
        SELECT doc_id, source, coalesce(text, '') AS t, md5(concat_ws(':', doc_id, 17)) AS drawn,
               coalesce('=' || source, '') AS stratum
        FROM documents
    ),
    sized AS (
        SELECT *, hex(encode(t)) AS x, (strlen(t) + 1)::BIGINT AS size FROM docs
    ),
    summed AS (
        SELECT *, xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(range(size - 1), lambda i:
                       (16 * (instr('0123456789ABCDEF', x[2 * i + 1]) - 1)
                           + instr('0123456789ABCDEF', x[2 * i + 2]) - 1)::BIGINT)),
                   lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
        FROM sized, crcs
    ),
    ranked AS (
        SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY drawn, doc_id, size, text_crc32) - 0.5::DOUBLE)
                  / count(*) OVER (PARTITION BY stratum) AS rank
        FROM summed
    ),
    placed AS (
        SELECT *, row_number() OVER (ORDER BY rank, stratum, drawn, doc_id, size, text_crc32) - 1 AS p,
               count(*) OVER () AS n
        FROM ranked
    ),
    cut AS (SELECT *, (p * 16 // n)::INT AS shard FROM placed)
    SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard,
           (p - (shard * n + 15) // 16)::BIGINT AS slot, NULL::INT AS grown_shard
    FROM cut
"""

OP9 = """
    WITH payloads AS (
        SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages
    ),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM payloads),
    numbers AS (
        SELECT *, list_transform(range(8), lambda g: list_reduce(
                   list_transform(range(1, 6), lambda k: instr('0123456789abcdef', x[5 * g + k]) - 1),
                   lambda a, d: 16 * a + d)) AS fives
        FROM firsts
    )
    SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
           array_to_string(list_transform(fives, lambda v: array_to_string(list_transform([15, 10, 5, 0],
               lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> k) & 31) + 1]), '')), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact
    FROM numbers
"""

OP10 = rf"""
    WITH docs AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w
        FROM documents
    ),
    places AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs),
    windows AS (SELECT doc_id, i, w[i:i + 7] AS v FROM places),
    repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, v) > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(8) r(k) GROUP BY doc_id
    ),
    lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs),
    counted AS (
        SELECT *, len(regexp_extract_all(line, '[^{SPACE}]+')) AS words,
               len(regexp_extract_all(line, '[^\p{{L}}\p{{M}}\p{{N}}{SPACE}]')) AS marks,
               len(regexp_extract_all(line, '{SEPARATOR}')) AS separators
        FROM lines
    ),
    judged AS (
        SELECT *, words > 0 AND (
                   marks > len(line) * 0.2
                   OR (words < 3 AND NOT regexp_matches(line, '\p{{P}}[{SPACE}]*$'))
                   OR separators > words * 0.3
                   OR regexp_matches(line, '(?i)^[{SPACE}]*(({MENU})[{SPACE}|/»>·•,-]*){{2,}}$')
                   OR (words <= 30 AND regexp_matches(line, '(?i)({FURNITURE})'))) AS failed
        FROM counted
    ),
    summed AS (
        SELECT doc_id, count(*) FILTER (words > 0) - count(DISTINCT line) FILTER (words > 0) AS n_dup_lines,
               count(*) FILTER (failed) AS n_lines_removed,
               coalesce(sum(words) FILTER (failed), 0)::BIGINT AS n_words_removed
        FROM judged GROUP BY doc_id
    ),
    measured AS (
        SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
               len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols, n_dup_lines,
               coalesce(n, 0)::BIGINT AS n_repeat_words, n_lines_removed, n_words_removed
        FROM docs JOIN summed USING (doc_id) LEFT JOIN covered USING (doc_id)
    ),
    based AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
    )
    SELECT *, NOT base_failed AND n_words_removed <= n_words * 0.3 AS kept FROM based
"""

OP11 = """
    WITH vectors AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scores AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
               list_dot_product(a.v, r.v)::BIGINT AS score
        FROM vectors a JOIN vectors r ON a.vec_id % 100 = 0 AND a IS DISTINCT FROM r
    ),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
           (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
"""

# CRC-32 as above; then the best way to each place of the grammar and length of the audit, row by row.
OP12 = r"""
    WITH RECURSIVE steps AS (
        SELECT v, 0 AS k, v AS c FROM range(256) t(v)
        UNION ALL
        SELECT v, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
    ),
    crcs AS (SELECT list(c ORDER BY v) AS crc FROM steps WHERE k = 8),
    rows_named AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
        FROM conversations
    ),
    kinds AS (
        SELECT *, xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(range(1, len(name) + 1), lambda i: ascii(name[i])::BIGINT)),
                   lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
        FROM rows_named, crcs
    ),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
    ),
    placed AS (
        SELECT *, row_number() OVER w AS i,
               lag(role[1]) OVER w || role[1] AS pair, regexp_extract_all(text, '[^\x20\x09-\x0D]')[-1] AS mark
        FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    ),
    judged AS (
        SELECT conv_id, turn, i, role, text, pair,
               CASE WHEN mark IS NULL THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN mark NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
        FROM placed
    ),
    faults AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
        FROM judged GROUP BY conv_id
    ),
    follows(place, initial, target) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    puts(place, target, letters, more, added) AS (
        VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
               (0, 2, 'I', 2, ['user:']), (1, 2, 'I', 2, ['user:']), (3, 2, 'I', 2, ['user:']), (2, 3, 'I', 2, ['assistant:']),
               (0, 3, 'II', 4, ['user:', 'assistant:']), (1, 3, 'II', 4, ['user:', 'assistant:']),
               (3, 3, 'II', 4, ['user:', 'assistant:']), (2, 2, 'II', 4, ['assistant:', 'user:'])
    ),
    edits AS (
        SELECT conv_id, i, place, place AS target, 'D' AS letter, 3 AS more, []::VARCHAR[] AS added
        FROM judged, range(4) p(place)
        UNION ALL
        SELECT conv_id, i, f.place, f.target, 'K', (fault = 'truncated')::INT, [role || ':' || text]
        FROM judged JOIN follows f ON f.initial = role[1] WHERE fault IN ('', 'truncated')
        UNION ALL
        SELECT conv_id, i, f.place, f.target, 'R', 2 + (fault = 'truncated')::INT,
               [CASE f.initial WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text]
        FROM judged JOIN follows f ON f.initial IN ('u', 'a') WHERE fault IN ('', 'truncated')
    ),
    ways AS (
        SELECT conv_id, 0::BIGINT AS i, 0 AS place, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM faults
        UNION ALL
        SELECT w.conv_id, e.i, e.target, w.cost + p.more + e.more, w.audit || p.letters || e.letter,
               list_concat(list_concat(w.lines, p.added), e.added)
        FROM ways w JOIN puts p ON p.place = w.place
        JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.place = p.target
        QUALIFY row_number() OVER (
            PARTITION BY w.conv_id, e.target, len(w.audit || p.letters)
            ORDER BY w.cost + p.more + e.more, w.audit || p.letters || e.letter) = 1
    ),
    ends AS (
        SELECT w.conv_id, w.cost + p.more AS cost, w.audit || p.letters AS audit, list_concat(w.lines, p.added) AS lines
        FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i
        JOIN puts p ON p.place = w.place WHERE p.target IN (0, 3)
        QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + p.more, w.audit || p.letters) = 1
    )
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
           coalesce(audit, '') AS audit, sha256(array_to_string(coalesce(lines, []), chr(10))) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
