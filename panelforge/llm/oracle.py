"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

#: The measures of the quality rules for each row of a view docs(row_id, doc_id, text).
_QUALITY_MEASURES = r"""
worded AS (
    SELECT row_id, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), windows AS (
    SELECT row_id, i, array_to_string(words[i:i + 7], ' ') AS w
    FROM (SELECT row_id, words, unnest(range(1, len(words) - 6)) AS i FROM worded)
), doubled AS (
    SELECT row_id, i, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS next_i
    FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows) WHERE n > 1
), repeated AS (
    SELECT row_id, sum(least(8, coalesce(next_i - i, 8))) AS n_repeat_words FROM doubled GROUP BY row_id
), lines AS (
    SELECT row_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id
), measured AS (
    SELECT row_id, doc_id, text, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM worded LEFT JOIN lines USING (row_id) LEFT JOIN repeated USING (row_id)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        n_symbols * 100 > n_words * 25
        OR word_chars > n_words * 25 OR word_chars * 2 < n_words * 3
        OR n_dup_lines * 10 > n_words
        OR length(regexp_replace(text, '[^A-Z]', '', 'g')) * 100 > word_chars * 60
        OR (length(text) - length(replace(text, '!!', ''))) * 100 > n_words * 60 AS rejected
    FROM measured
)
"""

QUALITY_RULES = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents), {_QUALITY_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM judged
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), listed AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
    FROM worded
), sized AS (
    SELECT doc_id, len(shingles) AS n FROM listed
), flat AS (
    SELECT doc_id, unnest(shingles) AS s FROM listed
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM flat x JOIN flat y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)
), reached AS (
    SELECT doc_id, doc_id AS other FROM sized
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
)
SELECT doc_id, any_value(n)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached JOIN sized USING (doc_id) GROUP BY doc_id
"""

#: CRC-32 bit by bit for each byte's table entry, then byte by byte over the text.
SHARDING = r"""
WITH RECURSIVE bits AS (
    SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
    UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1 FROM bits WHERE step < 8
), crc_table AS (
    SELECT list(c ORDER BY i) AS entries FROM bits WHERE step = 8
), hexed AS (
    SELECT row_number() OVER () AS row_id, doc_id, source, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), summed AS (
    SELECT doc_id, coalesce('=' || source, '') AS source, n + 1 AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, n), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
            lambda a, b: xor(a // 256, entries[xor(a % 256, b) + 1])), 4294967295) AS text_crc32
    FROM hexed, crc_table
), ranked AS (
    SELECT *, 2 * row_number() OVER (PARTITION BY source ORDER BY md5('11:' || doc_id || ':' || text_crc32), doc_id, size) - 1 AS twice,
        count(*) OVER (PARTITION BY source) AS n
    FROM summed
), placed AS (
    SELECT *, row_number() OVER (ORDER BY twice / (2 * n), md5('11:' || source), md5('11:' || doc_id || ':' || text_crc32), doc_id, size) AS place,
        count(*) OVER () AS total
    FROM ranked
), cut AS (
    SELECT *, (16 * place - 1) // total AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INT AS shard,
    (row_number() OVER (PARTITION BY shard ORDER BY place) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM cut
"""

CHAT = """
WITH turns AS (
    SELECT conv_id, coalesce(turn, 0) AS turn, translate(replace(coalesce(role, 'unknown'), '<|', '< |'), chr(13) || chr(10), '  ') AS role, replace(coalesce(text, ''), '<|', '< |') AS text, role AS who
    FROM conversations
), speakers AS (
    SELECT DISTINCT conv_id, role AS speaker, who AS speaks FROM turns WHERE who IS DISTINCT FROM 'system'
), segments AS (
    SELECT t.conv_id, speaker, speaks, turn, role, text, who, who IS NOT DISTINCT FROM speaks AS own,
        '<|im_start|>' || CASE WHEN who IS NOT DISTINCT FROM speaks THEN 'assistant' WHEN who = 'system' THEN 'system' ELSE 'user name=' || role END || chr(10) AS head,
        text || '<|im_end|>' AS body
    FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
    SELECT *, row_number() OVER w AS k, sum(length(head) + length(body) + 1) OVER w AS after
    FROM segments WINDOW w AS (PARTITION BY conv_id, speaker, speaks ORDER BY turn, role, text, who NULLS FIRST ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, speaker, count(*) AS n_turns, count(*) FILTER (own) AS n_own, string_agg(head || body || chr(10), '' ORDER BY k) AS text,
    coalesce(string_agg((after - 1 - length(body))::VARCHAR || '-' || (after - 1)::VARCHAR, ',' ORDER BY k) FILTER (own), '') AS spans
FROM placed GROUP BY conv_id, speaker, speaks
"""

#: Each item's best documents, by weights and counts over all documents.
LEXICAL_SEARCH = r"""
WITH words AS (
    SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
), tfs AS (
    SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
    SELECT row, sum(tf)::BIGINT AS n FROM tfs GROUP BY row
), totals AS (
    SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals
), scores AS (
    SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (row), totals GROUP BY item_id, row, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scores WHERE score > 0
QUALIFY rank <= 10
"""

#: Each language's phrases that hold together most.
COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
    SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), rows AS (
    SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS place FROM words
), runs AS (
    SELECT lang, w1, lead(w1) OVER own AS w2, lead(w1, 2) OVER own AS w3, lead(w1, 3) OVER own AS w4 FROM rows WINDOW own AS (PARTITION BY piece ORDER BY place)
), totals AS (
    SELECT lang, count(*) AS n FROM runs GROUP BY lang
), phrases AS MATERIALIZED (
    SELECT lang, phrase, count(*) AS f FROM (
        SELECT lang, w1 AS phrase FROM runs UNION ALL SELECT lang, w1 || ' ' || w2 FROM runs UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 FROM runs UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs
    ) WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
    SELECT lang, len(string_split(phrase, ' ')) AS size, phrase, f, string_split(phrase, ' ') AS w FROM phrases WHERE contains(phrase, ' ')
), splits AS MATERIALIZED (
    SELECT lang, phrase, f, place.k, array_to_string(w[1:place.k], ' ') AS head, array_to_string(w[place.k + 1:], ' ') AS tail FROM candidates, range(1, 4) place(k) WHERE place.k < size
), cuts AS (
    SELECT s.lang, s.phrase, s.f AS a, s.k, x.f AS l, y.f AS r, (2000000::HUGEINT * s.f) // (x.f + y.f) AS score
    FROM splits s JOIN phrases x ON x.lang = s.lang AND x.phrase = s.head JOIN phrases y ON y.lang = s.lang AND y.phrase = s.tail
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, phrase, max(f) AS within FROM (
        SELECT lang, f, unnest(list_transform(range(1, size - s.part + 2), lambda i: array_to_string(w[i:i + s.part - 1], ' '))) AS phrase FROM candidates JOIN range(2, 4) s(part) ON s.part < size
    ) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM lowest LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang) WHERE within IS NULL OR 100 * within < 80 * a
QUALIFY rank <= 2000
"""
