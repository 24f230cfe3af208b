"""DuckDB SQL for the queries of this package that SQL can express.

Suffix dedup has none: all windows of a table as rows take SQL minutes. The others
rest on hashes, merges or estimates; tests hold them against brute force.
"""

#: Common table expressions that end in ``tab``, the table of crc32 as one list ``c``, made by its rule.
_CRC_TABLE = """
poly AS (
    SELECT n, n AS v, 0 AS i FROM range(256) t(n)
    UNION ALL
    SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM poly WHERE i < 8
),
tab AS (SELECT list(v ORDER BY n) AS c FROM poly WHERE i = 8)"""


def _crc(bytes_: str) -> str:
    """crc32 of a list of bytes, beside ``tab``."""
    step = "xor(acc >> 8, c[(xor(acc, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda acc, b: {step}), 4294967295)"


_KEY_BYTES = "list_transform(string_split({key}, ''), lambda ch: unicode(ch)::BIGINT)"

_UTF8 = """flatten(list_transform(string_split({key}, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
    ELSE [192 + unicode(ch)::BIGINT // 64, 128 + unicode(ch)::BIGINT % 64] END))"""

ORACLES = {
    "op1_chat_format": r"""
WITH told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
),
marked AS (
    SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS more, lead(role) OVER w IS NOT DISTINCT FROM role AS goes_on
    FROM told WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
),
written AS (
    SELECT *, CASE WHEN more THEN '<|im_sep|>' ELSE '<|im_start|>' || role || chr(10) END
              || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')
              || CASE WHEN goes_on THEN '' ELSE '<|im_end|>' || chr(10) END AS part
    FROM marked
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(part))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
""",
    "op2_minhash_near_dedup": """
WITH RECURSIVE
parts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN words ELSE words[i : i + 2] END AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM parts WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY ALL
),
links AS (
    SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * shared >= 85 * (a.n + b.n - shared)
),
ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT DISTINCT x AS doc_id, x AS other FROM ends
    UNION
    SELECT reach.doc_id, ends.y FROM reach JOIN ends ON ends.x = reach.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
""",
    "op9_embedding_near_dedup": """
WITH RECURSIVE
vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
ends AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a, vectors b
    WHERE a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
),
reach AS (
    SELECT DISTINCT x AS vec_id, x AS other FROM ends
    UNION
    SELECT reach.vec_id, ends.y FROM reach JOIN ends ON ends.x = reach.other
),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT x AS vec_id, count(*) AS n FROM ends GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN least USING (vec_id)
""",
    "op13_exact_dedup": r"""
SELECT doc_id, min(doc_id) OVER equal AS keep_id, count(*) OVER equal AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW equal AS (PARTITION BY t)
""",
    "op11_conversation_repair": rf"""
WITH RECURSIVE {_CRC_TABLE},
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc(_KEY_BYTES.format(key="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"))} % 20 AS chance
    FROM conversations, tab
),
hurt AS (
    SELECT conv_id, turn, CASE chance WHEN 4 THEN 'user' ELSE role END AS role,
           CASE chance WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE chance WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM keyed WHERE chance <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM hurt
),
judged AS (
    SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault
    FROM placed
),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS last
    FROM judged GROUP BY conv_id
),
follows(s, said, e) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
inserts(s, e, cost, audit, lines) AS (
    VALUES ('0', '0', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
           ('0', 'u', 2, 'I', chr(10) || 'user:'), ('s', 'u', 2, 'I', chr(10) || 'user:'), ('a', 'u', 2, 'I', chr(10) || 'user:'),
           ('u', 'a', 2, 'I', chr(10) || 'assistant:'), ('0', 'a', 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
           ('s', 'a', 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
),
ways AS (
    SELECT j.conv_id, j.pos, f.s, f.e, 3 AS cost, 'D' AS audit, '' AS lines
    FROM judged j, (SELECT DISTINCT s, s AS e FROM inserts) f
    UNION ALL
    SELECT j.conv_id, j.pos, f.s, f.e, CASE WHEN initial = said THEN 0 ELSE 2 END + CASE fault WHEN 'truncated' THEN 1 ELSE 0 END,
           CASE WHEN initial = said THEN 'K' ELSE 'R' END,
           chr(10) || CASE WHEN initial = said THEN role WHEN said = 'u' THEN 'user' ELSE 'assistant' END || ':' || text
    FROM judged j JOIN follows f ON f.said <> 's' OR initial = 's'
    WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')
),
steps AS (
    SELECT w.conv_id, w.pos, w.s, i.e, (w.cost + i.cost)::INT AS cost, w.audit || i.audit AS audit, w.lines || i.lines AS lines
    FROM ways w JOIN inserts i ON i.s = w.e
),
best AS (
    SELECT c.conv_id, 0::BIGINT AS pos, i.e AS state, {{'cost': i.cost::INT, 'audit': i.audit, 'lines': i.lines}} AS way
    FROM counted c JOIN inserts i ON i.s = '0'
    UNION ALL
    SELECT b.conv_id, b.pos + 1, t.e,
           min({{'cost': b.way.cost + t.cost, 'audit': b.way.audit || t.audit, 'lines': b.way.lines || t.lines}})
    FROM best b JOIN steps t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.pos = b.pos + 1 AND t.s = b.state
    GROUP BY b.conv_id, b.pos, t.e
),
ended AS (
    SELECT c.conv_id, min(way) AS way FROM counted c
    JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.pos = c.last AND b.state IN ('0', 'a')
    GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
       coalesce(way.audit, '') AS audit, sha256(coalesce(substr(way.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
""",
    "op12_spelling_variants": rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
lowered AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM runs WHERE length(run) >= 6 GROUP BY ALL
),
keyed AS (
    SELECT run, n, {_crc(_UTF8.format(key="coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h FROM lowered, tab
),
counted AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
           sum(n)::BIGINT AS n
    FROM keyed GROUP BY ALL
),
words AS (SELECT word, n FROM counted WHERE length(word) >= 6 AND n >= 5),
cut AS (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
),
tops AS (SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS top FROM near GROUP BY word),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.less >= 5 * n THEN top.other END AS form,
           CASE WHEN -top.less >= 5 * n THEN -top.less END AS form_n
    FROM words LEFT JOIN tops USING (word)
),
followed AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL
    SELECT s.word, s.next, f.form FROM followed s JOIN forms f ON f.word = s.next
)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN (SELECT word, root FROM followed WHERE next IS NULL) USING (word)
""",
}
