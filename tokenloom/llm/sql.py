"""DuckDB SQL of the operators' queries, where SQL can express them over whole tables."""

from __future__ import annotations

# The checksum is built from its polynomial: a table of 256 entries, then one step for each byte.
SPELLING = """
WITH RECURSIVE steps AS (
    SELECT range AS b, list_reduce(list_prepend(range, range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256)),
codes AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM steps),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[a-zÀ-ÿ]{7,}')) AS run FROM documents),
distinct_runs AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
bytes AS (
    SELECT doc_id, run, times, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT) AS b
    FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM distinct_runs)),
checked AS (
    SELECT run, times, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
    FROM bytes, codes),
found AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word,
        times FROM checked),
words AS MATERIALIZED (
    SELECT word, sum(times)::BIGINT AS n FROM found WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
gaps AS MATERIALIZED (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gap
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT DISTINCT word, near, near_n FROM (
        SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.i = b.i AND a.word <> b.word
        UNION ALL SELECT w.word, g.word, g.n FROM words w JOIN gaps g ON g.gap = w.word
        UNION ALL SELECT g.word, w.word, w.n FROM words w JOIN gaps g ON g.gap = w.word)),
best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS form_n FROM near GROUP BY word),
named AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 10 * w.n THEN b.form_n END AS form_n,
        CASE WHEN b.form_n >= 10 * w.n THEN (SELECT min(hex(encode(near))) FROM near x WHERE x.word = w.word AND x.near_n = b.form_n) END AS form_hex
    FROM words w LEFT JOIN best b USING (word)),
formed AS MATERIALIZED (SELECT word, n, n_near, form_n, decode(unhex(form_hex)) AS form FROM named),
chain AS (
    SELECT word, word AS at FROM formed
    UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c USING (word) JOIN formed e ON e.word = c.at WHERE e.form IS NULL
"""

EMBEDDINGS = """
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
usable AS (
    SELECT r, e, sqrt(list_dot_product(e, e)) AS size FROM vectors
    WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
    SELECT a.r AS x, b.r AS y FROM usable a JOIN usable b ON a.r <> b.r AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95),
reached AS (SELECT r, r AS t FROM vectors UNION SELECT c.r, l.y FROM reached c JOIN links l ON c.t = l.x),
lowest AS (SELECT c.r, min(v.vec_id) AS component_id FROM reached c JOIN vectors v ON v.r = c.t GROUP BY c.r),
degree AS (SELECT x AS r, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN lowest USING (r) LEFT JOIN degree USING (r)
"""

COLLOCATIONS = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
listed AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed),
phrases AS (
    SELECT lang, w[i] AS phrase, 1 AS words FROM placed
    UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM placed WHERE i + 1 <= len(w)
    UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 FROM placed WHERE i + 2 <= len(w)),
counts AS MATERIALIZED (SELECT lang, phrase, words, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words > 1 AND f >= 10),
cuts AS (
    SELECT lang, phrase, words, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail
    FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates)),
scores AS (
    SELECT c.lang, c.phrase, c.words, c.a, c.k, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
    SELECT lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase, a AS longer FROM candidates WHERE words = 3),
kept AS (
    SELECT s.* FROM lowest s LEFT JOIN (SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL) i USING (lang, phrase)
    WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000
"""


CHAT = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
rotated AS (
    SELECT s.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS part
    FROM said s JOIN people p ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
headed AS (
    SELECT *, '<|' || part || CASE WHEN part = 'user' THEN ' name=' || regexp_replace(replace(replace(
        regexp_replace(speaker, '[\\p{Cc}\\p{Zl}\\p{Zp}]', ' ', 'g'), '<|', '< |'), '|>', '| >'), '([<|])$', '\\1 ') ELSE '' END || '|>' || chr(10) AS head,
        replace(text, '<|', '< |') AS body FROM rotated),
placed AS (
    SELECT *, head || body || '<|end|>' || chr(10) AS segment, coalesce(sum(length(head) + length(body) + 8) OVER (
        PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM headed)
SELECT conv_id, perspective, turn, part, segment, start, CASE WHEN part = 'assistant' THEN start + length(head) END AS mask_start,
    CASE WHEN part = 'assistant' THEN start + length(head) + length(body) + 7 END AS mask_end FROM placed
"""

REPEATS = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT r, h, unnest(range(length(h) // 2 - 199)) AS s FROM texts WHERE length(h) >= 400),
windows AS (SELECT r, s, md5_number(substr(h, 2 * s + 1, 400)) AS w FROM starts),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
found AS (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS last FROM windows WHERE w IN (SELECT w FROM twice)),
numbered AS (SELECT r, s, sum(CASE WHEN last IS NULL OR s > last + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY s) AS run FROM found),
runs AS (SELECT r, run, min(s) AS a, max(s) + 200 AS b FROM numbered GROUP BY r, run),
gaps AS (SELECT r, run, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM runs),
kept AS (
    SELECT t.r, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k,
        sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans
    FROM gaps g JOIN texts t USING (r) GROUP BY t.r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""

NEAR = """
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingled AS (
    SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS e FROM worded),
sized AS MATERIALIZED (SELECT doc_id, len(e) AS n, e FROM shingled),
elements AS MATERIALIZED (SELECT doc_id, n, unnest(e) AS x FROM sized),
links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b FROM elements a JOIN elements b ON a.x = b.x AND a.doc_id < b.doc_id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS t FROM sized UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON l.a = r.t),
lowest AS (SELECT doc_id, min(t) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN lowest USING (doc_id)
"""


def registry() -> dict[str, str]:
    return {
        "op4_chat": CHAT,
        "op8_repeats": REPEATS,
        "op9_near": NEAR,
        "op11_spelling": SPELLING,
        "op12_embeddings": EMBEDDINGS,
        "op13_collocations": COLLOCATIONS,
    }
