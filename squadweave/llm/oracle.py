"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"

DECONTAMINATION = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
    SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
    FROM iw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
),
places AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
    FROM dw, (SELECT DISTINCT n FROM windows) AS l, unnest(range(1, len(w) - n + 2)) AS t(i)
),
found AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

NEAR_DEDUP = f"""
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM dw, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
    WHERE 100 * c >= 75 * (p.n + q.n - c)
),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, steps.b FROM reach JOIN steps ON reach.b = steps.a
),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_of LEFT JOIN sizes USING (doc_id)
"""

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
dw AS (
    SELECT doc_id, text, regexp_extract_all(text, {_WORDS}) AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d
),
places AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM dw, unnest(range(1, len(w) - 6)) AS t(i)
),
twice AS (SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 8)) AS t(p) GROUP BY doc_id),
counted AS (
    SELECT doc_id, text, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(n, 0) AS n_repeat_words
    FROM dw LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (
        n_words < 20
        OR 100 * n_repeat_words > 30 * n_words
        OR 100 * len(list_filter(range(1, n_words), lambda i: w[i] = w[i + 1])) > 40 * n_words
        OR 100 * n_symbols > 30 * n_words
        OR 100 * length(regexp_replace(text, '[^!]', '', 'g')) > 50 * n_words
        OR word_chars < 2 * n_words OR word_chars > 15 * n_words
        OR 100 * length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) < 60 * word_chars
        OR 100 * n_dup_lines > 60 * n_lines
    ) AS kept
FROM counted
"""

LINE_DEDUP = rf"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS every FROM documents),
lines AS (
    SELECT doc_id, i - 1 AS line, trim(every[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x,
        len(regexp_extract_all(every[i], {_WORDS})) AS words
    FROM d, unnest(range(1, len(every) + 1)) AS t(i)
),
placed AS (
    SELECT *, (sum(words) OVER (PARTITION BY doc_id ORDER BY line))::BIGINT AS after,
        (sum(words) OVER (PARTITION BY doc_id ORDER BY line))::BIGINT - words AS before
    FROM lines WHERE words > 0
),
windows AS (
    SELECT doc_id, line AS first, max(line) OVER f AS last, list(x) OVER f AS k, max(after) OVER f - before >= 50 AS whole
    FROM placed WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
    UNION
    SELECT doc_id, min(line) OVER b, line, list(x) OVER b, after - min(before) OVER b >= 50
    FROM placed WINDOW b AS (PARTITION BY doc_id ORDER BY after RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
),
later AS (
    SELECT doc_id, first, last FROM windows WHERE whole
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, first) > 1
),
cut AS (
    SELECT doc_id, list(DISTINCT p) AS gone FROM later, unnest(range(first, last + 1)) AS t(p) GROUP BY doc_id
)
SELECT doc_id, coalesce(len(gone), 0) AS lines_cut,
    CASE WHEN gone IS NULL THEN text
    ELSE array_to_string(list_filter(every, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text
FROM d LEFT JOIN cut USING (doc_id)
"""

# Markers of the chat template take 32 characters a turn; a control string costs one more.
CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
counted AS (
    SELECT *, 32 + length(role) + length(text) + len(regexp_extract_all(
        text, '<\\*(\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|\|endoftext\|>)|\[\\*(INST\]|/INST\])')) AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM counted GROUP BY conv_id
"""

COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
f AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS n
    FROM pieces, (VALUES (1), (2), (3)) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i) GROUP BY ALL
),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
covered AS (
    SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(n) AS most
    FROM candidates, unnest([1, 2]) AS t(i) WHERE size = 3 GROUP BY ALL
),
cuts AS (
    SELECT c.lang, c.phrase, c.n AS a, x.n AS l, y.n AS r, k, ((1000000::HUGEINT * c.n * c.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
    FROM candidates AS c, unnest([1, 2]) AS t(k), f AS x, f AS y
    WHERE k < c.size AND x.lang = c.lang AND y.lang = c.lang
        AND x.phrase = array_to_string(c.w[1:k], ' ') AND y.phrase = array_to_string(c.w[k + 1:c.size], ' ')
),
best AS (
    SELECT cuts.* FROM cuts LEFT JOIN covered USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, totals.n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

def _clustering_round(k: int) -> str:
    return f"""
a{k} AS MATERIALIZED (
    SELECT vec_id, any_value(v) AS v, min_by(c, (d, c)) AS c, min(d) AS d
    FROM (
        SELECT vec_id, copy, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT AS d
        FROM kept, c{k}
    ) GROUP BY vec_id, copy
),
c{k + 1} AS MATERIALIZED (
    SELECT c, coalesce(moved.m, c{k}.m) AS m FROM c{k} LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m
        FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{k}, unnest(range(1, 65)) AS t(i) GROUP BY c, i) GROUP BY c
    ) AS moved USING (c)
),"""


CENTROID_CLUSTERING = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS copy, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = 64 AND len(embedding) = 64
),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
    FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT 16)
),{_clustering_round(0)}{_clustering_round(1)}{_clustering_round(2)}{_clustering_round(3)}
clusters AS (SELECT c, sum(d)::BIGINT AS cluster_inertia FROM a3 GROUP BY c)
SELECT vec_id, c AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM a3) AS inertia,
    sha256(array_to_string(c3.m, ',')) AS centroid_sha256
FROM a3 JOIN clusters USING (c) JOIN c3 USING (c)
"""

ORACLE = {
    "op3_decontamination": DECONTAMINATION,
    "op5_near_dedup": NEAR_DEDUP,
    "op6_quality_rules": QUALITY_RULES,
    "op9_line_dedup": LINE_DEDUP,
    "op11_chat_format": CHAT_FORMAT,
    "op12_collocations": COLLOCATIONS,
    "op13_centroid_clustering": CENTROID_CLUSTERING,
}
