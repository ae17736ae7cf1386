"""DuckDB SQL of the queries that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d),
per_line AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
    FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM starts),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
m AS (
    SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(n_lines, 0) AS n_lines,
           length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g')) AS n_letters,
           length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_upper
    FROM d LEFT JOIN per_line USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (
    SELECT *, CAST(n_words < 20 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 30 * n_words AS BIGINT)
        + 4 * CAST(10 * n_symbols > n_words AS BIGINT)
        + 8 * CAST(n_dup_lines >= 3 AND 100 * n_dup_lines > 50 * n_lines AS BIGINT)
        + 16 * CAST(n_words >= 20 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) AS BIGINT)
        + 32 * CAST(n_words >= 20 AND n_letters >= 20 AND 2 * n_upper > n_letters AS BIGINT) AS failed_bits
    FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
       failed_bits = 0 AS kept, failed_bits
FROM f
"""

OP3 = r"""
WITH u AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
p AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (
    SELECT *, CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                   WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                   WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                   WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(host, 'pills|casino|viagra|porn|payday|jackpot') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

OP5 = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
    SELECT *, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS safe,
           lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t),
f AS (
    SELECT conv_id, turn, role, text,
           CASE WHEN before IS NOT NULL AND before = role THEN '<|im_sep|>' || safe
                ELSE CASE WHEN before IS NULL THEN '' ELSE '<|im_end|>' || chr(10) END
                     || '<|im_start|>' || replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;')
                     || chr(10) || safe END AS part FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(length(part)) + 11 AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP11 = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(ps), '[^\x20\x09]+') AS w FROM d),
g AS (
    SELECT lang, m, w[i:i + m - 1] AS h
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, h, count(*) AS a FROM g GROUP BY lang, m, h HAVING count(*) >= 30),
tot AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
inside AS (
    SELECT lang, h, max(a) AS a FROM (
        SELECT lang, h[i:j] AS h, a
        FROM (SELECT lang, h, a, m, unnest([1, 2, 3]) AS i FROM f WHERE m > 2) s, (SELECT unnest([2, 3, 4]) AS j) e
        WHERE j > i AND j <= m AND j - i + 1 < m) GROUP BY lang, h),
c AS (
    SELECT f.* FROM f LEFT JOIN inside USING (lang, h)
    WHERE m > 1 AND (inside.a IS NULL OR 100 * inside.a::HUGEINT < 80 * f.a::HUGEINT)),
cut AS (SELECT lang, h, m, a, unnest(range(1, m)) AS k FROM c),
s AS (
    SELECT cut.*, x.a AS l, y.a AS r, (2000000 * cut.a::HUGEINT) // (x.a + y.a) AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.h = cut.h[1:k] JOIN f y ON y.lang = cut.lang AND y.h = cut.h[k + 1:cut.m]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, h ORDER BY score, k) = 1),
o AS (SELECT lang, array_to_string(h, ' ') AS phrase, a, l, r, score FROM b)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o) JOIN tot USING (lang)
WHERE rank <= 2000
"""

OP12 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents),
st AS (SELECT count(*) FILTER (len(w) > 0) AS cn, sum(len(w)) AS cl FROM d),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM benchmark),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM it) GROUP BY rid, t),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(cn) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS wt
       FROM tf, st GROUP BY t),
m AS (SELECT rid, doc_id, CAST(100 - 50 + ((50 * len(w) * cn) // cl) AS BIGINT) AS m FROM d, st),
sc AS (
    SELECT item_id, rid, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM it JOIN tf USING (t) JOIN wt USING (t) JOIN m USING (rid) GROUP BY item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
WHERE rank <= 50
"""

OP13 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM benchmark),
win AS (
    SELECT DISTINCT item, least(len(w), 10) AS k, w[s:s + least(len(w), 10) - 1] AS g
    FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM win),
spot AS (
    SELECT rid, s, k, w[s:s + k - 1] AS g
    FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d CROSS JOIN lens WHERE len(w) >= k)),
hit AS (SELECT rid, s, k, item FROM spot JOIN win USING (k, g)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""

ORACLE = {"op2_quality_rules": OP2, "op3_url_filter": OP3, "op5_chat_format": OP5, "op11_collocations": OP11,
          "op12_lexical_search": OP12, "op13_decontamination": OP13}
