"""DuckDB SQL of the queries that SQL can express."""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
earliest AS (SELECT t, min(doc_id) AS m FROM win GROUP BY t),
gone AS (SELECT DISTINCT doc_id, p FROM (
           SELECT win.doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN earliest USING (t) WHERE m < win.doc_id)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d)
SELECT d.doc_id, CAST(count(word.p) AS BIGINT) AS n_words, CAST(count(gone.p) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(x, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN word ON d.doc_id = word.doc_id LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p
GROUP BY d.doc_id
"""

_FOLDED = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
b AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t
        FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT k FROM pat),
win AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS t
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, size WHERE len(w) >= k)),
hit AS (SELECT win.doc_id, win.i, win.k, pat.item_id FROM win JOIN pat ON win.k = pat.k AND win.t = pat.t),
word AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS l
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(word.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(item.n, 0) AS BIGINT) AS n_items, sha256(coalesce(item.l, '')) AS items_sha256,
       coalesce(word.n, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""

ORACLES: dict[str, str] = {"op6_decontamination": DECONTAMINATION, "op9_substring_dedup": SUBSTRINGS}

EXACT = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t, length(coalesce(text, '')) AS n,
                  row_number() OVER () AS r FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST, r) AS k FROM d)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY k) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       k = 1 AS kept, sha256(t) AS text_sha256
FROM o
"""

ORACLES["op12_exact_dedup"] = EXACT

COLLOCATIONS = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
cut AS (SELECT lang, k, phrase, a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS x, array_to_string(string_split(phrase, ' ')[j + 1:k], ' ') AS y
        FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1 AND a >= 10)),
s AS (SELECT cut.*, l.a AS l, r.a AS r, (1000000::HUGEINT * cut.a * cut.a) // (l.a::HUGEINT * r.a) AS score
      FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS m
           FROM (SELECT lang, string_split(phrase, ' ') AS w, a, unnest([1, 2]) AS i FROM f WHERE k = 3 AND a >= 10) GROUP BY ALL),
own AS (SELECT low.* FROM low LEFT JOIN inner_ USING (lang, phrase) WHERE m IS NULL OR 100 * m < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM own JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLES["op11_collocations"] = COLLOCATIONS
