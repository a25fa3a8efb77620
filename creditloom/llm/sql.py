"""DuckDB statements of the corpus queries, written apart from the Spark code."""

from __future__ import annotations

OP1 = r"""
WITH p AS (SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
o AS (SELECT p.host, CAST(l.quality AS BIGINT) AS good
      FROM p JOIN labels l ON l.doc_id = TRY_CAST(regexp_extract(p.url, '/(\d+)', 1) AS BIGINT)
      WHERE l.quality IS NOT NULL),
h AS (SELECT host, string_split(regexp_replace(host, ':\d*$', ''), '.') AS parts,
             (SELECT count(*) FROM o WHERE o.host = u.host) AS n,
             (SELECT CAST(coalesce(sum(good), 0) AS BIGINT) FROM o WHERE o.host = u.host) AS good
      FROM (SELECT DISTINCT host FROM p) u),
t AS (SELECT host, n, good, array_to_string(parts[-2:], '.') AS domain, parts[-1] AS suffix FROM h),
g AS (SELECT (sum(good) + 1.0::DOUBLE) / (sum(n) + 2.0::DOUBLE) AS m FROM t),
s AS (SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(g.m) AS m FROM t, g GROUP BY suffix),
sx AS (SELECT sum(n * pow(good / n - m, 2) / (m * (1 - m))) AS x2, count(*) AS k, sum(n) AS total FROM s WHERE n > 0),
ss AS (SELECT CASE WHEN total > k AND x2 > k - 1
                   THEN least(greatest(1 / ((x2 - (k - 1)) / (total - k)) - 1, 2.0), 1000.0) WHEN total > k THEN 1000.0 ELSE 2.0 END AS c FROM sx),
sp AS (SELECT suffix, (c * m + good) / (c + n) AS m FROM s, ss),
d AS (SELECT t.suffix, t.domain, sum(n) AS n, sum(good) AS good, any_value(sp.m) AS m
      FROM t JOIN sp USING (suffix) GROUP BY t.suffix, t.domain),
dx AS (SELECT sum(n * pow(good / n - m, 2) / (m * (1 - m))) AS x2, count(*) AS k, sum(n) AS total FROM d WHERE n > 0),
ds AS (SELECT CASE WHEN total > k AND x2 > k - 1
                   THEN least(greatest(1 / ((x2 - (k - 1)) / (total - k)) - 1, 2.0), 1000.0) WHEN total > k THEN 1000.0 ELSE 2.0 END AS c FROM dx),
dp AS (SELECT suffix, domain, (c * m + good) / (c + n) AS m FROM d, ds),
e AS (SELECT t.host, n, good, m FROM t JOIN dp USING (suffix, domain)),
ex AS (SELECT sum(n * pow(good / n - m, 2) / (m * (1 - m))) AS x2, count(*) AS k, sum(n) AS total FROM e WHERE n > 0),
es AS (SELECT CASE WHEN total > k AND x2 > k - 1
                   THEN least(greatest(1 / ((x2 - (k - 1)) / (total - k)) - 1, 2.0), 1000.0) WHEN total > k THEN 1000.0 ELSE 2.0 END AS c FROM ex),
b AS (SELECT host, n, good, c * m + good AS a, c * (1 - m) + n - good AS b FROM e, es),
v AS (SELECT host, n, good, a / (a + b) + 2.0 * sqrt(a * b / (a + b + 1)) / (a + b) AS upper FROM b),
r AS (SELECT p.*, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                       WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                       WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                       WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM p)
SELECT page_id, r.host, path, rule,
       CASE rule WHEN 'net/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block'
                 WHEN 'org/fr/' THEN 'allow' ELSE CASE WHEN upper < 0.75 THEN 'block' ELSE 'allow' END END AS verdict,
       n AS host_labelled, good AS host_good
FROM r JOIN v USING (host)
"""

# Base32 from the bits of the digest: 160 bits in 32 groups of 5.
OP6 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
h AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, hex, max(page_id) OVER (PARTITION BY hex) AS original FROM p),
b AS (SELECT DISTINCT hex, (SELECT string_agg(right(bin(instr('0123456789abcdef', hex[i]) - 1 + 16), 4), '' ORDER BY i)
                   FROM (SELECT unnest(range(1, 41)) AS i)) AS bits FROM h),
c AS (SELECT hex, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
                     + 16 * CAST(bits[5 * i + 1] AS INTEGER) + 8 * CAST(bits[5 * i + 2] AS INTEGER)
                     + 4 * CAST(bits[5 * i + 3] AS INTEGER) + 2 * CAST(bits[5 * i + 4] AS INTEGER)
                     + CAST(bits[5 * i + 5] AS INTEGER), 1), '' ORDER BY i)
                   FROM (SELECT unnest(range(0, 32)) AS i)) AS payload_digest FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM h JOIN c USING (hex)
"""

OP7 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, t, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d),
windows AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS offsets(o) GROUP BY r),
m AS (SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS BIGINT) AS n_upper,
             CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclaim
      FROM w LEFT JOIN covered USING (r)),
f AS (SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END
             + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
             + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
             + CASE WHEN word_chars > 24 * n_words THEN 32 ELSE 0 END
             + CASE WHEN 100 * n_upper > 50 * word_chars THEN 64 ELSE 0 END
             + CASE WHEN 100 * n_exclaim > 50 * n_words THEN 128 ELSE 0 END AS BIGINT) AS failure_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failure_bits = 0 AS kept, failure_bits FROM f
"""

OP10 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
             ELSE array_to_string(w[i:i + 2], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""

OP11 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
i AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT lang, words[i:i + k - 1] AS words FROM i, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(words)),
f AS (SELECT lang, words, len(words) AS k, count(*) AS a FROM g GROUP BY lang, words),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
s AS (SELECT c.lang, c.words, c.a, x.a AS l, y.a AS r, x.k AS first,
             CAST(1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a) AS BIGINT) AS score
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
      JOIN f x ON x.lang = c.lang AND x.words = c.words[1:cut] JOIN f y ON y.lang = c.lang AND y.words = c.words[cut + 1:c.k]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, first) = 1),
o AS (SELECT lang, inner_words, max(a) AS a FROM (SELECT lang, unnest([words[1:2], words[2:3]]) AS inner_words, a FROM c WHERE k = 3)
      GROUP BY lang, inner_words),
t AS (SELECT b.lang, array_to_string(b.words, ' ') AS phrase, b.a, l, r, score FROM b
      LEFT JOIN o ON o.lang = b.lang AND o.inner_words = b.words WHERE o.a IS NULL OR 100 * o.a < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM t JOIN n USING (lang) QUALIFY rank <= 2000
"""

OP12 = r"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def statements() -> dict[str, str]:
    """One statement per query name."""
    return {"op1_host_reputation": OP1, "op6_warc_revisit": OP6, "op7_rule_bitmask_ledger": OP7,
            "op10_signature_trees": OP10, "op11_weighted_automata": OP11, "op12_grace_hash": OP12}
