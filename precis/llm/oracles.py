"""The same results in DuckDB SQL, for the operators that SQL can express.

Patterns and lists are written out here again, so that a wrong entry in the code shows.
"""

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH l AS (
  SELECT doc_id, i, line[i] AS line FROM (
    SELECT doc_id, line, unnest(range(1, len(line) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS line FROM documents))
), k AS (
  SELECT *, {_LOW.format(f"trim(line, {_BLANK})")} AS key FROM l
), often AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE o.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE o.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often o ON k.key = o.key GROUP BY doc_id
"""

OP2 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_LOW.format("coalesce(text, '')"))} AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w]
    ELSE list_transform(range(1, len(w)), lambda i: w[i:i + 1]) END) AS s FROM w
), classes AS (
  SELECT min(doc_id) AS c, list(doc_id) AS ids, t, len(t) AS n
  FROM (SELECT doc_id, list_sort(s) AS t FROM sets WHERE len(s) > 0) GROUP BY t
), items AS (
  SELECT c, n, hash(unnest(t)) AS h FROM classes
), pairs AS (
  SELECT a.c AS a, b.c AS b FROM items a JOIN items b ON a.h = b.h AND a.c < b.c AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT c AS a, c AS b FROM classes UNION SELECT r.a, p.b FROM reach r JOIN both_ways p ON r.b = p.a
), root AS (
  SELECT a AS c, min(b) AS root FROM reach GROUP BY a
), placed AS (
  SELECT unnest(ids) AS doc_id, root FROM classes JOIN root USING (c)
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id, doc_id = coalesce(root, doc_id) AS kept
FROM sets LEFT JOIN placed USING (doc_id)
"""

OP3 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w)
), again AS (
  SELECT h FROM g GROUP BY h HAVING count(*) > 1
), spans AS (
  SELECT doc_id, list(i) AS starts FROM g JOIN again USING (h) GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, unnest(starts) AS i FROM spans), range(35) t(k)
), words AS (
  SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)
), kept AS (
  SELECT w.doc_id, count(*) AS n_words, count(g.i) AS n_removed,
    string_agg(word, ' ' ORDER BY w.i) FILTER (WHERE g.i IS NULL) AS text
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

#: Kind, pattern, group and its least length; base kinds as the contract has them, without bounds in the pattern.
_RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{16,}", 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("url_login", r"://[^/\x20:@\n]+:[^/\x20:@\n]+@", 0, 0),
)


def _matches(nth: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one rule: the text between matches and the matches before add up to the start."""
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""
      SELECT doc_id, {nth} AS nth, '{kind}' AS kind, total - n AS s, total AS e FROM (
        SELECT doc_id, length(m) AS n, length(g) AS g, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS total
        FROM (SELECT doc_id, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(gs) AS g, unnest(gaps[1:len(ms)]) AS gap FROM (
          SELECT doc_id, regexp_extract_all(t, {p}) AS ms, regexp_extract_all(t, {p}, {group}) AS gs,
            string_split_regex(t, {p}) AS gaps FROM texts)))
      WHERE g >= {least}"""


OP7 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_matches(i, *r) for i, r in enumerate(_RULES))}
), named AS (
  SELECT *, kind || ':' || CAST(s AS VARCHAR) || ':' || CAST(e AS VARCHAR) AS span FROM spans
)
SELECT t.doc_id, count(*) FILTER (WHERE nth = 0) AS n_assign, count(*) FILTER (WHERE nth = 1) AS n_access,
  count(*) FILTER (WHERE nth = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY s, nth) FILTER (WHERE nth < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY s, nth), '') AS spans
FROM texts t LEFT JOIN named n ON t.doc_id = n.doc_id GROUP BY t.doc_id
"""

OP8 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), items AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT n FROM items
), grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, lengths WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, n, item_id FROM grams JOIN items USING (n, g)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP9 = r"""
WITH page AS (
  SELECT page_id, url, html, 1700000000 + page_id * 7 AS base,
    '"' || substring(md5(coalesce(html, '')), 1, 16) || '"' AS tag,
    'day ' || CAST((1700000000 + page_id * 7) // 86400 AS VARCHAR) AS day,
    regexp_replace(trim(url), '(?s)#.*$', '') AS plain
FROM pages), site AS (
  SELECT *, regexp_replace(lower(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g')
    || rtrim(regexp_extract(regexp_replace(plain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', ''), '(?s)^([^?]*)', 1), '/') AS head,
    list_sort(list_filter(string_split(regexp_extract(regexp_replace(plain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', ''), '(?s)\?(.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS query
  FROM page
), canonical AS (
  SELECT *, head || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS site FROM site
), visit AS (
  SELECT *, CAST('0x' || substring(md5(CAST(page_id AS VARCHAR) || ':' || CAST(v AS VARCHAR)), 1, 1) AS BIGINT) % 8 AS c FROM canonical, range(1, 4) t(v)
), revisit AS (
  SELECT page_id * 4 + v AS record_id, site, v, base + CASE WHEN c = 4 THEN -1000 ELSE v * 50000 END AS ts,
    CASE WHEN c = 0 THEN '"other"' WHEN c >= 4 THEN tag END AS etag,
    CASE WHEN c = 1 THEN day WHEN c = 2 THEN 'day 0' END AS modified
  FROM visit
), tied AS (
  SELECT r.record_id, max(p.page_id) AS page_id FROM revisit r JOIN (
    SELECT record_id, max(p.base) AS at FROM revisit r JOIN canonical p ON p.site = r.site AND p.base < r.ts GROUP BY record_id
  ) m USING (record_id) JOIN canonical p ON p.site = r.site AND p.base = m.at GROUP BY r.record_id
), checked AS (
  SELECT r.*, p.page_id, p.tag, p.day, p.html, CASE WHEN p.page_id IS NULL THEN 'orphan'
    WHEN r.etag IS NOT NULL THEN CASE WHEN r.etag = p.tag THEN 'resolved' ELSE 'mismatch' END
    WHEN r.modified IS NOT NULL THEN CASE WHEN r.modified = p.day THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unchecked' END AS state
  FROM revisit r LEFT JOIN tied t USING (record_id) LEFT JOIN canonical p ON p.page_id = t.page_id
)
SELECT record_id, site, state, page_id * 4 AS response_id,
  CASE WHEN state = 'resolved' THEN 'cache-control: max-age=' || CAST(v AS VARCHAR)
    || '|content-length: ' || CAST(strlen(html) AS VARCHAR) || '|content-type: text/html|date: ' || CAST(ts AS VARCHAR)
    || '|etag: ' || tag || '|last-modified: ' || day END AS headers,
  CASE WHEN state = 'resolved' THEN sha256(html) END AS payload_sha256
FROM checked
"""

OP10 = r"""
WITH n AS (
  SELECT source, count(*) AS n, pow(CAST(count(*) AS DOUBLE), 0.5) AS weight FROM documents GROUP BY source
), rate AS (
  SELECT source, weight * (sum(n) OVER () / CAST(sum(CAST(weight AS DECIMAL(38, 9))) OVER () AS DOUBLE)) / n AS rate FROM n
), parts AS (
  SELECT source, greatest(1, CAST(ceil(rate / 64) AS INT)) AS parts, rate / greatest(1, CAST(ceil(rate / 64) AS INT)) AS mean FROM rate
), terms AS (
  SELECT source, parts, k, exp(-mean) * coalesce(product(mean / i), 1) AS p FROM (
    SELECT source, parts, mean, k, unnest(CASE WHEN k = 0 THEN [NULL] ELSE range(1, k + 1) END) AS i
    FROM parts, range(0, 300) t(k) WHERE k <= ceil(mean + 12 * sqrt(mean) + 24)
  ) GROUP BY source, parts, mean, k
), cdf AS (
  SELECT source, parts, list(c ORDER BY k) AS cdf FROM (
    SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source, parts
), draw AS (
  SELECT doc_id, d.source, text, CAST(list_sum(list_transform(range(1, parts + 1), lambda part:
    len(list_filter(cdf, lambda c: c <= CAST(CAST('0x' || substring(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|'
      || CAST(part AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0)))) AS BIGINT) AS n_copies
  FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
)
SELECT doc_id, source, n_copies, copy, md5('mix|order|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || CAST(copy AS VARCHAR)) AS order_key,
  sha256(text) AS text_sha256
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM draw WHERE n_copies > 0)
"""



def _crc32(text: str) -> str:
    """The checksum of ASCII text: each character is one step that takes it in, and eight that shift a bit out."""
    return f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({text}, ''),
      lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""


# Overlaps of a text with itself are stretches of equal six-word runs at one distance; a run is an overlap and one period.
OP11 = f"""
WITH w AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents
), a AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM w
), p AS (
  SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM a
), texts AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_concat(w[1:a], list_transform(range(len(w) - a), lambda i: w[a + i % p + 1])) END AS w FROM p
), words AS (
  SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM texts
), grams AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - 5)) AS i FROM texts WHERE len(w) > 11)
), pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.g = b.g AND a.i < b.i
), chains AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS chain FROM pairs) GROUP BY doc_id, q, chain
), runs AS (
  SELECT doc_id, s, e - s AS n, min(q) AS q FROM chains WHERE e - s >= greatest(12, 2 * q) GROUP BY doc_id, s, e
), best AS (
  SELECT doc_id, count(*) AS n_runs, min({{'n': -n, 's': s, 'q': q}}) AS b,
    string_agg(CAST(s AS VARCHAR) || ',' || CAST(n AS VARCHAR) || ',' || CAST(q AS VARCHAR) || chr(10), '' ORDER BY s, q) AS runs
  FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs
), kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, -b.n AS length, b.q AS period, (-1000 * b.n) // b.q AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best ON d.doc_id = best.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

# A state is the last role (0: none, 1: system, 2: user, 3: assistant); "ins" are empty turns before a turn or at the end.
OP12 = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS c FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN c = 1 THEN '' WHEN c = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN c = 3 THEN 2 ELSE 1 END)) AS copy FROM given WHERE c <> 0
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS r, trim(text, {_BLANK}) AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM damaged
), turns AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
), ins(s, t, price, letters, said) AS (
  VALUES (0, 0, 0, '', ''), (0, 2, 2, 'I', 'user:' || chr(10)), (0, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    (1, 1, 0, '', ''), (1, 2, 2, 'I', 'user:' || chr(10)), (1, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    (2, 2, 0, '', ''), (2, 3, 2, 'I', 'assistant:' || chr(10)), (3, 3, 0, '', ''), (3, 2, 2, 'I', 'user:' || chr(10))
), edits(s, t, edit, r) AS (
  VALUES (0, 0, 'D', ''), (1, 1, 'D', ''), (2, 2, 'D', ''), (3, 3, 'D', ''), (0, 2, 'R', ''), (1, 2, 'R', ''), (2, 3, 'R', ''), (3, 2, 'R', ''),
    (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (3, 2, 'K', 'u'), (2, 3, 'K', 'a')
), best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {{'cost': 0, 'audit': '', 'said': ''}} AS b FROM counts
  UNION ALL
  SELECT b.conv_id, t.i, e.t, min({{'cost': b.b.cost + n.price + CASE e.edit WHEN 'K' THEN 0 WHEN 'R' THEN 2 ELSE 3 END
      + CASE WHEN t.fault = 'truncated' AND e.edit <> 'D' THEN 1 ELSE 0 END,
    'audit': b.b.audit || n.letters || e.edit,
    'said': b.b.said || n.said || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN t.role || ':' || t.text || chr(10)
      ELSE CASE e.t WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || t.text || chr(10) END}})
  FROM best b JOIN turns t ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = b.i + 1
    JOIN ins n ON n.s = b.s JOIN edits e ON e.s = n.t
  WHERE (e.edit = 'D' OR t.fault NOT IN ('blank', 'duplicate')) AND (e.edit <> 'K' OR e.r = t.r)
  GROUP BY b.conv_id, t.i, e.t
), last AS (
  SELECT b.conv_id, min({{'cost': b.b.cost + n.price, 'audit': b.b.audit || n.letters, 'said': b.b.said || n.said}}) AS b
  FROM best b JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n JOIN ins n ON n.s = b.s AND n.t IN (0, 3) GROUP BY b.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
  coalesce(b.audit, '') AS audit, sha256(coalesce(b.said[1:len(b.said) - 1], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN last l ON o.conv_id IS NOT DISTINCT FROM l.conv_id
"""

SQL = {
    "op1_line_dedup": OP1, "op2_near_dedup": OP2, "op3_substring_dedup": OP3, "op7_secret_scan": OP7,
    "op8_benchmark_decontamination": OP8,
    "op9_warc_revisits": OP9, "op10_poisson_mixing": OP10,
    "op11_periodic_runs": OP11, "op12_conversation_repair": OP12,
}
