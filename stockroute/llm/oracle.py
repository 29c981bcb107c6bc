"""DuckDB SQL for the queries that SQL can express (driver tables as views)."""

from __future__ import annotations

import re

from .licenses import TEMPLATES

# Host and path by the contract's words; the longest of the four fixed rules.
URL_FILTER = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), hits AS (
  SELECT s.*, r.verdict, r.rhost || r.rpath AS rule,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rhost || r.rpath) DESC) AS rn
  FROM split s LEFT JOIN rules r
    ON (s.host = r.rhost OR ends_with(s.host, '.' || r.rhost)) AND starts_with(s.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hits WHERE rn = 1
"""

# Counts from lists of words, lines and windows; common lines per host and in the
# corpus over distinct texts; a document fails alone or when too little of it is
# left. No near copies are set aside here: the same rule where a host has no 20 of
# them, as in the given tables up to sf0.01 (tests hold the rest to plain Python).
QUALITY = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), places AS (
  SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS p FROM docs WHERE len(words) >= 5
), windows AS (
  SELECT doc_id, p, hash(words[p], words[p + 1], words[p + 2], words[p + 3], words[p + 4]) AS w FROM places
), twice AS (
  SELECT doc_id, w FROM windows GROUP BY doc_id, w HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, p FROM windows SEMI JOIN twice USING (doc_id, w)
), covered AS (
  SELECT doc_id, count(DISTINCT p + o) AS n
  FROM repeated, (SELECT unnest([0, 1, 2, 3, 4]) AS o) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, text, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS words,
         regexp_replace(lower(array_to_string(regexp_extract_all(l, '[^\x20\x09-\x0D]+'), ' ')), '[0-9]+', '0', 'g') AS line
  FROM (SELECT doc_id, source, text, unnest(lines) AS l FROM docs)
), hosts AS (
  SELECT source, count(DISTINCT text) AS docs FROM lines GROUP BY source
), wide AS (
  SELECT line FROM lines WHERE words >= 4 GROUP BY line
  HAVING count(DISTINCT text) >= 100 AND count(DISTINCT text) > 0.01 * (SELECT count(DISTINCT text) FROM lines)
), common AS (
  SELECT l.source, l.line FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.line, h.docs
  HAVING count(DISTINCT l.text) >= 20 AND (count(DISTINCT l.text) > 0.10 * h.docs
                                           OR (max(l.words) >= 4 AND count(DISTINCT l.text) > 1000))
  UNION
  SELECT DISTINCT source, line FROM lines SEMI JOIN wide USING (line)
), lost AS (
  SELECT l.doc_id, sum(l.words) AS n FROM lines l
  JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.line = c.line GROUP BY l.doc_id
), counts AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, coalesce(t.n, 0) AS lost
  FROM docs d LEFT JOIN covered c USING (doc_id) LEFT JOIN lost t USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND n_words - lost >= 0.20 * n_words AS kept,
       CAST(lost AS BIGINT) AS n_common_words
FROM counts
"""

# Windows of 20 words compared by hash; each word under a window that starts
# earlier elsewhere goes.
SUBSTRING_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), words AS MATERIALIZED (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS p FROM docs
), h2 AS (
  SELECT doc_id, p, hash(word, lead(word) OVER d) AS h FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), h4 AS (
  SELECT doc_id, p, hash(h, lead(h, 2) OVER d) AS h4 FROM h2 WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), h8 AS (
  SELECT doc_id, p, h4, hash(h4, lead(h4, 4) OVER d) AS h8 FROM h4 WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), h16 AS (
  SELECT doc_id, p, h4, hash(h8, lead(h8, 8) OVER d) AS h16 FROM h8 WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), windows AS MATERIALIZED (
  SELECT doc_id, p, w FROM (
    SELECT doc_id, p, hash(h16, lead(h4, 16) OVER d) AS w, lead(p, 19) OVER d AS last
    FROM h16 WINDOW d AS (PARTITION BY doc_id ORDER BY p))
  WHERE last IS NOT NULL
), firsts AS (
  SELECT w, min((doc_id, p)) AS first FROM windows GROUP BY w HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, p + o AS p
  FROM windows JOIN firsts USING (w), (SELECT unnest(generate_series(0, 19)) AS o)
  WHERE (doc_id, p) <> first
), cut AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM (SELECT doc_id, words FROM docs) LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Shingles of two words compared as text; links by counting shared shingles;
# components by walking the links.
NEAR_DEDUP = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(s) AS s FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 1 THEN words
             ELSE list_transform(generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1]) END) AS s
    FROM docs)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), places AS MATERIALIZED (
  SELECT doc_id, n, s, row_number() OVER (PARTITION BY doc_id ORDER BY often, s) AS r
  FROM shingles JOIN sizes USING (doc_id) JOIN (SELECT s, count(*) AS often FROM shingles GROUP BY s) USING (s)
), near AS (
  -- Sets this similar share one of their rarest fifth of shingles.
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny
  FROM places a JOIN places b ON a.s = b.s AND a.doc_id < b.doc_id
    AND a.r <= a.n - ceil(0.8 * a.n) + 1 AND b.r <= b.n - ceil(0.8 * b.n) + 1
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), links AS MATERIALIZED (
  SELECT x, y FROM near JOIN shingles a ON a.doc_id = x JOIN shingles b ON b.doc_id = y AND b.s = a.s
  GROUP BY x, y, nx, ny HAVING 100 * count(*) >= 80 * (nx + ny - count(*))
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), walk(doc_id, top) AS (
  SELECT DISTINCT x, x FROM both_ways
  UNION
  SELECT b.y, w.top FROM walk w JOIN both_ways b ON b.x = w.doc_id WHERE w.top < b.y
), tops AS (
  SELECT doc_id, min(top) AS top FROM walk GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, coalesce(t.top, d.doc_id) AS component_id,
       coalesce(t.top, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN sizes z USING (doc_id) LEFT JOIN tops t USING (doc_id)
"""

# --- fixed values: kind, place, part of a credential, strong, pattern, group, least length of the group ---
SECRET_KINDS = [
    ("assign", 0, "secret", True, r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
     r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", 1, "id", True, "AKIA[A-Z0-9]+", 0, 18),
    ("hex", 2, "secret", True, "[0-9a-f]{16,}", 0, 16),
    ("login", 3, "id", False, r"(?:[Cc][Ll][Ii][Ee][Nn][Tt]_[Ii][Dd]|[Uu][Ss][Ee][Rr][Nn][Aa][Mm][Ee]"
     r"|[Aa][Cc][Cc][Ee][Ss][Ss]_[Kk][Ee][Yy]_[Ii][Dd]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Ll][Oo][Gg][Ii][Nn]|[Uu][Ss][Ee][Rr])"
     r"[\"\x27]?\x20*[:=]\x20*[\"\x27]?[A-Za-z0-9_.@-]{3,}", 0, 0),
    ("random", 4, "secret", False, "[A-Za-z0-9+/_=-]{20,}", 0, 0),
    ("endpoint", 5, "endpoint", False, r"(?:[a-z]{2,12}://[A-Za-z0-9.-]{3,}(?::[0-9]{1,5})?"
     r"|[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,5}:[0-9]{2,5})", 0, 0),
]
# --- end of fixed values ---


def _spans(kind: str, place: int, part: str, strong: bool, pattern: str, group: int, least: int) -> str:
    """Matches with their starts, from the pieces between them."""
    return f"""SELECT doc_id, '{kind}' AS kind, {place} AS place, '{part}' AS part, {strong} AS strong,
         len(array_to_string(gaps[1 : i], '')) + len(array_to_string(hits[1 : i - 1], '')) AS s, hits[i] AS hit
  FROM (SELECT *, unnest(generate_series(1, len(hits))) AS i FROM (
    SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits,
           regexp_extract_all(text, '{pattern}', {group}) AS parts FROM docs WHERE regexp_matches(text, '{pattern}')))
  WHERE len(parts[i]) >= {least}"""


# Each kind's spans; weak ones that overlap no strong one and have a complement
# that starts within 300 characters.
SECRET_SCAN = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), spans AS MATERIALIZED (
  SELECT *, s + len(hit) AS e FROM (
  """ + "\n  UNION ALL ".join(_spans(*k) for k in SECRET_KINDS) + r""")
  WHERE kind <> 'random' OR (regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]'))
), parts AS MATERIALIZED (
  SELECT * FROM spans w WHERE strong OR NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.strong AND b.doc_id = w.doc_id AND b.s < w.e AND w.s < b.e)
), seen AS (
  SELECT w.doc_id, w.kind, w.place, w.part, w.s, w.e,
         bool_or(n.part = 'id') AS id, bool_or(n.part = 'secret') AS secret, bool_or(n.part = 'endpoint') AS endpoint
  FROM parts w JOIN parts n ON n.doc_id = w.doc_id AND abs(n.s - w.s) <= 300
  WHERE NOT w.strong GROUP BY ALL
), chosen AS (
  SELECT doc_id, kind, place, s, e, TRUE AS base FROM spans WHERE strong
  UNION ALL
  SELECT doc_id, kind, place, s, e, FALSE FROM seen
  WHERE (part = 'id' AND secret) OR (part = 'secret' AND (id OR endpoint)) OR (part = 'endpoint' AND id AND secret)
), lists AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (base) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans
  FROM chosen GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN lists USING (doc_id)
"""


def template_pattern(template: str) -> str:
    """A template as a regular expression over words with a blank before each."""
    out = []
    for part in re.split(r"(\[\[|\]\]|<<\d+\.\.\d+>>)", template):
        if part == "[[":
            out.append("(?:")
        elif part == "]]":
            out.append(")?")
        elif part.startswith("<<"):
            out.append("(?: [^ ]+){%s,%s}" % tuple(re.findall(r"\d+", part)))
        else:
            out += [" " + w for w in re.findall("[a-z0-9]+", part.lower())]
    return "".join(out) + " "


# Phrases at word places; templates as regular expressions over the joined words.
LICENSES = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS joined FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents)
), phrases(phrase, label) AS (
  VALUES (['mit', 'license'], 'mit'), (['apache', 'license'], 'apache'), (['general', 'public', 'license'], 'gpl')
), places AS (
  SELECT doc_id, label, unnest(list_filter(generate_series(0, len(words) - len(phrase)),
         lambda i: words[i + 1 : i + len(phrase)] = phrase)) AS place
  FROM docs, phrases WHERE strpos(joined, ' ' || array_to_string(phrase, ' ') || ' ') > 0
), base AS (
  SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM places GROUP BY doc_id
), templates(label, pattern) AS (
  VALUES """ + ", ".join(f"('{label}', '{template_pattern(t)}')" for label, t in TEMPLATES) + r"""
), fits AS (
  SELECT DISTINCT doc_id, label FROM docs, templates
  WHERE strpos(joined, regexp_extract(pattern, '^ [a-z0-9]+ ?')) > 0 AND regexp_matches(joined, pattern)
), every AS (
  SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, bool_or(fit) AS fit FROM (
    SELECT doc_id, label, TRUE AS fit FROM fits UNION ALL SELECT doc_id, label, FALSE FROM places) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels,
       coalesce(e.labels, '') AS labels,
       CAST(CASE WHEN e.fit THEN 1.0 WHEN b.n > 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score
FROM docs d LEFT JOIN base b USING (doc_id) LEFT JOIN every e USING (doc_id)
"""

# Units as a list; prefix, middle and suffix as joined parts of it.
FILL_MIDDLE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM docs
), parts AS (
  SELECT *, array_to_string(units[1 : least(x, y)], '') AS p, array_to_string(units[least(x, y) + 1 : greatest(x, y)], '') AS m,
         array_to_string(units[greatest(x, y) + 1 : len(units)], '') AS s
  FROM drawn
)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

# Every document with every item that it shares a term with.
RANKED_SEARCH = r"""
WITH docs AS MATERIALIZED (
  SELECT * FROM (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL)
  WHERE len(terms) > 0
), items AS MATERIALIZED (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, term
), totals AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS terms FROM docs
), tfs AS MATERIALIZED (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
  SEMI JOIN items USING (term) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * t.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals t GROUP BY term, t.docs
), lengths AS (
  SELECT r, doc_id, 25 + (75 * len(d.terms) * t.docs) // t.terms AS m FROM docs d, totals t
), scores AS (
  SELECT item_id, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_url_filter": URL_FILTER,
    "op4_minhash_dedup": NEAR_DEDUP,
    "op7_quality_rules": QUALITY,
    "op9_secret_scan": SECRET_SCAN,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op11_license_scan": LICENSES,
    "op12_fill_middle": FILL_MIDDLE,
    "op13_ranked_search": RANKED_SEARCH,
}
