"""DuckDB SQL for the results that SQL can express."""

from __future__ import annotations

from . import linedup, pii, secretscan

_WORDS = r"list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER.format(text="text"))} AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM w),
k AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN sha256(array_to_string(s, '|')) END AS k, s FROM s),
c AS (SELECT k, min(doc_id) AS id, any_value(n) AS n, any_value(s) AS s, count(doc_id) AS copies FROM k WHERE k IS NOT NULL GROUP BY k),
e AS (SELECT id, n, unnest(s) AS g FROM c),
p AS (SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.g = b.g AND a.id < b.id
      GROUP BY a.id, b.id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT id AS node, id AS reached FROM c UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a),
m AS (SELECT node, min(reached) AS component FROM r GROUP BY node),
d AS (SELECT l.a AS node, sum(c.copies) AS links FROM l JOIN c ON l.b = c.id GROUP BY l.a)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(m.component, k.doc_id) AS component_id, CAST(coalesce(c.copies - 1, 0) + coalesce(d.links, 0) AS BIGINT) AS n_links
FROM k LEFT JOIN c ON k.k = c.k LEFT JOIN m ON m.node = c.id LEFT JOIN d ON d.node = c.id
"""


def _found(name: str, pattern: str) -> str:
    """struct(s, e, v) of all matches, from the gaps that a split leaves."""
    q = pattern.replace("'", "''")
    return f"""{name}_m AS (SELECT *, regexp_extract_all(t, '{q}') AS m, string_split_regex(t, '{q}') AS g FROM t),
{name} AS (SELECT rid, list_transform(range(1, len(m) + 1), lambda i: {{'s': CAST(list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i-1], lambda y: length(y))), 0) AS BIGINT), 'v': m[i]}}) AS f FROM {name}_m)"""


_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

OP2 = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, source AS owner, concat_ws('/', source, lang) AS repo FROM documents),
{_found("assign", _ASSIGN)}, {_found("access", "AKIA[A-Z0-9]+")}, {_found("hex", "[0-9a-f]+")},
x AS (
  SELECT rid, 0 AS k, y.s AS s, y.v AS v, regexp_extract(y.v, '{_ASSIGN.replace("'", "''")}', 2) AS val FROM (SELECT rid, unnest(f) AS y FROM assign)
  UNION ALL SELECT rid, 1, y.s, y.v, y.v FROM (SELECT rid, unnest(f) AS y FROM access) WHERE length(y.v) >= 18
  UNION ALL SELECT rid, 2, y.s, y.v, y.v FROM (SELECT rid, unnest(f) AS y FROM hex) WHERE length(y.v) >= 16),
y AS (SELECT x.*, s + length(v) AS e, length(val) AS n, t.owner, t.repo,
  regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]') AND len(list_distinct(string_split(val, ''))) >= 8 AND NOT regexp_matches(val, '{secretscan.PLACEHOLDER}') AS looks
  FROM x JOIN t USING (rid) WHERE length(val) >= 12),
o AS (SELECT val, count(DISTINCT coalesce(owner, '')) >= {secretscan.EXAMPLE_OWNERS} AS example, count(DISTINCT coalesce(repo, '')) AS repos FROM y GROUP BY val),
j AS (SELECT y.*, o.example, o.repos, y.looks AND NOT o.example AS live FROM y JOIN o USING (val)),
a AS (SELECT DISTINCT rid, s, k, e FROM j UNION SELECT rid, e - n, 3, e FROM j WHERE live),
b AS (SELECT rid, sum(CAST(k = 0 AS INT)) AS n0, sum(CAST(k = 1 AS INT)) AS n1, sum(CAST(k = 2 AS INT)) AS n2, sum(CAST(live AS INT)) AS nl, sum(CAST(example AS INT)) AS ne, max(CASE WHEN live THEN repos END) AS lr,
  string_agg(['assign', 'access', 'hex'][k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) AS base FROM j GROUP BY rid),
c AS (SELECT rid, string_agg(['assign', 'access', 'hex', 'live'][k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS spans FROM a GROUP BY rid)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access, CAST(coalesce(n2, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, CAST(coalesce(nl, 0) AS BIGINT) AS n_live, CAST(coalesce(ne, 0) AS BIGINT) AS n_example, CAST(coalesce(lr, 0) AS BIGINT) AS live_repos
FROM t LEFT JOIN b USING (rid) LEFT JOIN c USING (rid)
"""

_BYTE = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({_DIGITS})[i] AS INT)
  WHEN 2 * CAST(reverse({_DIGITS})[i] AS INT) > 9 THEN 2 * CAST(reverse({_DIGITS})[i] AS INT) - 9 ELSE 2 * CAST(reverse({_DIGITS})[i] AS INT) END)) % 10 = 0"""
_MOVED = "(substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4))"
_MOD97 = f"CAST(array_to_string(list_transform(string_split({_MOVED}, ''), lambda c: CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), '') AS VARCHAR)"
#: An IBAN's digits are too many for a number: the remainder of its first 30 digits goes before the rest.
_REST = f"CAST(CAST(CAST(substr({_MOD97}, 1, 30) AS HUGEINT) % 97 AS VARCHAR) || substr({_MOD97}, 31) AS HUGEINT)"


def _op3() -> str:
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", rf"regexp_full_match(v, '{_BYTE}(\.{_BYTE}){{3}}')"),
        "card": (r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
        "iban": (r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", f"{_REST} % 97 = 1"),
    }
    near = f"lower(substr(t, greatest(s - {pii.CONTEXT_WIDTH}, 0) + 1, least(s, {pii.CONTEXT_WIDTH})) || ' ' || substr(t, s + length(v) + 1, {pii.CONTEXT_WIDTH}))"
    parts = [
        f"SELECT rid, {i} AS k, '{kind}' AS name, s, s + length(v) AS e, {pii.SCORES[kind]} + CASE WHEN regexp_matches({near}, '{pii.CONTEXT[kind]}') THEN {pii.CONTEXT_BONUS} ELSE 0 END AS score FROM (SELECT rid, y.s AS s, y.v AS v FROM (SELECT rid, unnest(f) AS y FROM {kind})) JOIN t USING (rid) WHERE {test}"
        for i, (kind, (_, test)) in enumerate(kinds.items())
    ]
    counts = ", ".join(f"CAST(coalesce(n{i}, 0) AS BIGINT) AS n_{kind}" for i, kind in enumerate(kinds))
    sums = ", ".join(f"sum(CAST(k = {i} AS INT)) AS n{i}" for i in range(5))
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{", ".join(_found(kind, pattern) for kind, (pattern, _) in kinds.items())},
x AS ({" UNION ALL ".join(parts)}),
b AS (SELECT rid, {sums}, string_agg(name || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4) AS base, string_agg(name || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans,
  string_agg(CAST(CAST(round(score, 2) AS DOUBLE) AS VARCHAR), ',' ORDER BY k, s) AS scores FROM x GROUP BY rid)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM t LEFT JOIN b USING (rid)
"""


OP3 = _op3()

OP4 = rf"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM w WHERE len(w) >= 50),
h AS (SELECT doc_id, p, md5(array_to_string(w[p:p+49], ' ')) AS h FROM v),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
r AS (SELECT doc_id, p FROM h JOIN f USING (h) WHERE first < doc_id),
g AS (SELECT DISTINCT doc_id, p + unnest(range(0, 50)) AS p FROM r),
k AS (SELECT doc_id, list(p) AS gone FROM g GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
s AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS d FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS keeper FROM s)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND keeper <> page_id THEN keeper END AS refers_to FROM m
"""

OP8 = rf"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(l))) AS p, l FROM l WHERE len(l) >= 2),
h AS (SELECT doc_id, p, l[p] || chr(10) || l[p + 1] AS h FROM p),
e AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1), f AS (SELECT h.* FROM h SEMI JOIN e USING (h)),
m AS (SELECT f.doc_id, f.p, len(a.l) - f.p + 1 AS most, len(b.l) - g.p + 1 AS theirs, a.l[f.p:] AS x, b.l[g.p:] AS y FROM f JOIN f g ON f.h = g.h AND (g.doc_id < f.doc_id OR g.doc_id = f.doc_id AND g.p < f.p) JOIN l a ON a.doc_id = f.doc_id JOIN l b ON b.doc_id = g.doc_id),
c AS (SELECT doc_id, p - 1 AS p, max(coalesce(list_position(list_transform(range(1, least(most, theirs) + 1), lambda i: x[i] = y[i]), false) - 1, least(most, theirs))) AS n FROM m GROUP BY doc_id, p),
o AS (SELECT doc_id, p, l FROM (SELECT doc_id, unnest(range(0, len(l))) AS p, unnest(l) AS l FROM l) WHERE len({_WORDS.format(text="l")}) >= {linedup.PASSAGE}),
oo AS (SELECT doc_id, p, row_number() OVER (PARTITION BY l ORDER BY doc_id, p) AS n FROM o),
u AS (SELECT doc_id, p, max(n) AS n FROM (SELECT * FROM c UNION ALL SELECT doc_id, p, 1 FROM oo WHERE n > 1) GROUP BY doc_id, p),
i AS (SELECT *, coalesce(max(p + n) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u),
r AS (SELECT * FROM i WHERE p + n > before),
k AS (SELECT doc_id, CAST(sum(p + n - greatest(p, before)) AS BIGINT) AS n, string_agg(p || ':' || n, ',' ORDER BY p) AS runs, flatten(list(range(p, p + n))) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, coalesce(k.n, 0) AS n_deleted, coalesce(runs, '') AS runs,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN l ELSE list_transform(list_filter(range(0, len(l)), lambda x: NOT list_contains(gone, x)), lambda x: l[x + 1]) END, chr(10))) AS kept_sha256
FROM l LEFT JOIN k USING (doc_id)
"""

ORACLES = {"op1_ngram_jaccard_join": OP1, "op2_secret_scan": OP2, "op3_pii_scan": OP3, "op4_substring_dedup": OP4, "op6_warc_captures": OP6, "op8_line_dedup": OP8}
