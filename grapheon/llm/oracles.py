"""SQL for the queries whose results it can express: plain, without the methods, over the same tables."""

from __future__ import annotations

PRODUCTS = "list_reduce(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]), lambda x, y: x + y)"
FINITE = "vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

TOPK = f"""WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v FROM embeddings WHERE {FINITE}),
 s AS (SELECT q.vec_id AS query_id, r.vec_id, MAX({PRODUCTS.format(a='q.v', b='r.v')}) AS score FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
 SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score, CAST(score AS VARCHAR) AS exact_score
 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

NEIGHBOURS = f"""WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE {FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 n AS (SELECT *, sqrt({PRODUCTS.format(a='v', b='v')}) AS norm FROM v),
 s AS (SELECT q.vec_id AS query_id, r.vec_id, MAX({PRODUCTS.format(a='q.v', b='r.v')} / (q.norm * r.norm)) AS score FROM n q JOIN n r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
 SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

JACCARD = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 l AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS g FROM w),
 n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM l),
 s AS (SELECT doc_id, unnest(g) AS g FROM l),
 o AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
 r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y)
 SELECT n.doc_id, n.n AS n_shingles, c.component_id FROM n JOIN (SELECT x, MIN(y) AS component_id FROM r GROUP BY x) c ON c.x = n.doc_id"""

REPEATS = """WITH b AS (SELECT doc_id, encode(COALESCE(text, '')) AS t FROM documents),
 h AS (SELECT doc_id, i, md5(hex(array_slice(t, i, i + 99))) AS h FROM (SELECT doc_id, t, unnest(range(1, octet_length(t) - 98)) AS i FROM b)),
 g AS (SELECT doc_id, i FROM (SELECT doc_id, i, ROW_NUMBER() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM h) WHERE k > 1),
 m AS (SELECT doc_id, i, SUM(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS fresh FROM g)),
 r AS (SELECT doc_id, MIN(i) AS first, MAX(i) + 99 AS last FROM m GROUP BY doc_id, run),
 k AS (SELECT doc_id, first, COALESCE(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) + 1 AS a, first - 1 AS z FROM r UNION ALL SELECT b.doc_id, octet_length(t) + 1, COALESCE(MAX(last), 0) + 1, octet_length(t) FROM b LEFT JOIN r USING (doc_id) GROUP BY b.doc_id, octet_length(t)),
 p AS (SELECT doc_id, string_agg(CASE WHEN z >= a THEN hex(array_slice(t, a, z)) ELSE '' END, '' ORDER BY k.first) AS kept FROM k JOIN b USING (doc_id) GROUP BY doc_id),
 c AS (SELECT doc_id, SUM(last - first + 1) AS removed, COUNT(*) AS spans FROM r GROUP BY doc_id)
 SELECT b.doc_id, CAST(octet_length(t) AS BIGINT) AS n_bytes, CAST(COALESCE(removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
 FROM b JOIN p USING (doc_id) LEFT JOIN c USING (doc_id)"""


#: Private characters around a match: texts hold none.
OPEN, SHUT = "chr(57344)", "chr(57345)"


def _matches(source: str, text: str, pattern: str) -> str:
    """doc_id, pos (code points before it), m: the leftmost non-overlapping matches of a pattern, by marking them and splitting at the marks. source: doc_id, pos of the text."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, pos + CAST(COALESCE(SUM(length(part) - 1) OVER (PARTITION BY doc_id, pos ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) + CASE WHEN nth > 1 THEN 1 ELSE 0 END AS pos, string_split(part, {SHUT})[1] AS m, nth
 FROM (SELECT doc_id, pos, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS nth FROM (SELECT doc_id, pos, string_split(regexp_replace({text}, '({quoted})', {OPEN} || '\\1' || {SHUT}, 'g'), {OPEN}) AS parts FROM {source})) QUALIFY nth > 1"""


ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
VALUE = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[^0-9]*",
    r"[0-9+/=_-]*",
    r"(?i:.*(?:abcdefghij|0123456789|example|placeholder|xxxxxxxx).*)",
    r"(?:[A-Za-z]+[/_-])+[A-Za-z]*[0-9]{0,4}",
    r"/?(?:[A-Za-z0-9_-]{1,16}/)+[A-Za-z0-9_=-]{0,16}",
)


def _refused(c: str) -> str:
    return "NOT (" + " OR ".join(f"regexp_full_match({c}, '{p}')" for p in ALLOWED) + ")"


def _windows(kind: int, source: str, width: int, least: float) -> str:
    """Spans of the pieces that windows of so much entropy cover."""
    most = f"(log2({width}) - {least}) * {width} + 1e-9"
    entropy = f"list_sum(list_transform(list_distinct(string_split(s, '')), lambda c: ({width} - length(replace(s, c, ''))) * log2({width} - length(replace(s, c, '')))))"
    return f"""SELECT doc_id, MIN(a) AS a, {kind} AS kind, MAX(a) + {width} AS z FROM (SELECT *, SUM(fresh) OVER (PARTITION BY doc_id, pos ORDER BY a) AS run
 FROM (SELECT *, CASE WHEN a > lag(a) OVER (PARTITION BY doc_id, pos ORDER BY a) + {width} THEN 1 ELSE 0 END AS fresh
 FROM (SELECT doc_id, pos, pos + i - 1 AS a, substr(m, CAST(i AS BIGINT), {width}) AS s FROM (SELECT doc_id, pos, m, unnest(range(1, length(m) - {width} + 2)) AS i FROM {source})) WHERE {entropy} <= {most})) GROUP BY doc_id, pos, run"""


SECRETS = f"""WITH d AS (SELECT doc_id, COALESCE(text, '') AS text, CAST(0 AS BIGINT) AS pos FROM documents),
 b0 AS ({_matches('d', 'text', ASSIGN)}), b1 AS ({_matches('d', 'text', 'AKIA[A-Z0-9]+')}), b2 AS ({_matches('d', 'text', '[0-9a-f]+')}),
 base AS (SELECT doc_id, pos AS a, 0 AS kind, pos + length(m) AS z FROM b0 WHERE length(regexp_extract(m, '{VALUE.replace("'", "''")}', 1)) >= 6
  UNION ALL SELECT doc_id, pos, 1, pos + length(m) FROM b1 WHERE length(m) >= 20 UNION ALL SELECT doc_id, pos, 2, pos + length(m) FROM b2 WHERE length(m) >= 24),
 cand AS (SELECT doc_id, pos, m FROM ({_matches('d', 'text', '[A-Za-z0-9+/=_-]+')}) WHERE length(m) >= 20 AND {_refused('m')}),
 hexes AS (SELECT doc_id, pos, m FROM ({_matches('cand', 'm', '[0-9a-fA-F]+')}) WHERE length(m) >= 20),
 wide AS (SELECT * FROM cand WHERE length(m) >= 24),
 found AS ({_windows(3, 'hexes', 20, 2.9)} UNION ALL {_windows(4, 'wide', 24, 3.9)}),
 more AS (SELECT f.doc_id, f.a, f.kind, f.z FROM found f JOIN d USING (doc_id) WHERE {_refused('substr(d.text, f.a + 1, f.z - f.a)')}),
 named AS (SELECT doc_id, a, kind, z, list_extract(['assign', 'access', 'hex', 'entropy_hex', 'entropy_base64'], kind + 1) || ':' || a || ':' || z AS span FROM (SELECT * FROM base UNION ALL SELECT * FROM more)),
 g AS (SELECT doc_id, COUNT(*) FILTER (kind = 0) AS n0, COUNT(*) FILTER (kind = 1) AS n1, COUNT(*) FILTER (kind = 2) AS n2, COUNT(*) FILTER (kind > 2) AS n3,
  COALESCE(string_agg(span, ',' ORDER BY a, kind, z) FILTER (kind < 3), '') AS base, string_agg(span, ',' ORDER BY a, kind, z) AS spans FROM named GROUP BY doc_id)
 SELECT doc_id, COALESCE(n0, 0) AS n_assign, COALESCE(n1, 0) AS n_access, COALESCE(n2, 0) AS n_hex, COALESCE(n3, 0) AS n_entropy, sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""


def urls(rules: list[tuple[str, str]], levels: int = 8, weight: float = 8.0, z: float = 2.0, steps: int = 100, least: float = 0.5) -> str:
    """The path-template tree for paths of at most so many segments with labels below, level by level."""
    fits = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, _, path = rule.partition("/")
        fits.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN '{rule}'")
    general = r"""CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{n}' WHEN regexp_matches(s, '^[0-9]+\.[A-Za-z]+$') THEN '{n}.' || regexp_extract(s, '\.([A-Za-z]+)$', 1)
 WHEN regexp_matches(s, '^[0-9a-fA-F]{8}[0-9a-fA-F-]*$') THEN '{h}' WHEN regexp_matches(s, '[0-9]') OR length(s) > 32 THEN '{s}' ELSE s END"""
    ruled = " ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in rules)
    purity = f"(SUM(good) + {weight} * above) / (SUM(labelled) + {weight})"
    out = f"""WITH a AS (SELECT page_id, COALESCE(url, '') AS url FROM pages), r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM a),
 h AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM r), u0 AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM h),
 u1 AS (SELECT *, CASE {' '.join(fits)} END AS rule, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: {general}) AS segments FROM u0),
 u AS (SELECT *, CASE {ruled} END AS ruled, CASE CASE {ruled} END WHEN 'allow' THEN 1.0 WHEN 'block' THEN 0.0 END AS allowed, host || '/' || array_to_string(segments, '/') AS leaf FROM u1),
 l AS (SELECT leaf, any_value(host) AS node, any_value(segments) AS segments, COUNT(allowed) AS labelled, CAST(SUM(COALESCE(allowed, 0.0)) AS DOUBLE) AS good FROM u GROUP BY leaf),
 e AS (SELECT (COALESCE(SUM(good), 0.0) + {weight} * 0.5) / (COALESCE(SUM(labelled), 0) + {weight}) AS above FROM l),
 w AS (SELECT COALESCE(segments[1], '') AS segment, {purity} AS elsewhere FROM l, e GROUP BY 1, above),
 t AS (SELECT node, {purity} AS purity FROM l, e GROUP BY node, above),
 n0 AS (SELECT l.*, t.purity, false AS over_ FROM l JOIN t USING (node))"""
    for d in range(levels):
        above = "CASE WHEN b.labelled = 0 THEN elsewhere ELSE b.above END" if d == 0 else "b.above"
        blank = "node || '/' || segment" if d == 0 else "node || '/*'"
        test = f"pow(good / labelled - g1 / n1, 2) > {z} * {z} * ((g1 + good) / (n1 + labelled)) * (1 - (g1 + good) / (n1 + labelled)) * (1 / n1 + 1 / labelled)"
        out += f""",
 b{d} AS (SELECT b.node, b.segment, b.labelled, b.good, {above} AS above, CASE WHEN b.labelled > 0 THEN floor(b.good * {steps} / b.labelled) END AS share FROM (SELECT node, segments[{d + 1}] AS segment, SUM(labelled) AS labelled, SUM(good) AS good, any_value(purity) AS above FROM n{d} WHERE len(segments) > {d} AND NOT over_ GROUP BY 1, 2) b JOIN w ON {'w.segment = b.segment' if d == 0 else 'w.segment = (SELECT MIN(segment) FROM w)'}),
 s{d} AS (SELECT node, share, SUM(labelled) AS labelled, SUM(good) AS good, COUNT(*) AS members, any_value(above) AS above FROM b{d} WHERE labelled > 0 GROUP BY 1, 2),
 g{d} AS (SELECT *, SUM(apart) OVER (PARTITION BY node ORDER BY share) AS part FROM (SELECT *, CASE WHEN n1 IS NOT NULL AND {test} THEN 1 ELSE 0 END AS apart FROM (SELECT *, lag(labelled) OVER (PARTITION BY node ORDER BY share) AS n1, lag(good) OVER (PARTITION BY node ORDER BY share) AS g1 FROM s{d}))),
 m{d} AS (SELECT node, part, {purity} AS purity, SUM(members) AS members FROM g{d} GROUP BY node, part, above),
 x{d} AS (SELECT b.node, b.segment, CASE WHEN b.labelled = 0 THEN {blank.replace('node', 'b.node').replace('segment', 'b.segment')} WHEN m.members = 1 THEN b.node || '/' || b.segment ELSE b.node || '/*' || CAST(m.part AS BIGINT) END AS target, CASE WHEN b.labelled = 0 THEN b.above ELSE m.purity END AS purity, b.labelled = 0 AS over_
  FROM b{d} b LEFT JOIN g{d} g ON g.node = b.node AND g.share = b.share LEFT JOIN m{d} m ON m.node = g.node AND m.part = g.part),
 n{d + 1} AS (SELECT n.leaf, x.target AS node, n.segments, n.labelled, n.good, x.purity, x.over_ FROM n{d} n JOIN x{d} x ON x.node = n.node AND x.segment = n.segments[{d + 1}] WHERE len(n.segments) > {d} AND NOT n.over_)"""
    ends = " UNION ALL ".join(f"SELECT leaf, node || '/' AS template, purity FROM n{d} WHERE len(segments) = {d} OR over_" for d in range(levels + 1))
    return out + f""", k AS ({ends})
 SELECT page_id, host, path, rule, COALESCE(ruled, CASE WHEN purity < {least} THEN 'block' ELSE 'allow' END) AS verdict, template, purity FROM u JOIN k USING (leaf)"""


INFILL = """WITH t AS (SELECT doc_id, COALESCE(text, '') AS t, sha256('1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
 d AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
 c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
 p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
 SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

LEXICAL = r"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
 s AS (SELECT CAST(COUNT(*) FILTER (len(w) > 0) AS BIGINT) AS nn, CAST(SUM(len(w)) AS BIGINT) AS ll FROM d),
 q AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
 qt AS (SELECT item, item_id, term, COUNT(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM q) GROUP BY ALL),
 p AS (SELECT row, doc_id, len(w) AS n, term, COUNT(*) AS tf FROM (SELECT row, doc_id, w, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
 f AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(nn) + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY term),
 i AS (SELECT row, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // ll)) AS impact FROM p, s),
 r AS (SELECT item, item_id, row, doc_id, CAST(SUM(times * weight * impact) AS BIGINT) AS score FROM qt JOIN f USING (term) JOIN i USING (term) GROUP BY ALL)
 SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0) WHERE rank <= 20"""

EXACT = r"""WITH d AS (SELECT doc_id, length(COALESCE(text, '')) AS n, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents)
 SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST) AS keep_id, COUNT(*) OVER (PARTITION BY t) AS group_size, ROW_NUMBER() OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM d"""

SQL = {"op11_infill": INFILL, "op12_lexical": LEXICAL, "op13_exact": EXACT, "op1_secrets": SECRETS, "op3_repeats": REPEATS, "op6_jaccard": JACCARD, "op7_topk": TOPK, "op8_neighbours": NEIGHBOURS}
