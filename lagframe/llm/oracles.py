"""DuckDB SQL of the contract queries that SQL can express."""

from __future__ import annotations

from . import urls as U


LEVEL = """
held{i} AS (SELECT host, template, parts[{j}] AS segment, sum(n) AS held FROM t{i} WHERE parts[{j}] IS NOT NULL GROUP BY ALL),
often{i} AS (SELECT host, template, segment FROM (SELECT *, sum(held) OVER (PARTITION BY host, template) AS whole FROM held{i})
  WHERE held >= {min_count} AND held >= {min_share} * whole),
t{j} AS (SELECT t.host, t.path, t.ruled, t.n, t.parts,
  CASE WHEN t.parts[{j}] IS NULL THEN t.template ELSE t.template || '/' || coalesce(o.segment, '*') END AS template
  FROM t{i} t LEFT JOIN often{i} o ON o.host = t.host AND o.template = t.template AND o.segment = t.parts[{j}])"""


def url_filter(rules) -> str:
    fits = [(f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '{below}')", at + below, kind) for kind, at, below in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    rule = " ".join(f"WHEN {f} THEN '{name}'" for f, name, _ in fits)
    kind = " ".join(f"WHEN {f} THEN '{k}'" for f, _, k in fits)
    levels = ",".join(LEVEL.format(i=i, j=i + 1, min_count=U.MIN_COUNT, min_share=U.MIN_SHARE) for i in range(U.DEPTH))
    upper, lower = U.string.ascii_uppercase, U.string.ascii_lowercase
    return f"""
WITH seen AS (SELECT page_id, coalesce(translate(regexp_extract(url, '{U.ADDRESS}', 1), '{upper}', '{lower}'), '') AS host,
    coalesce(regexp_extract(url, '{U.ADDRESS}', 2), '') AS path FROM pages),
ruled AS (SELECT *, CASE {rule} END AS rule, CASE {kind} END AS ruled FROM seen),
t0 AS (SELECT host, path, ruled, count(*) AS n, [s FOR s IN string_split(path, '/') IF s <> ''] AS parts, '' AS template FROM ruled GROUP BY ALL),
{levels},
tree AS (SELECT host, path, ruled, n, template || CASE WHEN len(parts) > {U.DEPTH} THEN '/**' ELSE '' END AS template FROM t{U.DEPTH}),
labels AS (SELECT host, template, sum(CASE WHEN ruled IS NOT NULL THEN n ELSE 0 END) AS known, sum(CASE WHEN ruled = 'block' THEN n ELSE 0 END) AS blocked FROM tree GROUP BY ALL),
every AS (SELECT (sum(blocked) + {U.STRENGTH}::DOUBLE * 0.5::DOUBLE) / (sum(known) + {U.STRENGTH}::DOUBLE) AS share FROM labels),
pooled AS (SELECT template, sum(known) AS met, (sum(blocked) + {U.STRENGTH}::DOUBLE * any_value(share)) / (sum(known) + {U.STRENGTH}::DOUBLE) AS pooled FROM labels, every GROUP BY template),
branches AS (SELECT *, sum(known) OVER n AS every_known, sum(blocked) OVER n AS every_blocked FROM (SELECT *, regexp_replace(template, '/[^/]*$', '') AS node FROM labels)
  WINDOW n AS (PARTITION BY host, node)),
sorted AS (SELECT *, known > 0 AND NOT (every_blocked > 0 AND every_blocked < every_known AND abs(blocked - known * (every_blocked / greatest(every_known, 1)))
  >= {U.Z}::DOUBLE * sqrt(known * (every_blocked / greatest(every_known, 1)) * (1 - every_blocked / greatest(every_known, 1)))) AS alike FROM branches),
common AS (SELECT host, template, CASE WHEN alike THEN sum(known) FILTER (alike) OVER n ELSE known END AS known, CASE WHEN alike THEN sum(blocked) FILTER (alike) OVER n ELSE blocked END AS blocked
  FROM sorted WINDOW n AS (PARTITION BY host, node)),
judged AS (SELECT host, template, coalesce(CASE WHEN known > 0 AND abs(blocked - known * pooled) >= {U.Z}::DOUBLE * sqrt(known * pooled * (1 - pooled))
    THEN (blocked + {U.STRENGTH}::DOUBLE * pooled) / (known + {U.STRENGTH}::DOUBLE) WHEN known > 0 OR (met > 0 AND regexp_matches(template, '[^/*]')) THEN pooled END, 0) AS purity FROM common JOIN pooled USING (template)),
found AS (SELECT DISTINCT host, path, template, CASE WHEN purity >= {U.REJECT_AT}::DOUBLE THEN 'block' ELSE 'allow' END AS method FROM tree JOIN judged USING (host, template))
SELECT page_id, host, path, rule, coalesce(ruled, method) AS verdict, template FROM ruled JOIN found USING (host, path)
"""


MIX = """
WITH d AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':7'), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight, 3 * source_size::DOUBLE AS cap FROM s),
f AS (SELECT *, ((SELECT sum(source_size)::DOUBLE FROM s) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, (SELECT max(level) FROM f) * weight) AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS repeats FROM t),
q AS (SELECT *, floor(repeats)::BIGINT AS whole, repeats - floor(repeats) AS p, target - floor(repeats) * source_size::DOUBLE AS missing FROM p),
o AS (SELECT d.*, source_size, target, whole, missing, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds FROM d JOIN q ON q.source IS NOT DISTINCT FROM d.source),
r AS (SELECT *, CASE WHEN odds IS NOT NULL AND sum(size) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE <= missing THEN 1 ELSE 0 END AS drawn FROM o),
g AS (SELECT *, missing - sum(drawn * size) OVER (PARTITION BY source)::DOUBLE AS gap FROM r),
c AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN odds IS NOT NULL AND drawn = CASE WHEN gap > 0 THEN 0 ELSE 1 END AND abs(size - abs(gap)) < abs(gap)
    THEN abs(size - abs(gap)) END NULLS LAST, odds, doc_id) AS near FROM g)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM (SELECT *, whole + CASE WHEN near = 1 AND odds IS NOT NULL
    AND drawn = CASE WHEN gap > 0 THEN 0 ELSE 1 END AND abs(size - abs(gap)) < abs(gap) THEN 1 - drawn ELSE drawn END AS copies FROM c)
"""


TOP_K = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
    FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 199)) AS pos, h FROM d WHERE length(h) >= 400),
g AS (SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 400)) AS g FROM w),
r AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY g) AS met FROM g) WHERE met > 1),
s AS (SELECT doc_id, pos, CASE WHEN pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 200 THEN 1 ELSE 0 END AS new,
    row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM r),
t AS (SELECT doc_id, pos, sum(CASE WHEN k = 1 THEN 1 ELSE new END) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM s),
spans AS (SELECT doc_id, span, min(pos) AS lo, max(pos) + 200 AS hi FROM t GROUP BY ALL),
gaps AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM spans),
kept AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS behind, list({'since': since, 'lo': lo} ORDER BY lo) AS parts FROM gaps GROUP BY doc_id),
cut AS (SELECT d.doc_id, h, n_removed, n_spans, coalesce(list_aggregate([substr(h, 2 * p.since + 1, 2 * (p.lo - p.since)) FOR p IN parts], 'string_agg', ''), '') || substr(h, 2 * behind + 1) AS rest
    FROM d JOIN kept k ON k.doc_id = d.doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(rest)) AS kept_sha256 FROM cut
UNION ALL
SELECT doc_id, (length(h) // 2)::BIGINT, 0::BIGINT, 0::BIGINT, sha256(unhex(h)) FROM d WHERE doc_id NOT IN (SELECT doc_id FROM kept)
"""

NEAR = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 75 * (x.n + y.n - met)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, a nibble at a time."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    nibbles = f"list_reduce([ascii(x) FOR x IN string_split({text}, '')], lambda c, b: {{step}}, 4294967295::BIGINT)"
    one = lambda c: f"xor(({table}::BIGINT[])[(({c}) & 15) + 1], ({c}) >> 4)"
    return f"xor({nibbles.format(step=one(one('xor(c, b::BIGINT)')))}, 4294967295::BIGINT)"


def _repair() -> str:
    def edit(state, letter, cost, line=None):
        written = f"|| chr(10) || {line}" if line else ""
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o {written}}}"

    def given(when, *edits):
        return f"CASE WHEN {when} THEN [{', '.join(edits)}] ELSE [] END"

    def best(*lists):
        return f"list_sort(list_concat({', '.join(lists)}))[1]"

    due, row = "CASE WHEN fault = 1 THEN 3 ELSE 0 END", "(role || ':' || text)"
    user, assistant = "('user:' || text)", "('assistant:' || text)"
    insert = lambda s, line: edit(s, "I", 3, f"'{line}:'")
    live = "fault < 2"
    into2 = [given(f"{live} AND kind = 1", *(edit(s, "K", due, row) for s in ("k0", "k1", "k3"))), given(live, *(edit(s, "R", f"3 + {due}", user) for s in ("k0", "k1", "k3")))]
    into3 = [given(f"{live} AND kind = 2", edit("k2", "K", due, row)), given(live, edit("k2", "R", f"3 + {due}", assistant))]
    closed = f"""SELECT * EXCLUDE (s0, s1, s2, s3), s0 AS k0, s1 AS k1, p2 AS k2, {best("[s3]", f"[{insert('p2', 'assistant')}]")} AS k3
    FROM (SELECT *, {best("[s2]", f"[{', '.join(insert(s, 'user') for s in ('s0', 's1', 's3'))}]")} AS p2 FROM v)"""
    never = "{'c': 1000000::BIGINT, 'a': '', 'o': ''}"
    return f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (SELECT *, {crc32("key")} % 20 AS how FROM k),
x AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE how <> 0),
n AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM x),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM n),
r AS (SELECT *, CASE substr(role, 1, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS kind,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 2 WHEN seen > 1 THEN 3 WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 0 ELSE 1 END AS fault FROM o),
p AS (SELECT *, lag(kind) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM r),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum((fault = 2)::INT) AS blank, sum((fault = 3)::INT) AS duplicate,
    sum((fault = 1)::INT) AS truncated, sum((before IS NOT NULL AND (before, kind) NOT IN ((0, 1), (1, 2), (2, 1)))::INT) AS illegal, count(*) AS n FROM p GROUP BY conv_id),
v AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM stats
    UNION ALL
    SELECT conv_id, i, {edit("k0", "D", 4)}, {best(f"[{edit('k1', 'D', 4)}]", given(f"{live} AND kind = 0", edit("k0", "K", due, row)))},
        {best(f"[{edit('k2', 'D', 4)}]", *into2)}, {best(f"[{edit('k3', 'D', 4)}]", *into3)}
    FROM (SELECT v.* EXCLUDE (i), r.i, role, text, kind, fault FROM ({closed}) v JOIN r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.i = v.i + 1)),
e AS (SELECT conv_id, list_sort([k0, k3])[1] AS best FROM ({closed}) v JOIN stats USING (conv_id) WHERE i = n)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s USING (conv_id) LEFT JOIN e USING (conv_id)
"""


REPAIR = _repair()

TRIE = f"""
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL),
plan AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {crc32("conv_id::VARCHAR")} % 4 AS h FROM ids),
parts AS (SELECT p.conv_id, 0 AS half, pos, turn, words FROM plan p JOIN t ON t.conv_id = p.base AND pos < h
    UNION ALL SELECT p.conv_id, 1, pos, turn, words FROM plan p JOIN t ON t.conv_id = p.conv_id AND pos >= h),
r AS (SELECT conv_id, words, string_agg(turn, '') OVER w AS key, count(*) OVER w AS depth, count(*) OVER (PARTITION BY conv_id) AS n
    FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY half, pos ROWS UNBOUNDED PRECEDING)),
m AS (SELECT conv_id, key, depth, words, depth = n AS ended FROM r
    UNION ALL SELECT conv_id, '', 0, 0, conv_id NOT IN (SELECT conv_id FROM r) FROM ids),
nodes AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256 FROM m GROUP BY key, depth),
kids AS (SELECT left(key, length(key) - 32) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (key)),
trees AS (SELECT a.key, sum((b.n_children = 0)::INT) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens FROM below a JOIN below b ON starts_with(b.key, a.key) GROUP BY a.key)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM below n JOIN trees t ON t.key = n.key LEFT JOIN nodes p ON n.depth > 0 AND p.key = left(n.key, length(n.key) - 32)
"""
