"""Contracts of the operators as DuckDB SQL over whole tables: what they return, not how they find it."""

from __future__ import annotations

from reachspark.llm.license_scan import PHRASES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_WORD = r"'[^\x20\x09-\x0D]+'"

#: Least node that each node of links l(a, b) reaches.
_REACH = "r(n, m) AS (SELECT a, b FROM l WHERE b < a UNION SELECT l.a, r.m FROM r JOIN l ON l.b = r.n WHERE r.m < l.a), c AS (SELECT n, min(m) AS root FROM r GROUP BY n)"

EMBEDDINGS = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98), {_REACH}, d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
 SELECT vec_id, coalesce(d.n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept FROM v LEFT JOIN c ON c.n = vec_id LEFT JOIN d ON d.a = vec_id"""

DOCUMENTS = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, {_WORD}) AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s FROM w),
 x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s), i AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n + b.n) AS n, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM i WHERE 100 * k >= 80 * (n - k)), {_REACH}
 SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept FROM s LEFT JOIN c ON c.n = doc_id"""

TOP_K = """WITH f AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings),
 v AS (SELECT * FROM f WHERE vec_id IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 p AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
 k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM p) SELECT * FROM k WHERE rank <= 5"""

# Pairs of lines that may be similar share one of the rarest fifth of their shingles; the rest is exact.
LINES = f"""WITH RECURSIVE t AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS raw FROM documents WHERE text IS NOT NULL),
 o AS (SELECT doc_id, line, raw, trim(translate(raw, '{_UPPER}', '{_LOWER}'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM t),
 u AS (SELECT s, row_number() OVER (ORDER BY s) AS id, CASE WHEN length(s) >= 5 THEN list_distinct(list_transform(range(1, length(s) - 3), lambda i: substr(s, i, 5))) ELSE [s] END AS g FROM (SELECT DISTINCT s FROM o WHERE s <> '')),
 x AS (SELECT id, len(g) AS n, hash(unnest(g)) AS g FROM u), f AS (SELECT g, count(*) AS c FROM x GROUP BY g HAVING count(*) > 1), k AS (SELECT id, n, x.g, row_number() OVER (PARTITION BY id ORDER BY coalesce(c, 1), x.g) AS r FROM x LEFT JOIN f USING (g)),
 h AS (SELECT id, n, g FROM k JOIN f USING (g) WHERE r <= n - ceil(0.8 * n) + 1), y AS (SELECT DISTINCT p.id AS a, q.id AS b FROM h p JOIN h q ON p.g = q.g AND p.id < q.id AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)),
 e AS (SELECT a, b FROM y JOIN u p ON p.id = a JOIN u q ON q.id = b WHERE 180 * len(list_intersect(p.g, q.g)) >= 80 * (len(p.g) + len(q.g))), l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), {_REACH},
 z AS (SELECT doc_id, line, raw, s = '' OR row_number() OVER (PARTITION BY s = '', coalesce(root, id) ORDER BY doc_id, line) = 1 AS keep FROM o LEFT JOIN u USING (s) LEFT JOIN c ON c.n = id)
 SELECT d.doc_id, coalesce(a.n_lines, 0) AS n_lines, coalesce(a.n_kept, 0) AS n_kept, CASE WHEN d.text IS NOT NULL THEN coalesce(a.t, '') END AS text FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keep) AS n_kept, string_agg(raw, chr(10) ORDER BY line) FILTER (WHERE keep) AS t FROM z GROUP BY 1) a USING (doc_id)"""

# As in the operator: sources in order of how soon they are full; the first whose successor isn't filled gives the level.
TARGETS = f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS size FROM documents), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
 w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w, 3.0 * source_size AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS budget FROM s), o AS (SELECT *, cap / w AS fills FROM w),
 e AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY fills, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY fills, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
 g AS (SELECT *, max(CASE WHEN level <= fills THEN level END) OVER () AS top FROM e) SELECT doc_id, d.source, size, source_size, round(CASE WHEN top IS NULL THEN cap ELSE least(cap, top * w) END, 6) AS target FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source"""


def _places() -> str:
    hits = []
    for phrase, label in PHRASES.items():
        words = phrase.split()
        same = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words))
        hits.append(f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(1, len(w) + 1), lambda i: {same})) - 1 AS p FROM w")
    return " UNION ALL ".join(hits)


LICENSES = f"""WITH w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents), p AS ({_places()}),
 a AS (SELECT doc_id, count(*) AS n, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY 1)
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word, coalesce(labels, '') AS base_labels FROM w LEFT JOIN a USING (doc_id)"""

# CRC-32 of the id's digits, from its table of 256 entries.
_HELD = """crc AS (SELECT list(t ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda t, k: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END) AS t FROM (SELECT unnest(range(256)) AS i))),
 d AS (SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 1 AS held_out, text FROM documents, crc)"""


def _level(k: int, grams: str, count: str) -> str:
    """CTEs of the n-grams of contexts of k words: g{k} (context, word, n), discounts d{k} and contexts h{k} (total, spare mass)."""
    of = ", ".join(f"count(*) FILTER (WHERE n = {q}) AS n{q}" for q in (1, 2, 3, 4))
    pick = lambda x, most, other: f"CASE WHEN least(n1, n2, n3) > 0 AND {x} > 0 AND {x} < {most} THEN {x} ELSE {other} END"
    y = "(n1::DOUBLE / (n1 + 2 * n2))"
    u = ", ".join(f"p{q}" for q in range(k, 0, -1))
    u_ = f"{u}, " if u else ""
    group = f" GROUP BY {u}" if u else ""
    off = f"CASE n WHEN 0 THEN 0 WHEN 1 THEN a WHEN 2 THEN b ELSE c END"
    return f"""g{k} AS (SELECT {u_}w, {count} AS n FROM {grams} GROUP BY {u_}w), d{k} AS (SELECT {pick(f'1 - 2 * {y} * n2 / n1', 1, 0.5)} AS a, {pick(f'2 - 3 * {y} * n3 / n2', 2, 0.75)} AS b, {pick(f'3 - 4 * {y} * n4 / n3', 3, 0.9)} AS c FROM (SELECT {of} FROM g{k})),
 h{k} AS (SELECT {u_}sum(n)::DOUBLE AS total, sum({off})::DOUBLE AS spare FROM g{k}, d{k}{group}), q{k} AS (SELECT {u_}w, n - {off} AS over FROM g{k}, d{k})"""


SCORES = f"""WITH {_HELD}, k AS (SELECT doc_id, held_out, list_append(regexp_extract_all({_LOW}, {_WORD}), chr(1) || 'end') AS w FROM d),
 t AS (SELECT doc_id, held_out, i, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] ELSE chr(1) || 'start' END AS p1, CASE WHEN i > 2 THEN w[i - 2] ELSE chr(1) || 'start' END AS p2 FROM (SELECT doc_id, held_out, w, unnest(range(1, len(w) + 1)) AS i FROM k)),
 train AS (SELECT * FROM t WHERE NOT held_out), raw AS (SELECT w, count(*) AS c FROM train GROUP BY w), tot AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM raw), {_level(2, 'train', 'count(*)')}, {_level(1, 'g2', 'count(*)')}, {_level(0, 'g1', 'count(*)')},
 low AS (SELECT r.w, (coalesce(q0.over, 0) + h0.spare / (v + 1)) / h0.total AS p FROM raw r LEFT JOIN q0 USING (w), h0, tot), none AS (SELECT h0.spare / (v + 1) / h0.total AS p FROM h0, tot),
 b AS (SELECT doc_id, held_out, t.w, coalesce(c, 0) AS c, log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1))) AS base, coalesce(low.p, none.p) AS l0,
  CASE WHEN h1.total IS NULL THEN l0 ELSE (coalesce(q1.over, 0) + h1.spare * l0) / h1.total END AS l1, CASE WHEN h2.total IS NULL THEN l1 ELSE (coalesce(q2.over, 0) + h2.spare * l1) / h2.total END AS l2
  FROM t LEFT JOIN raw ON raw.w = t.w LEFT JOIN low ON low.w = t.w LEFT JOIN h1 ON h1.p1 = t.p1 LEFT JOIN q1 ON q1.p1 = t.p1 AND q1.w = t.w LEFT JOIN h2 ON h2.p1 = t.p1 AND h2.p2 = t.p2 LEFT JOIN q2 ON q2.p1 = t.p1 AND q2.p2 = t.p2 AND q2.w = t.w, tot, none)
 SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (WHERE c > 0) AS n_known, any_value(n) AS train_tokens, round(sum(base), 5) AS base_score, round(sum(log10(l2)), 5) AS score FROM b, tot GROUP BY doc_id, held_out"""

_PART = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_leaf = lambda text: "sha256(" + " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
_TABLE = _HELD.split(",\n")[0]


def _tree(name: str, base: str) -> str:
    """CTEs of the trees over nodes (g, i, n, h): {name}(g, level, i, n, h), and {name}_run with what stands before and after each node in its run."""
    side = "coalesce(string_agg(h, '') OVER (PARTITION BY g, level, i // 16 ORDER BY i ROWS BETWEEN {}), '')"
    return f"""{name}(g, level, i, n, h) AS (SELECT g, 0, i, n, h FROM {base} UNION ALL SELECT g, level + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY g, level, i // 16),
 {name}_run AS (SELECT g, level, i, {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS a, {side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS b FROM {name} WHERE n > 1), {name}_top AS (SELECT g, h FROM {name} WHERE n = 1)"""


# A path has the levels of the source's tree first, then (from level 100) those of the tree over sources.
MANIFEST = f"""WITH RECURSIVE {_TABLE}, x AS (SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf('text')} AS h, CASE WHEN doc_id IS NOT NULL AND {_CRC.format('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS claim FROM documents, crc),
 l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM x), {_tree('s', 'l')}, o AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h, g AS source FROM s_top), {_tree('r', 'o')},
 p AS (SELECT l.g, l.i, level, a, b FROM l JOIN s_run ON s_run.g = l.g AND s_run.i = l.i // (16 ** level)::BIGINT UNION ALL SELECT l.g, l.i, 100 + level, a, b FROM l JOIN o ON o.source = l.g JOIN r_run ON r_run.i = o.i // (16 ** level)::BIGINT),
 k AS (SELECT *, row_number() OVER (PARTITION BY g, i ORDER BY level) AS step FROM p), q AS (SELECT g, i, sha256(string_agg(a || b, '' ORDER BY step)) AS proof FROM k GROUP BY g, i),
 f(g, i, step, h) AS (SELECT g, i, 0, coalesce(claim, h) FROM l UNION ALL SELECT f.g, f.i, k.step, sha256(k.a || f.h || k.b) FROM f JOIN k ON k.g = f.g AND k.i = f.i AND k.step = f.step + 1), e AS (SELECT g, i, max_by(h, step) AS folded_root FROM f GROUP BY g, i)
 SELECT doc_id, l.h AS leaf, s_top.h AS subroot, r_top.h AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = r_top.h AS verified FROM l JOIN e ON e.g = l.g AND e.i = l.i JOIN s_top ON s_top.g = l.g LEFT JOIN q ON q.g = l.g AND q.i = l.i, r_top"""

# Words are numbered, so a window is compared as a list of numbers.
WINDOWS = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents), v AS (SELECT doc_id, w, len(w) AS n FROM w),
 x AS (SELECT doc_id, unnest(range(1, n - 48)) AS i, w FROM v WHERE n >= 50 AND doc_id IS NOT NULL), s AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM x), f AS (SELECT s, min(doc_id) AS a FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)),
 g AS (SELECT DISTINCT doc_id, i + k AS p FROM s JOIN f USING (s), (SELECT unnest(range(50)) AS k) WHERE a < doc_id), r AS (SELECT doc_id, list(p) AS p FROM g GROUP BY doc_id)
 SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed, sha256(CASE WHEN p IS NULL THEN array_to_string(w, ' ') ELSE coalesce(array_to_string(list_transform(list_filter(list_zip(w, range(1, n + 1)), lambda z: NOT list_contains(p, z[2])), lambda z: z[1]), ' '), '') END) AS kept_sha256 FROM v LEFT JOIN r USING (doc_id)"""

_MOVE = ", ".join(f"('{a}', '{i}', {ini}, '{x}', {c}, '{b}')" for a, i, ini, x, c, b in [
    ("0", "", "'s'", "K", 0, "s"), ("0", "", "'u'", "K", 0, "u"), ("s", "", "'u'", "K", 0, "u"), ("a", "", "'u'", "K", 0, "u"), ("u", "", "'a'", "K", 0, "a"),
    ("0", "", "NULL", "R", 2, "u"), ("s", "", "NULL", "R", 2, "u"), ("a", "", "NULL", "R", 2, "u"), ("u", "", "NULL", "R", 2, "a"),
    ("0", "", "NULL", "D", 3, "0"), ("s", "", "NULL", "D", 3, "s"), ("u", "", "NULL", "D", 3, "u"), ("a", "", "NULL", "D", 3, "a"),
])
_INS = "('0', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')"

# Rows one after another: each state's least (cost, audit); a step may insert twice before its row. The repaired roles follow from the audit: after the system's turn users and assistants take turns.
REPAIR = f"""WITH RECURSIVE {_TABLE}, ins(a, b) AS (VALUES {_INS}), mv(a, i, ini, x, c, b) AS (VALUES {_MOVE}),
 mm AS (SELECT a, ini, x, c, b FROM mv UNION ALL SELECT ins.a, ini, 'I' || x, c + 2, mv.b FROM ins JOIN mv ON mv.a = ins.b UNION ALL SELECT i.a, ini, 'II' || x, c + 4, mv.b FROM ins i JOIN ins j ON j.a = i.b JOIN mv ON mv.a = j.b),
 c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations, crc),
 d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM (SELECT * FROM c UNION ALL SELECT * FROM c WHERE k = 3) WHERE k <> 0),
 id AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id NULLS FIRST) AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
 o AS (SELECT g, turn, role, text, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS p FROM d JOIN id ON id.conv_id IS NOT DISTINCT FROM d.conv_id),
 f AS (SELECT *, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY p) > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY p) || left(role, 1) AS two FROM o),
 st(g, p, q, cost, audit) AS (SELECT g, 0, '0', 0, '' FROM id UNION ALL SELECT g, p + 1, b, z.cost, z.audit FROM (SELECT st.g, st.p, mm.b, min({{'cost': st.cost + mm.c + CASE WHEN fault = 3 AND right(x, 1) <> 'D' THEN 1 ELSE 0 END, 'audit': st.audit || x}}) AS z
   FROM st JOIN f ON f.g = st.g AND f.p = st.p + 1 JOIN mm ON mm.a = st.q AND (mm.ini IS NULL OR mm.ini = f.ini) AND (right(x, 1) = 'D' OR fault NOT IN (1, 2)) GROUP BY st.g, st.p, mm.b)),
 n AS (SELECT id.g, count(f.p) AS n FROM id LEFT JOIN f ON f.g = id.g GROUP BY id.g), e AS (SELECT g, z.cost AS cost, z.audit AS audit FROM (SELECT st.g, min({{'cost': st.cost + CASE q WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END, 'audit': st.audit || CASE q WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END}}) AS z FROM st JOIN n ON n.g = st.g AND n.n = st.p GROUP BY st.g)),
 l AS (SELECT g, j, substr(audit, j, 1) AS x, j - len(replace(left(audit, j), 'I', '')) AS ins FROM (SELECT g, audit, unnest(range(1, len(audit) + 1)) AS j FROM e)), m AS (SELECT l.g, j, x, role, text, ini, row_number() OVER (PARTITION BY l.g ORDER BY j) AS k FROM l LEFT JOIN f ON x <> 'I' AND f.g = l.g AND f.p = j - ins WHERE x <> 'D'),
 y AS (SELECT m.*, coalesce(max(CASE WHEN k = 1 AND x = 'K' AND ini = 's' THEN 1 END) OVER (PARTITION BY g), 0) AS sys FROM m), h AS (SELECT g, string_agg(CASE WHEN x = 'K' THEN role WHEN (k - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN x = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS t FROM y GROUP BY g),
 a AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE two NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY g)
 SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(coalesce(t, '')) AS repaired_sha256 FROM id JOIN e USING (g) LEFT JOIN a USING (g) LEFT JOIN h USING (g)"""
