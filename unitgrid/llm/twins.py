"""SQL twins (DuckDB) of the queries that SQL can express."""

from unitgrid.llm.urlterms import STRICT, VOCABULARY

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
WORDS = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTROL = r"([<\[]/?(?:s|t|n|INST)\\*)([>\]])"


def escaped(column):
    return rf"regexp_replace({column}, '{CONTROL}', '\1\\\2', 'g')"


OP5 = rf"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r)),
    marked AS (SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS joined, {escaped('text')} AS e,
        replace({escaped('role')}, chr(10), '<n>') AS er FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
    whole AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
        sum(length(e) + CASE WHEN joined THEN 3 ELSE 8 + length(er) END) AS chars FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM whole"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM documents),
    sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (
        SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
    sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach AS (SELECT x, y FROM sides UNION SELECT r.x, b.y FROM reach r JOIN sides b ON b.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) m ON m.x = d.doc_id"""

OP9 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
    win AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 34), ' ')) AS s FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
    again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN again USING (s)),
    word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

OP10 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS w FROM documents),
    b AS (SELECT item_id, w, least(10, len(w)) AS m FROM (SELECT item_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS w FROM benchmark) WHERE len(w) > 0),
    win AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
    dw AS (SELECT doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS s FROM (
        SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
    hit AS (SELECT doc_id, i, m, item_id FROM dw JOIN win USING (m, s)),
    pos AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
    its AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS l
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
    coalesce(pos.n, 0) > 0 AS contaminated FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""

#: Rules of op11: (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
_NO_LETTER = r"[^a-z\x{80}-\x{10FFFF}]"

OP11 = rf"""
WITH rules(h, p, verdict) AS (VALUES {', '.join(map(str, URL_RULES))}),
    terms(t, w) AS (VALUES {', '.join(map(str, VOCABULARY.items()))}),
    parts AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path']) AS x FROM pages),
    u AS (SELECT page_id, translate(x.host, '{UPPER}', '{LOWER}') AS host, x.path AS path FROM parts),
    fits AS (SELECT page_id, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC) AS k
        FROM u, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
    found AS (SELECT page_id, sum(w) AS score FROM u, terms
        WHERE regexp_matches(host || translate(path, '{UPPER}', '{LOWER}'), '(^|{_NO_LETTER})' || t || '($|{_NO_LETTER})') GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(verdict, CASE WHEN score >= {STRICT} THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fits ON fits.page_id = u.page_id AND k = 1 LEFT JOIN found ON found.page_id = u.page_id"""

#: crc32 of the decimal doc_id, bit by bit
CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""


def _leaf(*columns):
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


def _tree(name, leaves):
    """Nodes of all levels, and the siblings of each node that has a parent."""
    return f"""
    {name} AS (SELECT 0 AS lvl, g, pos, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
        UNION ALL SELECT lvl + 1, g, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY lvl, g, pos // 3, n),
    {name}_sides AS (SELECT lvl, g, pos, coalesce(lag(h, 2) OVER w, '') || coalesce(lag(h) OVER w, '') AS l,
        coalesce(lead(h) OVER w, '') || coalesce(lead(h, 2) OVER w, '') AS r FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY lvl, g, pos // 3 ORDER BY pos))"""


def _climb(name, start, tree):
    return f"""
    {name} AS (SELECT 0 AS lvl, doc_id, g, pos, cur, proof FROM {start}
        UNION ALL SELECT c.lvl + 1, doc_id, c.g, c.pos // 3, sha256(l || cur || r), proof || l || r FROM {name} c JOIN {tree}_sides s ON s.lvl = c.lvl AND s.g = c.g AND s.pos = c.pos),
    {name}_end AS (SELECT doc_id, g, cur, proof FROM {name} QUALIFY lvl = max(lvl) OVER (PARTITION BY doc_id))"""


OP12 = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(':' || source, '') AS g, {_leaf('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
        CASE WHEN {CRC} % 2 = 0 THEN {_leaf('doc_id', 'source', 'lang', 'n_chars', "replace(text, chr(10), '')")} END AS tampered FROM documents),
    leaves AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos FROM d), {_tree('low', 'leaves')},
    tops AS (SELECT '' AS g, g AS source, h, row_number() OVER (ORDER BY g) - 1 AS pos FROM low WHERE n = 1), {_tree('high', 'tops')},
    begin_low AS (SELECT doc_id, g, pos, coalesce(tampered, leaf) AS cur, '' AS proof FROM leaves), {_climb('up', 'begin_low', 'low')},
    begin_high AS (SELECT doc_id, '' AS g, pos, cur, proof FROM up_end JOIN tops ON tops.source = up_end.g), {_climb('top', 'begin_high', 'high')}
SELECT doc_id, leaf, tops.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root.h AS verified
FROM leaves JOIN tops ON tops.source = leaves.g JOIN top_end USING (doc_id), (SELECT h FROM high WHERE n = 1) AS root"""

OP13 = f"""
WITH d AS (SELECT doc_id, {CRC} AS h, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
    cut AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
    per AS (SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM cut),
    docs AS (SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM per),
    grams AS (SELECT doc_id, i, len(w) AS n, hash(array_to_string(list_slice(w, i, i + 15), ' ')) AS s FROM (SELECT *, unnest(range(1, len(w) - 14)) AS i FROM docs WHERE len(w) >= 24)),
    maybe AS (SELECT DISTINCT x.doc_id, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
    same AS (SELECT doc_id, q, i FROM (SELECT doc_id, q, w, unnest(range(1, len(w) - q + 1)) AS i FROM maybe JOIN docs USING (doc_id)) WHERE w[i] = w[i + q]),
    isles AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM same),
    found AS (SELECT doc_id, q, min(i) - 1 AS start, count(*) + q AS size FROM isles GROUP BY doc_id, q, isle HAVING count(*) + q >= greatest(24, 3 * q)),
    runs AS (SELECT * FROM found f WHERE NOT EXISTS (FROM found o WHERE o.doc_id = f.doc_id AND o.start = f.start AND o.size = f.size AND o.q < f.q AND f.q % o.q = 0)),
    best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size / q DESC, start, q) = 1),
    listed AS (SELECT doc_id, count(*) AS n, string_agg(start || ',' || size || ',' || q || chr(10), '' ORDER BY start, q) AS t FROM runs GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + size)) + 1 AS i FROM runs),
    word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT docs.doc_id, coalesce(n, 0) AS n_runs, start, size AS length, q AS period, CAST(1000 * size // q AS BIGINT) AS exponent_milli,
    sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ORACLES = {"op5_chat_format": OP5, "op7_ngram_jaccard": OP7, "op9_substring_dedup": OP9, "op10_benchmark_decontamination": OP10,
           "op11_url_filter": OP11, "op12_merkle_manifest": OP12, "op13_periodic_runs": OP13}
