"""Queries of this subpackage, and their SQL where DuckDB can express them."""

from __future__ import annotations

import re

from logtide.llm import chat_format, decontamination, jaccard_join, lm_scoring, merkle, nearest, quality, secret_scan, sentencepiece_codec, sharding, spelling, substring_dedup, url_filters

QUERIES = {
    f.__name__: f
    for f in (
        sharding.op1_sharding,
        quality.op2_quality,
        url_filters.op3_url_filters,
        sentencepiece_codec.op4_sentencepiece,
        nearest.op5_nearest,
        decontamination.op6_decontamination,
        jaccard_join.op7_jaccard_join,
        secret_scan.op8_secrets,
        chat_format.op9_chat_format,
        substring_dedup.op10_substring_dedup,
        merkle.op11_merkle_manifest,
        lm_scoring.op12_lm_scores,
        spelling.op13_spelling_variants,
    )
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def escaped_sql(text: str) -> str:
    """What ``chat_format.escape`` makes of a text; the control strings don't overlap."""
    for c in chat_format.CONTROL:
        text = rf"regexp_replace({text}, '({re.escape(c[0])})(\\*{re.escape(c[1:])})', '\1\\\2', 'g')"
    return text


def fits_sql(rule: str) -> str:
    domain, _, rest = rule.partition("/")
    return f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{rest}')"


RULES = sorted(url_filters.RULES, key=lambda r: -len(r[0]))
def crc32_sql(ascii_text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({ascii_text}, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: {bits}), 4294967295)"


def field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def row_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(map(field_sql, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


CONTROLLED = f"'{chat_format.START}' || " + escaped_sql("replace(replace(role, '%', '%25'), chr(10), '%0A')") + " || chr(10) || " + escaped_sql("text") + f" || '{chat_format.END}' || chr(10)"

ORACLES: dict[str, str] = {
    # rules of up to three tokens, each counted over all labelled pages
    "op3_url_filters": rf"""
WITH p AS MATERIALIZED (SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
u AS MATERIALIZED (SELECT DISTINCT host, path, x AS token FROM (SELECT host, path, unnest(list_concat(list_transform(string_split(host, '.'), lambda x: 'h:' || x), list_transform(regexp_split_to_array(path, '[/._-]+'), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '#', 'g')))) AS x FROM (SELECT DISTINCT host, path FROM p)) WHERE length(x) > 2),
m AS (SELECT doc_id, coalesce(max(toxic = 1 OR quality = 0), false) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
s AS MATERIALIZED (SELECT row_number() OVER () AS page, host, path, bad FROM (SELECT DISTINCT page_id, url, host, path, bad FROM p JOIN m ON p.page_id = m.doc_id WHERE url IS NOT NULL)),
least AS (SELECT greatest({url_filters.LEAST}, CAST(ceil(round(count(*) * {url_filters.SUPPORT}, 6)) AS BIGINT)) AS least FROM s),
t AS MATERIALIZED (SELECT page, bad, token FROM s JOIN u USING (host, path)),
c AS (SELECT token, count(*) AS n, count(*) FILTER (bad) AS n_bad, string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) AS held FROM t GROUP BY token),
i AS MATERIALIZED (SELECT min(token) AS token, any_value(n_bad) >= {url_filters.CONFIDENCE} * any_value(n) AS alone FROM c, least WHERE n_bad >= least.least GROUP BY held),
r AS MATERIALIZED (SELECT page, bad, token FROM t JOIN i USING (token) WHERE NOT alone),
two AS MATERIALIZED (SELECT a.token AS x, b.token AS y FROM r a JOIN r b ON a.page = b.page AND a.token < b.token, least GROUP BY ALL HAVING count(*) FILTER (a.bad) >= any_value(least) AND count(*) FILTER (a.bad) >= {url_filters.CONFIDENCE} * count(*)),
three AS (SELECT a.token AS x, b.token AS y, c.token AS z FROM r a JOIN r b ON a.page = b.page AND a.token < b.token JOIN r c ON a.page = c.page AND b.token < c.token, least GROUP BY ALL HAVING count(*) FILTER (a.bad) >= any_value(least) AND count(*) FILTER (a.bad) >= {url_filters.CONFIDENCE} * count(*)),
blocked AS (
  SELECT host, path FROM u JOIN i USING (token) WHERE alone
  UNION SELECT a.host, a.path FROM two JOIN u a ON a.token = x JOIN u b ON b.token = y AND b.host = a.host AND b.path = a.path
  UNION SELECT a.host, a.path FROM three JOIN u a ON a.token = x JOIN u b ON b.token = y AND b.host = a.host AND b.path = a.path JOIN u c ON c.token = z AND c.host = a.host AND c.path = a.path)
SELECT page_id, p.host, p.path, CASE {" ".join(f"WHEN {fits_sql(r).replace('host', 'p.host').replace('path', 'p.path')} THEN '{r}'" for r, _ in RULES)} END AS rule,
  CASE {" ".join(f"WHEN {fits_sql(r).replace('host', 'p.host').replace('path', 'p.path')} THEN '{v}'" for r, v in RULES)} WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN blocked b ON b.host = p.host AND b.path = p.path
""",
    "op9_chat_format": f"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, {CONTROLLED} AS formatted FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
""",
    "op6_decontamination": rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[k : k + least(len(w), 13) - 1], ' ') AS words FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, k, size, array_to_string(w[k : k + size - 1], ' ') AS words FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)),
hits AS MATERIALIZED (SELECT doc_id, item, k, size FROM dw JOIN bw USING (size, words)),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + size)) AS at FROM (SELECT DISTINCT doc_id, k, size FROM hits)) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, lang, doc_id, {row_sql('n_chars')} AS leaf, CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 AND n_chars IS NOT NULL THEN {row_sql('(n_chars + 1)')} END AS forged FROM documents),
l AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
t(g, lvl, i, n, x) AS (SELECT g, 0, i, n, leaf FROM l UNION ALL SELECT g, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(x, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY g, lvl, i // 2, n),
tree AS MATERIALIZED (SELECT * FROM t),
roots AS MATERIALIZED (SELECT g, lvl AS height, x AS subroot FROM tree WHERE n = 1),
u(lvl, i, n, x) AS (SELECT 0, g, count(*) OVER (), subroot FROM roots UNION ALL SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(x, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lvl, i // 2, n),
over AS MATERIALIZED (SELECT * FROM u),
steps AS MATERIALIZED (
  SELECT r, a.lvl AS k, (l.i >> a.lvl) % 2 AS right_side, b.x FROM l JOIN (SELECT DISTINCT g, lvl, n FROM tree WHERE n > 1) a USING (g) LEFT JOIN tree b ON b.g = l.g AND b.lvl = a.lvl AND b.i = xor(l.i >> a.lvl, 1)
  UNION ALL SELECT r, height + a.lvl, (l.g >> a.lvl) % 2, b.x FROM l JOIN roots USING (g) JOIN (SELECT DISTINCT lvl, n FROM over WHERE n > 1) a ON true LEFT JOIN over b ON b.lvl = a.lvl AND b.i = xor(l.g >> a.lvl, 1)),
f(r, k, x) AS (SELECT r, CAST(0 AS BIGINT), coalesce(forged, leaf) FROM l UNION ALL SELECT f.r, f.k + 1, sha256(CASE WHEN s.right_side = 1 THEN coalesce(s.x, '') || f.x ELSE f.x || coalesce(s.x, '') END) FROM f JOIN steps s ON s.r = f.r AND s.k = f.k),
e AS (SELECT r, max_by(x, k) AS folded_root FROM f GROUP BY r),
p AS (SELECT r, sha256(string_agg(coalesce(x, ''), '' ORDER BY k)) AS proof_sha256 FROM steps GROUP BY r)
SELECT doc_id, leaf, subroot, o.x AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = o.x AS verified
FROM l JOIN roots USING (g) JOIN e USING (r) LEFT JOIN p USING (r), (SELECT x FROM over WHERE n = 1) o
""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
runs AS MATERIALIZED (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
bytes AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
sums AS MATERIALIZED (SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(x) // 2), lambda i: CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT))), lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) AS h FROM bytes, crc),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % {spelling.SLIPS} = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM sums) WHERE length(word) >= {spelling.LENGTH} GROUP BY word HAVING sum(n) >= {spelling.COUNT}),
less AS MATERIALIZED (SELECT word, n, i, word[: i] || word[i + 2 :] AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
longer AS MATERIALIZED (SELECT DISTINCT l.word AS long, l.n AS long_n, w.word AS short, w.n AS short_n FROM less l JOIN words w ON w.word = l.rest),
near AS MATERIALIZED (SELECT long AS word, short AS other, short_n AS other_n FROM longer UNION ALL SELECT short, long, long_n FROM longer
  UNION ALL SELECT a.word, b.word, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {spelling.RATIO} * w.n THEN other END AS form, CASE WHEN other_n >= {spelling.RATIO} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
ways(word, reached, k) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT w.word, f.form, k + 1 FROM ways w JOIN forms f ON f.word = w.reached WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, max_by(reached, k) AS root FROM ways GROUP BY word) USING (word)
""",
    "op7_jaccard_join": rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, hash(array_to_string(w[k : k + 4], ' ')) AS h FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
links AS MATERIALIZED (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y USING (h) WHERE x.r <> y.r GROUP BY ALL) p JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach(r, other) AS (SELECT r, r FROM d UNION SELECT x.r, l.b FROM reach x JOIN links l ON l.a = x.other)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id FROM reach x JOIN d ON d.r = x.r JOIN d o ON o.r = x.other LEFT JOIN n ON n.r = x.r GROUP BY d.r, d.doc_id
""",
}
