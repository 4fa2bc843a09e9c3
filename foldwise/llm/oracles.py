"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import corpus_pipeline

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?(?:SYS|INST|ANS|ROLE)'))
         + CASE role WHEN 'system' THEN 16 WHEN 'user' THEN 18 WHEN 'assistant' THEN 13
           ELSE 19 + length(role) + len(regexp_extract_all(role, '\\|</?s>|\[/?(?:SYS|INST|ANS|ROLE)|\]')) END AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP2 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, {WORDS}::BIGINT AS size,
         md5('42:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS key
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
-- a bound on the share per unit of weight that grows until no more sources are above three times their size
rounds AS (
  SELECT 0 AS n, (SELECT sum(source_size) FROM src)::DOUBLE / (SELECT sum(weight) FROM src) AS level
  UNION ALL
  SELECT n + 1, (SELECT sum(source_size) - sum(CASE WHEN 3 * source_size <= level * weight THEN 3 * source_size ELSE 0 END) FROM src)::DOUBLE
              / nullif((SELECT sum(CASE WHEN 3 * source_size <= level * weight THEN 0 ELSE weight END) FROM src), 0)
  FROM rounds WHERE n < 60 AND level IS NOT NULL),
lev AS (SELECT max(level) AS level FROM rounds),
fixed AS (
  SELECT source, source_size, weight, 3 * source_size <= (SELECT level FROM lev) * weight AS capped FROM src),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN (3 * source_size)::DOUBLE
              ELSE ((SELECT sum(source_size) FROM src) - (SELECT coalesce(sum(3 * source_size), 0) FROM fixed WHERE capped))::DOUBLE * weight
                   / (SELECT sum(weight) FROM fixed WHERE NOT capped) END AS target
  FROM fixed),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN budget // source_size * size
          + least(size, greatest(0, budget - budget // source_size * source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM placed
"""

OP6 = r"""
WITH parsed AS (
  SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS k FROM pages),
rest AS (SELECT page_id, CASE WHEN k > 0 THEN substr(u, k + 3) ELSE '' END AS r FROM parsed),
parts AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS raw, r FROM rest),
places AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path FROM parts),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, host, path, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC) AS k
  FROM places JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT a.page_id, a.host, a.path, f.rule, coalesce(f.v, 'allow') AS verdict
FROM places a LEFT JOIN fits f ON a.page_id = f.page_id AND a.host = f.host AND a.path = f.path AND f.k = 1
"""

LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOW.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, p, p + 3), ' ')) AS g
  FROM words, unnest(range(1, greatest(len(w) - 2, 2))) AS r(p) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * k >= 85 * (s.n + t.n - k)),
reach AS (
  SELECT doc_id AS d, doc_id AS to_id FROM sizes
  UNION
  SELECT r.d, l.y FROM reach r JOIN links l ON r.to_id = l.x)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.least, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT d, min(to_id) AS least FROM reach GROUP BY d) c ON c.d = w.doc_id
"""

OP5 = f"""
WITH n AS (SELECT doc_id, {LOW.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)
"""

OP7 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, p, l[p] AS line, {LOW.format("trim(l[p], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k
  FROM split, unnest(range(1, len(l) + 1)) AS r(p)),
frequent AS (SELECT k FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT *, k IN (SELECT k FROM frequent) AS gone FROM lines)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP10 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 49), ' ')) AS h
  FROM words, unnest(range(1, len(w) - 48)) AS r(p) WHERE len(w) >= 50),
marked AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS least FROM windows) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM marked, unnest(range(0, 50)) AS r(k)),
places AS (SELECT doc_id, p, w[p] AS word FROM words, unnest(range(1, len(w) + 1)) AS r(p)),
kept AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.p) AS t, count(*) AS n
  FROM places a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.p = g.p WHERE g.p IS NULL GROUP BY a.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

def _spans(kind: str, pattern: str, good: str, least: str = "true") -> str:
    """Confirmed spans of one kind: rows of (doc_id, kind, s, e); good and least see v, text, s and e."""
    return rf"""
  SELECT doc_id, '{kind}' AS kind, s, e FROM (
    SELECT doc_id, text, v, e - length(v) AS s, e FROM (
      SELECT doc_id, text, f[i] AS v, (list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(f[1:i], lambda x: length(x))))::BIGINT AS e
      FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS f, string_split_regex(text, '{pattern}') AS g FROM docs), unnest(range(1, len(f) + 1)) AS r(i)))
  WHERE {good} AND {least}"""


_DIGITS = "regexp_replace({}, '[^0-9]', '', 'g')"
_LUHN = """(length({d}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({d}) + 1), lambda k:
    CASE WHEN k % 2 = 0 THEN 2 * substr({d}, length({d}) - k + 1, 1)::INT - CASE WHEN substr({d}, length({d}) - k + 1, 1)::INT > 4 THEN 9 ELSE 0 END
         ELSE substr({d}, length({d}) - k + 1, 1)::INT END)) % 10 = 0)""".replace("{d}", _DIGITS.format("v"))
_MOVED = "(substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4))"
_MOD97 = f"""(length(replace(v, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_transform(range(1, length({_MOVED}) + 1), lambda k: ascii(substr({_MOVED}, k, 1))),
    lambda a, c: CASE WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END, 0) = 1)"""
_NEAR = "regexp_matches(substr(text, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0)) || ' ' || substr(text, e + 1, 40), '(?i)ssn|social|security|taxpayer')"

OP8 = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  {_spans("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "true")}
  UNION ALL {_spans("ip", "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+", "len(list_filter(string_split(v, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(ltrim(p, '0') AS INT), 0) > 255)) = 0")}
  UNION ALL {_spans("card", "[0-9](?:[ -]?[0-9])+", _LUHN)}
  UNION ALL {_spans("phone", "[+][0-9][ ().0-9-]+[0-9]", f"length({_DIGITS.format('v')}) BETWEEN 9 AND 15")}
  UNION ALL {_spans("iban", "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", _MOD97)}
  UNION ALL {_spans("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "NOT regexp_matches(CASE WHEN s > 0 THEN substr(text, s, 1) ELSE '' END, '[0-9-]') AND NOT regexp_matches(substr(text, e + 1, 1), '[0-9-]') AND NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$')", _NEAR)}),
ranked AS (SELECT *, list_position(['email', 'ip', 'card', 'phone', 'iban', 'ssn'], kind) AS k, kind || ':' || s || ':' || e AS span FROM found),
joined AS (
  SELECT doc_id, count(*) FILTER (WHERE k = 1) AS n_email, count(*) FILTER (WHERE k = 2) AS n_ip, count(*) FILTER (WHERE k = 3) AS n_card, count(*) FILTER (WHERE k = 4) AS n_phone,
         string_agg(span, ',' ORDER BY k, s) FILTER (WHERE k <= 4) AS base, string_agg(span, ',' ORDER BY k, s) AS spans
  FROM ranked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""


def _op11() -> str:
    """Every state's best (cost, audit, lines) to the end, carried from the last turn to the first."""
    fit, kept = [3, 3, 4, 3], [[2, 3, 0], [0, 3, 0], [0, 0, 4], [0, 3, 0]]
    role = {3: "user", 4: "assistant"}

    def edit(cost, letter, lines, to, v):
        return f"{{'c': {cost} + {v}[{to}].c, 'a': '{letter}' || {v}[{to}].a, 'o': {lines} || {v}[{to}].o}}"

    def turn(q):
        keeps = " ".join(f"WHEN '{r}' THEN [{edit('t', 'K', '[line]', kept[q][i], 'v')}]" for i, r in enumerate("sua") if kept[q][i])
        rerole = edit("2 + t", "R", f"['{role[fit[q]]}:' || text]", fit[q], "v")
        return f"list_min([{edit(3, 'D', 'none', q + 1, 'v')}] || CASE WHEN gone THEN [] ELSE [{rerole}] || CASE left(role, 1) {keeps} ELSE [] END END)"

    def insert(q):
        once, twice = fit[q], fit[fit[q] - 1]
        one, two = f"['{role[once]}:']", f"['{role[once]}:', '{role[twice]}:']"
        return f"list_min([w[{q + 1}], {edit(2, 'I', one, once, 'w')}, {edit(4, 'II', two, twice, 'w')}])"

    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
bits AS (
  SELECT *, flatten(list_transform(string_split(key, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS bytes FROM keyed),
hit AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1)))) % 20 AS kind FROM bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS r(copy)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faulty AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS short, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM ordered),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE short AND NOT again AND NOT blank) AS truncated,
         count(*) FILTER (WHERE before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id),
steps AS (
  SELECT conv_id, n + 1 AS i, [{{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}}, {{'c': 4::BIGINT, 'a': 'II', 'o': ['user:', 'assistant:']}},
                               {{'c': 2::BIGINT, 'a': 'I', 'o': ['assistant:']}}, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}}] AS v
  FROM counted
  UNION ALL
  SELECT conv_id, i, [{", ".join(insert(q) for q in range(4))}] FROM (
    SELECT conv_id, i, [{", ".join(turn(q) for q in range(4))}] AS w FROM (
      SELECT s.conv_id, f.i, s.v, f.role, f.text, f.role || ':' || f.text AS line, f.blank OR f.again AS gone, (f.short)::BIGINT AS t, []::VARCHAR[] AS none
      FROM steps s JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i - 1))),
best AS (SELECT conv_id, v[1] AS b FROM steps WHERE i = 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(array_to_string(b.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counted d ON c.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN best e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


OP11 = _op11()


def _op13(rounds: int) -> str:
    """Rounds of assignment and replacement over all pairs of parts and entries."""
    steps = ["""
kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS ints
  FROM embeddings WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
pieces AS MATERIALIZED (
  SELECT vec_id, part, ints[part * len(ints) // 4 + 1:(part + 1) * len(ints) // 4] AS v FROM kept, range(4) AS r(part)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256),
books0 AS MATERIALIZED (SELECT part, entry, v FROM pieces JOIN first USING (vec_id))"""]
    near = """
near{0} AS MATERIALIZED (
  SELECT vec_id, p.part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT vec_id, p.part, entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM pieces p JOIN books{0} b ON p.part = b.part) AS p GROUP BY vec_id, p.part)"""
    for i in range(rounds):
        steps += [near.format(i), f"""
books{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM books{i} b LEFT JOIN (
    SELECT part, entry, list(value ORDER BY pos) AS v FROM (
      SELECT n.part, n.entry, u.pos, floor(sum(p.v[u.pos])::DOUBLE / count(*))::BIGINT AS value
      FROM near{i} n JOIN pieces p ON n.vec_id = p.vec_id AND n.part = p.part, unnest(range(1, len(p.v) + 1)) AS u(pos) GROUP BY ALL)
    GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry)"""]
    steps += [near.format(rounds), f"""
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM books{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""]
    return "WITH " + ",".join(steps)


OP13 = _op13(4)

QUERIES = {
    "op1_chat_format": OP1,
    "op2_mix_sources": OP2,
    "op3_ngram_jaccard": OP3,
    "op5_exact_dedup": OP5,
    "op6_url_filter": OP6,
    "op7_line_dedup": OP7,
    "op8_pii": OP8,
    "op10_substring_dedup": OP10,
    "op11_conversation_repair": OP11,
    "op13_vector_codes": OP13,
}
if corpus_pipeline.ORACLE_SQL:
    QUERIES["pipeline"] = corpus_pipeline.ORACLE_SQL
