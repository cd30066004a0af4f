"""DuckDB statements for the queries that SQL can express, written from the contracts."""

from __future__ import annotations

from gazette.llm.sharding import PRIME, round_keys

EXACT = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents),
r AS (SELECT *, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
             row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) AS rn FROM t)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""


def _sharding(shards: int = 24, key: int = 2024) -> str:
    """Sort, number, permute on the grid with cycle walking, and read off shard and slot."""
    mix = ("((({v} * {v}) % {p} * {mul} + {v}) % {p})")
    body, state = "", "SELECT n, x % a AS l, x // a AS r, a, b, cnt FROM src"
    for i, (add, mul) in enumerate(round_keys(key)):
        half = "r" if i % 2 == 0 else "l"
        one = f"SELECT *, ({half} + {add}) % {PRIME} AS u FROM ({state})"
        two = f"SELECT *, {mix.format(v='u', p=PRIME, mul=mul)} AS v FROM ({one})"
        f = f"((v * v + u) % {PRIME})"
        new = f"(l + {f}) % a AS l, r" if i % 2 == 0 else f"l, (r + {f}) % b AS r"
        state = f"SELECT n, {new}, a, b, cnt FROM ({two})"
    body = f"SELECT n, r * a + l AS x, a, b, cnt FROM ({state})"
    crc = ("list_reduce(list_transform(regexp_extract_all(hx, '..'), lambda h: ('0x' || h)::BIGINT), "
           "lambda c, x: xor(c >> 8, crc_table[(xor(c, x) & 255) + 1]), 4294967295)")
    return f"""
WITH RECURSIVE crc_step AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_step WHERE k < 8),
crc_list AS (SELECT list(c ORDER BY i) AS crc_table FROM crc_step WHERE k = 8),
d AS (SELECT doc_id, length(hx) // 2 + 8 AS size, CASE WHEN hx = '' THEN 0 ELSE xor({crc}, 4294967295) END AS text_crc32
      FROM (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents), crc_list),
k AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS n, count(*) OVER () AS cnt FROM d),
g AS (SELECT *, greatest(1, ceil(sqrt(cnt)))::BIGINT AS a FROM k),
h AS (SELECT *, ((cnt + a - 1) // a)::BIGINT AS b FROM g),
walk AS (
  SELECT n, x, a, b, cnt FROM (WITH src AS (SELECT n, n AS x, a, b, cnt FROM h) {body})
  UNION ALL
  SELECT n, x, a, b, cnt FROM (WITH src AS (SELECT n, x, a, b, cnt FROM walk WHERE x >= cnt) {body}))
SELECT h.doc_id, h.size, h.text_crc32, 'rows' AS law, (w.x % {shards})::INTEGER AS shard, w.x // {shards} AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM h JOIN walk w USING (n) WHERE w.x < w.cnt
"""


SHARDING = _sharding()


def _pii() -> str:
    """The base patterns as the contract states them; places from the gaps between matches."""
    pats = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}([A-Z0-9]{11,30}|( [A-Z0-9]{4}){2,7}( [A-Z0-9]{1,4})?)",
        "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    near = {"email": "mail|contact|kontakt|correo|courriel", "ip": "ip|host|server|address|adresse",
            "card": "card|visa|credit|karte|carte|tarjeta", "phone": "phone|tel|call|mobile|fax|anruf",
            "iban": "iban|account|bank|konto|compte|cuenta", "ssn": "ssn|social|security"}
    num = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn = (f"(list_sum(list_transform(range(1, length({num}) + 1), lambda i: CASE "
            f"WHEN i % 2 = 1 THEN substr(reverse({num}), i, 1)::INT "
            f"ELSE (substr(reverse({num}), i, 1)::INT * 2) // 10 + (substr(reverse({num}), i, 1)::INT * 2) % 10 END)) % 10 = 0)")
    bare = "replace(v, ' ', '')"
    turned = f"(substr({bare}, 5) || substr({bare}, 1, 4))"
    m97 = (f"(list_reduce(list_transform(range(1, length({turned}) + 1), lambda i: ord(substr({turned}, i, 1))::BIGINT), "
           "lambda a, c: CASE WHEN c < 58 THEN (a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END, 0::BIGINT) = 1)")
    valid = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(v, '.'), lambda p: length(ltrim(p, '0')) <= 3 "
              "AND coalesce(try_cast(right(p, 4) AS INT), 0) <= 255))",
        "card": f"(length({num}) BETWEEN 13 AND 19 AND {luhn})",
        "phone": f"length({num}) BETWEEN 9 AND 15",
        "iban": f"(NOT regexp_matches(prev, '[A-Za-z0-9]') AND NOT regexp_matches(nxt, '[A-Za-z0-9]') AND {m97})",
        "ssn": "(NOT regexp_matches(prev, '[0-9-]') AND NOT regexp_matches(nxt, '[0-9-]') AND left(v, 3) NOT IN ('000', '666') "
               "AND left(v, 1) <> '9' AND substr(v, 5, 2) <> '00' AND right(v, 4) <> '0000' AND context)",
    }
    arms = []
    for k, (kind, pat) in enumerate(pats.items()):
        arms.append(f"""
SELECT doc_id, rid, {k} AS k, '{kind}' AS kind, s, e, context FROM (
  SELECT *, regexp_matches(substr(text, greatest(s - 40, 0) + 1, least(s, 40)), '(?i)({near[kind]})') AS context,
         CASE WHEN s > 0 THEN substr(text, s, 1) ELSE '' END AS prev, substr(text, e + 1, 1) AS nxt FROM (
    SELECT doc_id, rid, text, hits[i] AS v,
           (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s,
           s + length(hits[i]) AS e FROM (
      SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT doc_id, rid, text, string_split_regex(text, '{pat}') AS gaps, regexp_extract_all(text, '{pat}') AS hits FROM d))))
WHERE {valid[kind]}""")
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in pats)
    one = "kind || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
spans AS ({' UNION ALL '.join(arms)}),
g AS (SELECT rid, {counts}, string_agg({one}, ',' ORDER BY k, s) FILTER (WHERE k < 4) AS base,
             string_agg({one}, ',' ORDER BY k, s) AS spans, count(*) FILTER (WHERE context) AS n_context FROM spans GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in list(pats)[:4])}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in list(pats)[4:])},
       coalesce(n_context, 0) AS n_context
FROM d LEFT JOIN g USING (rid)
"""


PII = _pii()

VECTORS = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e, label FROM embeddings),
ok AS (SELECT rid, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM d
       WHERE label IS NOT NULL AND len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))
         AND list_bool_or(list_transform(e, lambda x: x <> 0))),
p AS (SELECT a.rid AS a, b.rid AS b FROM ok a JOIN ok b ON a.label = b.label AND a.rid < b.rid AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
l AS (SELECT a AS v, b AS w FROM p UNION ALL SELECT b, a FROM p),
reach AS (SELECT rid AS v, rid AS w FROM d UNION SELECT reach.v, l.w FROM reach JOIN l ON l.v = reach.w)
SELECT d.vec_id, (SELECT count(*) FROM l WHERE l.v = d.rid) AS n_links, c.component_id, d.vec_id = c.component_id AS kept
FROM d JOIN (SELECT reach.v, min(x.vec_id) AS component_id FROM reach JOIN d x ON x.rid = reach.w GROUP BY reach.v) c ON c.v = d.rid
"""

HARD_NEGATIVES = """
WITH d AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e
           FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
             AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (SELECT a.rid AS anchor, a.vec_id AS anchor_id, a.label AS anchor_label, d.rid, d.vec_id, d.label, list_dot_product(a.e, d.e)::BIGINT AS score
      FROM d a JOIN d ON a.vec_id % 100 = 0 AND a.rid <> d.rid AND len(a.e) = len(d.e)),
p AS (SELECT anchor, anchor_id, rid, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, rid) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY s.score DESC, s.vec_id NULLS LAST, s.rid)::INTEGER AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND s.label <> s.anchor_label AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""
