"""DuckDB SQL fragments mirroring the Spark column functions (for the oracle queries).

Patterns are shared with ``gazette.functions`` so both engines run the same
regular expressions (Java ``Pattern`` on Spark, RE2 on DuckDB).
"""

from __future__ import annotations

from .. import config as C
from ..functions import html as H
from ..functions import text as T
from ..sources import bindings as B


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS_SQL = " || ".join(f"chr({ord(c)})" for c in T.WS_CHARS)


def strip(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def rstrip(x: str) -> str:
    return f"rtrim({x}, {WS_SQL})"


def lstrip(x: str) -> str:
    return f"ltrim({x}, {WS_SQL})"


def norm_title(x: str) -> str:
    cleaned = f"regexp_replace(lower({x}), {q(T.NON_WORD)}, '', 'g')"
    return f"trim(regexp_replace({cleaned}, {q(T.WS + '+')}, ' ', 'g'))"


def cjk(x: str) -> str:
    return f"len(regexp_extract_all(coalesce({x}, ''), {q(C.CJK_CLASS)}))"


def latin(x: str) -> str:
    return f"len(regexp_extract_all(coalesce({x}, ''), {q(C.LATIN_WORD)}))"


def reading_minutes(x: str) -> str:
    m = f"({cjk(x)} / {C.CJK_PER_MINUTE}.0::DOUBLE + {latin(x)} / {C.LATIN_WORDS_PER_MINUTE}.0::DOUBLE)"
    return (f"(CASE WHEN coalesce(length({x}), 0) = 0 THEN 0 "
            f"ELSE greatest(1, CAST(round_even({m}, 0) AS INTEGER)) END)")


def line_cost(x: str) -> str:
    return (f"greatest(1.0::DOUBLE, {cjk(x)} / {C.CJK_PER_LINE}.0::DOUBLE "
            f"+ {latin(x)} / {C.LATIN_WORDS_PER_LINE}.0::DOUBLE)")


def paragraph_cost(x: str) -> str:
    return f"({line_cost(x)} + {C.PARAGRAPH_SPACING}::DOUBLE)"


def split_paragraphs(x: str) -> str:
    parts = f"regexp_split_to_array(coalesce({x}, ''), {q(T.LINE_BREAK)})"
    return f"list_filter(list_transform({parts}, lambda p: {strip('p')}), lambda p: length(p) > 0)"


def clip_source(x: str, lim: str) -> str:
    head = f"CAST(floor(({lim})::DOUBLE * {C.CLIP_HEAD_SHARE}::DOUBLE) AS INTEGER)"
    tail = f"(({lim}) - {head})"
    tail_text = f"(CASE WHEN {tail} > 0 THEN right({x}, {tail}) ELSE '' END)"
    clipped = f"{rstrip(f'substr({x}, 1, {head})')} || {q(C.CLIP_MARKER)} || {lstrip(tail_text)}"
    return f"(CASE WHEN ({lim}) <= 0 OR length({x}) <= ({lim}) THEN {x} ELSE {clipped} END)"


def slug(run_date: str, link: str, title: str) -> str:
    return (f"(strftime({run_date}, '%Y-%m-%d') || '-' || "
            f"substr(sha1(coalesce(nullif({link}, ''), {title}, '')), 1, 10))")


def long_form(category: str, markers) -> str:
    c = f"lower(coalesce({category}, ''))"
    parts = [f"contains({c}, lower({q(m)}))" for m in markers] or ["false"]
    return "(" + " OR ".join(parts) + ")"


def interest(title: str, summary: str, keywords) -> str:
    hay = f"lower(concat_ws(' ', coalesce({title}, ''), coalesce({summary}, '')))"
    parts = [f"CAST(contains({hay}, lower({q(k)})) AS INTEGER)" for k in keywords] or ["0"]
    return "(" + " + ".join(parts) + ")"


def lead_sentence(x: str) -> str:
    t = f"coalesce({x}, '')"
    s = f"regexp_extract({t}, {q(r'^[ \t\n\r]*([^.!?]*[.!?])')}, 1)"
    return strip(f"(CASE WHEN length({s}) > 0 THEN {s} ELSE split_part({t}, chr(10), 1) END)")


def unescape(x: str) -> str:
    out = x
    for ent, ch in H.ENTITIES:
        out = f"replace({out}, {q(ent)}, {q(ch)})"
    return out


def page_body(h: str) -> str:
    h = f"coalesce({h}, '')"
    art = f"regexp_extract({h}, {q(H.ARTICLE)}, 1)"
    frag = f"(CASE WHEN length({art}) > 0 THEN {art} ELSE regexp_extract({h}, {q(H.BODY)}, 1) END)"
    out = f"regexp_replace({frag}, {q(H.COMMENT)}, '', 'g')"
    for tag in H.DROP_BLOCKS:
        out = f"regexp_replace({out}, {q(rf'(?is)<{tag}\b[^>]*>.*?</{tag}\s*>')}, '', 'g')"
    out = f"regexp_replace({out}, {q(H.BLOCK_TAG)}, chr(10), 'g')"
    out = unescape(f"regexp_replace({out}, {q(H.ANY_TAG)}, '', 'g')")
    lines = f"list_filter(list_transform(string_split({out}, chr(10)), lambda x: {strip('x')}), lambda x: length(x) > 0)"
    return f"array_to_string({lines}, chr(10))"


def page_title(h: str) -> str:
    return strip(unescape(f"regexp_extract(coalesce({h}, ''), {q(H.TITLE)}, 1)"))


def lang_category(lang: str) -> str:
    whens = " ".join(f"WHEN {lang} = {q(code)} THEN {q(cat)}" for code, cat in B.LANG_CATEGORY)
    return f"(CASE {whens} ELSE {q(B.OTHER_CATEGORY)} END)"


ENTRIES = f"""entries AS (
  SELECT CAST(DATE {q(B.FIRST_RUN_DATE)} + CAST((doc_id // {B.DOCS_PER_BLOCK}) * {B.RUNS_PER_BLOCK} + doc_id % {B.RUNS_PER_BLOCK} AS INTEGER) AS DATE) AS run_date,
         CAST(regexp_extract(source, '[0-9]+', 0) AS INTEGER) AS feed_ord,
         source AS feed,
         doc_id AS entry_pos,
         coalesce(page_title, '') AS title,
         'https://' || source || '.example/' || CAST(CASE WHEN doc_id % 11 = 0 AND doc_id >= 200 THEN doc_id - 200
              WHEN doc_id % 7 = 0 AND doc_id >= 140 THEN doc_id - 140 ELSE doc_id END AS VARCHAR) AS link,
         CASE WHEN strpos(text, chr(10)) > 0 THEN trim(substr(text, strpos(text, chr(10)) + 1)) WHEN text IS NOT NULL THEN '' END AS summary,
         text AS full_text, lang,
         {lang_category('lang')} AS category
  FROM documents LEFT JOIN (SELECT page_id, {page_title('html')} AS page_title FROM pages) ON page_id = doc_id // {B.DOCS_PER_PAGE})"""


LINKED = f"""linked AS (SELECT e.* EXCLUDE (full_text), p.body AS full_text FROM entries e
  LEFT JOIN (SELECT page_id, {page_body('html')} AS body FROM pages) p ON p.page_id = CAST(regexp_extract(link, '[0-9]+$', 0) AS BIGINT) // {B.DOCS_PER_PAGE}),
"""


def candidates(settings: C.Settings, limit: bool = True, by_link: bool = False) -> str:
    """CTEs entries, top, bodied, arts: the Spark ``candidate_articles`` chain.  ``by_link``: bodies of the pages by link."""
    n, src = settings.max_articles_per_feed, "linked" if by_link else "entries"
    top = (f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY run_date, feed_ord ORDER BY entry_pos) <= {n}"
           if limit else f"SELECT * FROM {src}")
    return f"""{ENTRIES},
{LINKED if by_link else ''}top AS ({top}),
bodied AS (SELECT *, length(coalesce(full_text, '')) >= {C.MIN_FULLTEXT_CHARS} AS has_full_text,
                 CASE WHEN length(coalesce(full_text, '')) >= {C.MIN_FULLTEXT_CHARS} THEN coalesce(full_text, '')
                      ELSE coalesce(summary, '') END AS text FROM top),
a1 AS (SELECT *, {lead_sentence('text')} AS summary_text FROM bodied WHERE length(text) > 0),
arts AS (SELECT *, {reading_minutes('text')} AS read_minutes,
                {long_form('category', settings.long_form_categories)} AS long_form,
                {interest('title', 'summary_text', settings.interests)} AS interest,
                {slug('run_date', 'link', 'title')} AS slug
         FROM a1),
arts2 AS (SELECT *, read_minutes + 3 * interest + CASE WHEN long_form THEN 5 ELSE 0 END AS deep_score FROM arts)"""


def positioned(settings: C.Settings, limit: bool = True) -> str:
    """CTEs up to ``pos``: category order, in-category rank, day position."""
    return f"{candidates(settings, limit)},{positions('arts2')}"


def positions(articles: str) -> str:
    """CTEs from the named article rows up to ``pos``."""
    return f"""
cats AS (SELECT run_date, category, min({{'f': feed_ord, 'p': entry_pos}}) AS first, count(*) AS n_articles
         FROM {articles} GROUP BY run_date, category),
cats2 AS (SELECT *, dense_rank() OVER (PARTITION BY run_date ORDER BY first.f, first.p) AS cat_ord FROM cats),
cats3 AS (SELECT *, coalesce(sum(n_articles) OVER (PARTITION BY run_date ORDER BY cat_ord
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM cats2),
ranked AS (SELECT a.*, row_number() OVER (PARTITION BY a.run_date, a.category ORDER BY interest DESC, feed_ord, entry_pos) AS cat_rank
           FROM {articles} a),
pos AS (SELECT r.*, c.cat_ord, CAST(c.off + r.cat_rank AS BIGINT) AS pos
        FROM ranked r JOIN cats3 c USING (run_date, category))"""


def recent(settings: C.Settings, limit: bool = False) -> str:
    """CTE ``recent``: the day snapshots (day, pos, title, summary, source)."""
    return f"""{positioned(settings, limit)},
recent AS (SELECT run_date AS day, pos, title, summary_text AS summary, feed AS source FROM pos)"""


def js(x: str) -> str:
    """JSON string literal of a text expression (same escapes as ``bindings.json_str``)."""
    s = f"coalesce({x}, '')"
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        s = f"replace({s}, {q(a)}, {q(b)})"
    return f"('\"' || {s} || '\"')"


def _noise(j: str, key: str, prose: tuple[str, str]) -> str:
    return (f"CASE WHEN {key} % 4 = 1 THEN '```json' || chr(10) || {j} || chr(10) || '```' "
            f"WHEN {key} % 4 = 2 THEN {q(prose[0])} || {j} || {q(prose[1])} "
            f"WHEN {key} % 4 = 3 THEN substr({j}, 1, length({j}) // 2) "
            f"WHEN {key} % 16 = 4 THEN {j} || ' see {{b}}' WHEN {key} % 16 = 8 THEN {j} || {j} ELSE {j} END")


PAIRS = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""


def replies() -> str:
    """CTEs ``pairs``, ``replies(conv_id, reply)``: the synthetic model replies."""
    ans_key = "(CASE WHEN conv_id % 7 = 6 THEN 'reply' ELSE 'answer' END)"
    qa_item = f"""'{{"question": ' || {js('question')} || ', "' || {ans_key} || '": ' || {js('answer')} || '}}'"""
    quiz_item = (f"""'{{"question": ' || {js("CASE WHEN pair_no = 2 THEN ' ' ELSE question END")} || """
                 f"""', "answer": ' || {js('answer')} || '}}'""")
    gloss_item = (f"""'{{"term": ' || {js("split_part(question, ' ', 1)")} || """
                  f"""(CASE WHEN pair_no = 3 THEN '' ELSE ', "definition": ' || {js("split_part(answer, chr(10), 1)")} END) || '}}'""")
    theme_item = (f"""'{{"title": ' || {js("CASE WHEN pair_no = 2 THEN '' ELSE split_part(question, ' ', 1) END")} || """
                  f"""', "body": ' || {js('answer')} || '}}'""")

    def agg(item: str) -> str:
        return f"'[' || string_agg({item}, ', ' ORDER BY pair_no) || ']'"

    members = ", ".join([
        f"""CASE WHEN conv_id % 10 = 2 THEN '"summary": null' WHEN conv_id % 5 <> 4 THEN '"summary": ' || {js('q1')} END""",
        f"""CASE WHEN conv_id % 3 = 0 THEN '"summary_secondary": ' || {js("split_part(a1, chr(10), 1)")} END""",
        """'"qa": ' || qa""", """'"quiz": ' || quiz""", f"""'"brief": ' || {js('a1')}""",
        f"""'"background": ' || {js('a1')}""", """'"points": ' || points""",
        f"""'"implications": ' || {js('alast')}""", """'"glossary": ' || gloss""",
        f"""'"intro": ' || {js('q1')}""", """'"themes": ' || themes"""])
    return f"""{PAIRS},
first_pairs AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pair_no FROM pairs),
rg AS (SELECT conv_id, {agg(qa_item)} AS qa, {agg(quiz_item)} AS quiz, {agg(js('question'))} AS points,
              {agg(gloss_item)} AS gloss, {agg(theme_item)} AS themes,
              max(CASE WHEN pair_no = 1 THEN question END) AS q1, max(CASE WHEN pair_no = 1 THEN answer END) AS a1,
              arg_max(answer, pair_no) AS alast
       FROM first_pairs GROUP BY conv_id),
rj AS (SELECT conv_id, '{{' || concat_ws(', ', {members}) || '}}' AS j FROM rg),
replies AS (SELECT conv_id, {_noise('j', 'conv_id', ('Here is the JSON you asked for:' + chr(10), chr(10) + 'Hope this helps.'))} AS reply FROM rj)"""


EVENT_REPLIES = f"""replies AS (SELECT event_id, {_noise('props', 'event_id', ('Sure, here it is: ', ' -- done'))} AS reply FROM events)"""


def parsed(src: str, key: str) -> str:
    """CTE chain ending in ``parsed(key, reply, j)``: the lenient rule; ``j`` NULL on failure."""
    return f"""u1 AS (SELECT {key}, reply, {strip("coalesce(reply, '')")} AS t FROM {src}),
u2 AS (SELECT *, regexp_replace(t, '^`+|`+$', '', 'g') AS inner_t FROM u1),
u3 AS (SELECT *, CASE WHEN starts_with(t, '```') THEN {strip("CASE WHEN starts_with(lower(inner_t), 'json') THEN substr(inner_t, 5) ELSE inner_t END")}
                      ELSE t END AS u FROM u2),
u4 AS (SELECT *, CASE WHEN strpos(u, '{{') > 0 AND strpos(u, '}}') > 0
                      THEN substr(u, strpos(u, '{{'), greatest(length(u) - strpos(reverse(u), '}}') + 1 - strpos(u, '{{') + 1, 0)) END AS span
       FROM u3),
u5 AS (SELECT *, CASE WHEN json_valid(u) THEN u WHEN json_valid(span) THEN span END AS cand FROM u4),
parsed AS (SELECT {key}, reply, CASE WHEN json_type(cand) = 'OBJECT' THEN CAST(cand AS JSON) END AS j FROM u5)"""


def jtext(j: str, key: str) -> str:
    """``str(data.get(key, "")).strip()``: a JSON null reads as ``None``."""
    return strip(f"coalesce(json_extract_string({j}, '$.{key}'), CASE WHEN json_type({j}, '$.{key}') = 'NULL' THEN 'None' ELSE '' END)")


def jlist(j: str, key: str) -> str:
    return f"(CASE WHEN json_type({j}, '$.{key}') = 'ARRAY' THEN CAST(json_extract({j}, '$.{key}') AS JSON[]) ELSE CAST([] AS JSON[]) END)"


def jlist_ok(j: str, key: str, n, item_ok: str) -> str:
    head = jlist(j, key) if n is None else f"list_slice({jlist(j, key)}, 1, {n})"
    return (f"(json_extract({j}, '$.{key}') IS NULL OR (json_type({j}, '$.{key}') = 'ARRAY' "
            f"AND coalesce(list_bool_and(list_transform({head}, lambda x: {item_ok})), true)))")


def title_edges(titles: str) -> str:
    """CTEs up to ``edges(run, new_title, old_title, ratio)``: directed pairs of distinct titles of
    one run (CTE ``titles`` with run, t) with a matching-block ratio of 0.75 or more; the edit-distance bound
    (ratio <= 1 - levenshtein / (la + lb)) only skips pairs that cannot reach it.  Recursive."""
    return f"""tt AS (SELECT DISTINCT run, t FROM {titles} WHERE t <> ''),
near AS MATERIALIZED (SELECT a.run, a.t AS x, b.t AS y FROM tt a JOIN tt b ON a.run = b.run AND a.t <> b.t
         WHERE levenshtein(a.t, b.t) * 4 <= length(a.t) + length(b.t)),
np AS MATERIALIZED (SELECT row_number() OVER () AS id, x, y FROM (SELECT DISTINCT x, y FROM near)),
blocks(id, x, y, m) AS (
  SELECT id, x, y, 0 FROM np
  UNION ALL
  SELECT id, u.x, u.y, CASE WHEN u.k = 1 THEN len ELSE 0 END
  FROM (SELECT id, x, y, best.len AS len, best.i AS i, best.j AS j
        FROM blocks, LATERAL (
          SELECT i, j, l AS len
          FROM (SELECT unnest(range(1, length(blocks.x) + 1)) AS i) a,
               (SELECT unnest(range(1, length(blocks.y) + 1)) AS j) b,
               (SELECT unnest(range(1, least(length(blocks.x), length(blocks.y)) + 1)) AS l) q
          WHERE i + l - 1 <= length(blocks.x) AND j + l - 1 <= length(blocks.y)
            AND substr(blocks.x, i, l) = substr(blocks.y, j, l)
          ORDER BY l DESC, i, j LIMIT 1) best
        WHERE length(blocks.x) > 0 AND length(blocks.y) > 0) z,
       LATERAL (SELECT * FROM (VALUES
          (1, substr(z.x, 1, z.i - 1), substr(z.y, 1, z.j - 1)),
          (2, substr(z.x, z.i + z.len), substr(z.y, z.j + z.len))) v(k, x, y)) u),
matched AS (SELECT np.x, np.y, 2.0::DOUBLE * sum(m) / (length(np.x) + length(np.y)) AS ratio
            FROM blocks JOIN np USING (id) GROUP BY np.x, np.y),
edges AS (SELECT near.run, near.x AS new_title, near.y AS old_title, ratio
          FROM near JOIN matched USING (x, y) WHERE ratio >= 0.75)"""


def greedy(rows: str, retention_days: int | None, fails: str = "false") -> str:
    """CTEs up to ``accepted(run, pos)``: one pass over CTE ``rows`` (run, f, pos, link, t) in order, after
    ``title_edges``.  A row is taken unless a taken row of its run has its link or a similar title, or
    (with a retention) the state saved at the end of the run before still holds its link.  A row with ``fails`` is
    not taken and blocks nobody."""
    kept = ("a.run = q.run" if retention_days is None else f"(a.run = q.run OR a.run >= q.prev_run - {retention_days})")
    return f"""runs AS (SELECT run, lag(run) OVER (ORDER BY run) AS prev_run FROM (SELECT DISTINCT run FROM run_days)),
olds AS (SELECT run, new_title, list(old_title) AS olds FROM edges GROUP BY run, new_title),
queue AS MATERIALIZED (SELECT q.*, runs.prev_run, list_append(coalesce(olds.olds, []), q.t) AS olds, row_number() OVER (ORDER BY q.run, q.f, q.pos) AS rn
          FROM {rows} q JOIN runs USING (run) LEFT JOIN olds ON olds.run = q.run AND olds.new_title = q.t),
g(rn, run, pos, taken, titles, ok) AS (
  SELECT 0::BIGINT, NULL::DATE, NULL::BIGINT, []::STRUCT(link VARCHAR, run DATE)[], []::VARCHAR[], false
  UNION ALL
  SELECT rn, run, pos, CASE WHEN ok THEN list_append(taken, {{'link': link, 'run': run}}) ELSE taken END,
         CASE WHEN ok AND t <> '' THEN list_append(titles, t) ELSE titles END, ok
  FROM (SELECT q.rn, q.run, q.pos, q.link, q.t, list_filter(g.taken, lambda a: {kept}) AS taken,
               CASE WHEN g.run = q.run THEN g.titles ELSE []::VARCHAR[] END AS titles,
               NOT (len(list_filter(g.taken, lambda a: a.link = q.link AND {kept})) > 0
                    OR (q.t <> '' AND g.run = q.run AND list_has_any(g.titles, q.olds))) AND NOT {fails} AS ok
        FROM g JOIN queue q ON q.rn = g.rn + 1)),
accepted AS (SELECT run, pos FROM g WHERE ok)"""
