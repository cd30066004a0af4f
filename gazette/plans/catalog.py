"""Registry of named queries (Spark) and their DuckDB oracle statements.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the provided
tables; integer outputs are BIGINT in both engines so schemas line up.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from ..operators import ingest, rank
from ..sources import bindings as B
from . import daily
from . import sqlfrag as S

S_ = C.TEST_SETTINGS
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _long(c):
    return F.col(c).cast("long").alias(c)


# ---------------------------------------------------------------- flagship
DEEP_READ_SQL = f"""WITH {S.positioned(S_)}
SELECT run_date, slug, title, feed, category, CAST(read_minutes AS BIGINT) AS read_minutes,
       CAST(interest AS BIGINT) AS interest, long_form, has_full_text, CAST(deep_score AS BIGINT) AS deep_score, pos
FROM pos QUALIFY row_number() OVER (PARTITION BY run_date ORDER BY has_full_text DESC, deep_score DESC, pos) = 1"""


@register("deep_read_pick", DEEP_READ_SQL)
def q_deep_read_pick(spark, sf):
    return daily.deep_reads(spark, sf, S_)


# ------------------------------------------------------- sources and sinks
def _feed_cat_sql(ord_sql: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {S.q(c)}" for i, c in enumerate(B.FEED_CATEGORIES) if c is not None)
    return f"coalesce(CASE ({ord_sql}) % {len(B.FEED_CATEGORIES)} {whens} END, {S.q(C.DEFAULT_CATEGORY)})"


@register("feed_dim", f"""SELECT CAST(regexp_extract(source, '[0-9]+', 0) AS BIGINT) AS feed_ord, source AS name,
  'https://' || source || '.example/rss' AS url,
  {_feed_cat_sql("CAST(regexp_extract(source, '[0-9]+', 0) AS INTEGER)")} AS category
FROM (SELECT DISTINCT source FROM documents)""")
def q_feed_dim(spark, sf):
    return B.feeds(spark, sf).withColumn("feed_ord", F.col("feed_ord").cast("long"))


@register("feed_top_n", f"""WITH {S.ENTRIES}
SELECT run_date, CAST(feed_ord AS BIGINT) AS feed_ord, entry_pos, title, link FROM entries
QUALIFY row_number() OVER (PARTITION BY run_date, feed_ord ORDER BY entry_pos) <= {S_.max_articles_per_feed}""")
def q_feed_top_n(spark, sf):
    top = ingest.feed_top_n(B.entries(spark, sf), S_.max_articles_per_feed)
    return top.select("run_date", _long("feed_ord"), "entry_pos", "title", "link")


@register("page_body", f"SELECT page_id, url, {S.page_body('html')} AS body FROM pages")
def q_page_body(spark, sf):
    return B.bodies(spark, sf).select("page_id", "url", "body")


@register("body_or_fallback", f"""WITH b AS (SELECT page_id, {S.page_body('html')} AS body, {S.page_title('html')} AS fallback FROM pages)
SELECT page_id, length(body) >= {C.MIN_FULLTEXT_CHARS} AS has_full_text,
       CASE WHEN length(body) >= {C.MIN_FULLTEXT_CHARS} THEN body ELSE coalesce(fallback, '') END AS text,
       CAST(length(CASE WHEN length(body) >= {C.MIN_FULLTEXT_CHARS} THEN body ELSE coalesce(fallback, '') END) AS BIGINT) AS n_chars
FROM b""")
def q_body_or_fallback(spark, sf):
    b = ingest.body_or_fallback(B.bodies(spark, sf), body="body", fallback="fallback")
    return b.select("page_id", "has_full_text", "text", F.length("text").cast("long").alias("n_chars"))


# ------------------------------------------------- projections and scalars
@register("normalize_title", f"WITH {S.ENTRIES} SELECT entry_pos, title, {S.norm_title('title')} AS norm_title FROM entries")
def q_normalize_title(spark, sf):
    return B.entries(spark, sf).select("entry_pos", "title", T.normalize_title("title").alias("norm_title"))


@register("article_slug", f"WITH {S.ENTRIES} SELECT entry_pos, {S.slug('run_date', 'link', 'title')} AS slug FROM entries")
def q_article_slug(spark, sf):
    return B.entries(spark, sf).select("entry_pos", T.article_slug("run_date", "link", "title").alias("slug"))


@register("reading_minutes", f"SELECT doc_id, CAST({S.reading_minutes('text')} AS BIGINT) AS read_minutes FROM documents")
def q_reading_minutes(spark, sf):
    d = B.table(spark, sf, "documents")
    return d.select("doc_id", T.reading_minutes("text").cast("long").alias("read_minutes"))


@register("script_counts", f"""SELECT doc_id, CAST({S.cjk('text')} AS BIGINT) AS cjk,
  CAST({S.latin('text')} AS BIGINT) AS latin_words FROM documents""")
def q_script_counts(spark, sf):
    d = B.table(spark, sf, "documents")
    return d.select("doc_id", T.cjk_count("text").cast("long").alias("cjk"),
                    T.latin_word_count("text").cast("long").alias("latin_words"))


_PARAS_SQL = f"""paras AS (
  SELECT doc_id, CAST(generate_subscripts(ps, 1) AS BIGINT) AS para_no, unnest(ps) AS paragraph
  FROM (SELECT doc_id, {S.split_paragraphs('text')} AS ps FROM documents))"""


def _paragraphs(spark, sf):
    d = B.table(spark, sf, "documents")
    return (d.select("doc_id", F.posexplode(T.split_paragraphs("text")).alias("i", "paragraph"))
             .select("doc_id", (F.col("i") + 1).cast("long").alias("para_no"), "paragraph"))


@register("split_paragraphs", f"WITH {_PARAS_SQL} SELECT doc_id, para_no, paragraph FROM paras")
def q_split_paragraphs(spark, sf):
    return _paragraphs(spark, sf)


@register("paragraph_cost", f"WITH {_PARAS_SQL} SELECT doc_id, para_no, {S.paragraph_cost('paragraph')} AS cost FROM paras")
def q_paragraph_cost(spark, sf):
    return _paragraphs(spark, sf).select("doc_id", "para_no", T.paragraph_cost("paragraph").alias("cost"))


@register("clip_source", f"""WITH {S.ENTRIES}, b AS (
  SELECT entry_pos, full_text, CASE WHEN {S.long_form('category', S_.long_form_categories)}
         THEN {S_.longform_source_chars} ELSE {S_.summary_source_chars} END AS budget FROM entries)
SELECT entry_pos, CAST(budget AS BIGINT) AS budget, {S.clip_source('full_text', 'budget')} AS clipped,
       CAST(length({S.clip_source('full_text', 'budget')}) AS BIGINT) AS n_chars FROM b""")
def q_clip_source(spark, sf):
    e = B.entries(spark, sf).withColumn(
        "budget", T.source_budget(T.is_long_form("category", S_.long_form_categories), S_))
    c = T.clip_source("full_text", "budget")
    return e.select("entry_pos", _long("budget"), c.alias("clipped"), F.length(c).cast("long").alias("n_chars"))


@register("source_budget", f"""WITH {S.ENTRIES} SELECT entry_pos, {S.long_form('category', S_.long_form_categories)} AS long_form,
  CAST(CASE WHEN {S.long_form('category', S_.long_form_categories)} THEN {S_.longform_source_chars}
       ELSE {S_.summary_source_chars} END AS BIGINT) AS budget FROM entries""")
def q_source_budget(spark, sf):
    lf = T.is_long_form("category", S_.long_form_categories)
    return B.entries(spark, sf).select("entry_pos", lf.alias("long_form"),
                                       T.source_budget(lf, S_).cast("long").alias("budget"))


@register("is_long_form", f"""WITH {S.ENTRIES} SELECT entry_pos, category,
  {S.long_form('category', S_.long_form_categories)} AS long_form FROM entries""")
def q_is_long_form(spark, sf):
    return B.entries(spark, sf).select("entry_pos", "category",
                                       T.is_long_form("category", S_.long_form_categories).alias("long_form"))


_DATE_STR_SQL = """CASE o_orderkey % 5
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(day(o_orderdate) AS VARCHAR)
    WHEN 2 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(day(o_orderdate) + 27 AS VARCHAR)
    WHEN 3 THEN 'day ' || CAST(o_orderkey AS VARCHAR)
    ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00' END"""


def _date_strings(spark, sf):
    o = B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    y, m, d = (F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"),
               F.dayofmonth("o_orderdate"))
    k = F.col("o_orderkey") % 5
    s = (F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
         .when(k == 1, F.concat_ws("-", y, m, d.cast("string")))
         .when(k == 2, F.concat_ws("-", y, m, (d + 27).cast("string")))
         .when(k == 3, F.concat(F.lit("day "), F.col("o_orderkey").cast("string")))
         .otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00"))))
    return o.select("o_orderkey", s.alias("s"))


@register("date_parse", f"""SELECT o_orderkey, s, CAST(try_strptime(s, '%Y-%m-%d') AS DATE) AS parsed
FROM (SELECT o_orderkey, {_DATE_STR_SQL} AS s FROM orders)""")
def q_date_parse(spark, sf):
    return _date_strings(spark, sf).select("o_orderkey", "s", T.date_parse("s").alias("parsed"))


# ------------------------------------------------------------------ filters
@register("drop_no_text", f"""WITH {S.candidates(S_, False)}
SELECT entry_pos, has_full_text, CAST(length(text) AS BIGINT) AS n_chars FROM bodied WHERE length(text) > 0""")
def q_drop_no_text(spark, sf):
    kept = ingest.drop_no_text(ingest.body_or_fallback(B.entries(spark, sf)))
    return kept.select("entry_pos", "has_full_text", F.length("text").cast("long").alias("n_chars"))


@register("weekly_gate", f"""WITH {S.ENTRIES}
SELECT DISTINCT run_date, {str(S_.weekly_roundup).lower()} AND isodow(run_date) - 1 = {S_.weekly_roundup_weekday} AS run_weekly
FROM entries""")
def q_weekly_gate(spark, sf):
    from ..operators import history as Hs
    days = B.entries(spark, sf).select("run_date").distinct()
    return days.select("run_date", Hs.weekly_gate("run_date", S_).alias("run_weekly"))


# ------------------------------------------------- scores, groups, ranking
def _all_articles(spark, sf):
    return daily.candidate_articles(B.entries(spark, sf), S_, limit=False)


@register("interest_score", f"WITH {S.candidates(S_, False)} SELECT entry_pos, CAST(interest AS BIGINT) AS interest FROM arts2")
def q_interest_score(spark, sf):
    return _all_articles(spark, sf).select("entry_pos", _long("interest"))


@register("deep_score", f"""WITH {S.candidates(S_, False)} SELECT entry_pos, CAST(read_minutes AS BIGINT) AS read_minutes,
  CAST(interest AS BIGINT) AS interest, long_form, CAST(deep_score AS BIGINT) AS deep_score FROM arts2""")
def q_deep_score(spark, sf):
    return _all_articles(spark, sf).select("entry_pos", _long("read_minutes"), _long("interest"), "long_form",
                                           _long("deep_score"))


@register("category_groups", f"""WITH {S.positioned(S_, False)}
SELECT run_date, category, CAST(first.f AS BIGINT) AS first_feed_ord, CAST(cat_ord AS BIGINT) AS cat_ord,
       CAST(n_articles AS BIGINT) AS n_articles FROM cats2""")
def q_category_groups(spark, sf):
    g = rank.category_groups(_all_articles(spark, sf))
    return g.select("run_date", "category", _long("first_feed_ord"), _long("cat_ord"), _long("n_articles"))


@register("rank_in_category", f"""WITH {S.positioned(S_, False)}
SELECT run_date, category, entry_pos, CAST(interest AS BIGINT) AS interest, CAST(cat_rank AS BIGINT) AS cat_rank FROM ranked""")
def q_rank_in_category(spark, sf):
    keys = _all_articles(spark, sf).select("run_date", "category", "feed_ord", "entry_pos", "interest")
    r = rank.rank_in_category(keys)
    return r.select("run_date", "category", "entry_pos", _long("interest"), _long("cat_rank"))


@register("category_concat", f"""WITH {S.candidates(S_, False)}
SELECT run_date, category, entry_pos, CAST(row_number() OVER (PARTITION BY run_date, category ORDER BY feed_ord, entry_pos) AS BIGINT) AS concat_pos
FROM arts2""")
def q_category_concat(spark, sf):
    c = rank.category_concat(_all_articles(spark, sf).select("run_date", "category", "feed_ord", "entry_pos"))
    return c.select("run_date", "category", "entry_pos", _long("concat_pos"))


@register("day_flatten", f"WITH {S.recent(S_, False)} SELECT day, pos, title, summary, source FROM recent")
def q_day_flatten(spark, sf):
    return daily.recent_rows(spark, sf, S_, limit=False)


@register("digest_totals", f"""WITH {S.positioned(S_, False)}
SELECT run_date, feed, count(*) AS n_articles, CAST(sum(read_minutes) AS BIGINT) AS minutes,
       avg(CAST(has_full_text AS DOUBLE)) AS full_text_share, CAST(grouping(run_date, feed) AS BIGINT) AS level
FROM pos GROUP BY ROLLUP (run_date, feed)""")
def q_digest_totals(spark, sf):
    return rank.digest_totals(_all_articles(spark, sf))


@register("feed_lookup", f"""WITH {S.ENTRIES}, feeds AS (
  SELECT CAST(regexp_extract(source, '[0-9]+', 0) AS INTEGER) AS feed_ord, source AS name,
         {_feed_cat_sql("CAST(regexp_extract(source, '[0-9]+', 0) AS INTEGER)")} AS category
  FROM (SELECT DISTINCT source FROM documents))
SELECT e.entry_pos, f.name AS source, f.category AS feed_category FROM entries e LEFT JOIN feeds f USING (feed_ord)""")
def q_feed_lookup(spark, sf):
    return ingest.feed_lookup(B.entries(spark, sf), B.feeds(spark, sf)).select("entry_pos", "source", "feed_category")


# --------------------------------------------------------- state over days
SEEN_HOLD = S_.seen_retention_days + 1


@register("seen_anti", f"""WITH {S.ENTRIES}, seen AS (SELECT DISTINCT link, run_date AS first_seen FROM entries)
SELECT e.run_date, e.entry_pos, e.link FROM entries e
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.link = e.link
                  AND s.first_seen >= e.run_date - {SEEN_HOLD} AND s.first_seen < e.run_date)""")
def q_seen_anti(spark, sf):
    e = B.entries(spark, sf)
    seen = e.select("link", F.col("run_date").alias("first_seen")).distinct()
    return ingest.seen_anti_by_day(e, seen, SEEN_HOLD).select("run_date", "entry_pos", "link")


_FILES_SQL = f"""files AS (
  SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y-%m-%d') AS d,
         strftime(o_orderdate, '%Y-%m-%d') || '-' || substr(sha1(CAST(o_orderkey AS VARCHAR)), 1, 10) AS slug FROM orders),
named AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 4 <= 1 THEN 'archive' ELSE 'article' END AS kind,
    CASE WHEN o_orderkey % 13 = 0 THEN 'draft-' || d || '.html'
         WHEN o_orderkey % 4 = 0 THEN d || '.html'
         WHEN o_orderkey % 4 = 1 THEN d || '-sans.html'
         WHEN o_orderkey % 4 = 2 THEN slug || '.html'
         ELSE slug || '-p2-sans.html' END AS file_name FROM files),
dated AS (
  SELECT *, CASE WHEN kind = 'article' THEN CAST(try_strptime(substr(file_name, 1, 10), '%Y-%m-%d') AS DATE)
                 ELSE CAST(try_strptime(regexp_replace(regexp_replace(file_name, '\\.html$', ''), '-sans$', ''), '%Y-%m-%d') AS DATE)
            END AS file_date FROM named)"""


@register("retention_dated_files", f"""WITH {_FILES_SQL}
SELECT o_orderkey, kind, file_name, file_date FROM dated
WHERE file_date IS NULL OR file_date >= DATE {S.q(B.FILE_RUN_DATE)} - {S_.archive_retention_days}""")
def q_retention_dated_files(spark, sf):
    from ..operators import history as Hs
    return Hs.retention_dated_files(B.dated_files(spark, sf), B.FILE_RUN_DATE, S_.archive_retention_days)


@register("retention_recent", f"""WITH {_FILES_SQL}, keys AS (SELECT o_orderkey, regexp_replace(file_name, '(-sans)?\\.html$', '') AS day_key FROM named)
SELECT o_orderkey, day_key, CAST(try_strptime(day_key, '%Y-%m-%d') AS DATE) AS day FROM keys
WHERE try_strptime(day_key, '%Y-%m-%d') IS NOT NULL
  AND CAST(try_strptime(day_key, '%Y-%m-%d') AS DATE) >= DATE {S.q(B.FILE_RUN_DATE)} - {S_.recent_retention_days}""")
def q_retention_recent(spark, sf):
    from ..operators import history as Hs
    keys = B.dated_files(spark, sf).select("o_orderkey", F.regexp_replace("file_name", r"(-sans)?\.html$", "").alias("day_key"))
    return Hs.retention_recent(keys, "day_key", B.FILE_RUN_DATE, S_.recent_retention_days)


_SIGHT_SQL = "sight AS (SELECT DISTINCT CAST(user_id AS VARCHAR) || '/' || event_type AS link, CAST(ts AS DATE) AS day FROM events)"


@register("previous_day", f"""WITH {_SIGHT_SQL}
SELECT day, lag(day) OVER (ORDER BY day) AS prev_day FROM (SELECT DISTINCT day FROM sight)""")
def q_previous_day(spark, sf):
    from ..operators import history as Hs
    return Hs.previous_day(B.sightings(spark, sf))


@register("archive_prev_link", f"""WITH {_FILES_SQL}, days AS (SELECT DISTINCT file_date AS day FROM dated WHERE kind = 'archive' AND file_date IS NOT NULL),
m AS (SELECT max(day) AS m1 FROM days), m2 AS (SELECT max(day) AS m2 FROM days, m WHERE day < m1)
SELECT day, CASE WHEN day = m1 THEN m2 ELSE m1 END || '.html' AS prev_file FROM days, m, m2""")
def q_archive_prev_link(spark, sf):
    from ..operators import history as Hs
    f = Hs.retention_dated_files(B.dated_files(spark, sf), B.FILE_RUN_DATE, 0)
    days = f.where((F.col("kind") == "archive") & F.col("file_date").isNotNull()).select(F.col("file_date").alias("day"))
    p = Hs.archive_prev(days)
    return p.select("day", F.concat(F.date_format("prev_day", "yyyy-MM-dd"), F.lit(".html")).alias("prev_file"))


@register("archive_index", f"""WITH {_FILES_SQL}, stems AS (SELECT DISTINCT regexp_replace(file_name, '\\.html$', '') AS day_key FROM named
  WHERE kind = 'archive' AND file_name LIKE '%.html' AND file_name NOT LIKE '%-sans.html' AND file_name <> 'index.html')
SELECT day_key, row_number() OVER (ORDER BY day_key DESC) AS position FROM stems""")
def q_archive_index(spark, sf):
    from ..operators import history as Hs
    return Hs.archive_index(B.dated_files(spark, sf))


@register("recent_before", f"""WITH {S.recent(S_, False)} SELECT max(day) AS newest, count(DISTINCT day) AS n_days FROM recent""")
def q_recent_before(spark, sf):
    r = daily.recent_rows(spark, sf, S_, limit=False)
    return r.agg(F.max("day").alias("newest"), F.countDistinct("day").alias("n_days"))


@register("week_join", f"""WITH {S.recent(S_, False)}, targets AS (SELECT DISTINCT day AS target_day FROM recent)
SELECT t.target_day, r.day, r.pos, r.title FROM recent r JOIN targets t ON r.day BETWEEN t.target_day - 6 AND t.target_day""")
def q_week_join(spark, sf):
    from ..operators import history as Hs
    r = daily.recent_rows(spark, sf, S_, limit=False)
    return Hs.week_join(r, r.select("day")).select("target_day", "day", "pos", "title")


_WEEK_SQL = f"""{S.recent(S_, False)}, targets AS (SELECT DISTINCT day AS target_day FROM recent),
wk AS (SELECT t.target_day, r.*, row_number() OVER (PARTITION BY t.target_day ORDER BY r.day, r.pos) AS week_pos
       FROM recent r JOIN targets t ON r.day BETWEEN t.target_day - 6 AND t.target_day)"""


@register("week_articles", f"""WITH {_WEEK_SQL}
SELECT target_day, CAST(week_pos AS BIGINT) AS week_pos, day, pos, title FROM wk WHERE week_pos <= {C.WEEKLY_MAX_ARTICLES}""")
def q_week_articles(spark, sf):
    from ..operators import history as Hs
    r = daily.recent_rows(spark, sf, S_, limit=False)
    return Hs.week_articles(r, r.select("day")).select("target_day", _long("week_pos"), "day", "pos", "title")


@register("week_label", f"""WITH {_WEEK_SQL}
SELECT target_day, count(*) AS n_articles,
       CASE WHEN count(*) > 0 THEN strftime(target_day - 6, '%Y-%m-%d') || ' – ' || strftime(target_day, '%Y-%m-%d') ELSE '' END AS week_label
FROM wk GROUP BY target_day""")
def q_week_label(spark, sf):
    from ..operators import history as Hs
    r = daily.recent_rows(spark, sf, S_, limit=False)
    n = Hs.week_join(r, r.select("day")).groupBy("target_day").agg(F.count(F.lit(1)).alias("n_articles"))
    return n.select("target_day", "n_articles", Hs.week_label("target_day", "n_articles").alias("week_label"))


_REPLAY_SQL = f"""{_SIGHT_SQL},
runs AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev_run FROM (SELECT DISTINCT day FROM sight)),
x AS (SELECT s.link, s.day, r.prev_run, row_number() OVER (PARTITION BY s.link ORDER BY s.day) AS rn FROM sight s JOIN runs r USING (day)),
rec(link, rn, day, last, acc) AS (
  SELECT link, rn, day, day, true FROM x WHERE rn = 1
  UNION ALL
  SELECT x.link, x.rn, x.day,
         CASE WHEN rec.last < x.prev_run - {S_.seen_retention_days} THEN x.day ELSE rec.last END,
         rec.last < x.prev_run - {S_.seen_retention_days}
  FROM rec JOIN x ON x.link = rec.link AND x.rn = rec.rn + 1),
accepted AS (SELECT link, day FROM rec WHERE acc)"""


@register("replay_seen", f"WITH RECURSIVE {_REPLAY_SQL} SELECT link, day FROM accepted")
def q_replay_seen(spark, sf):
    from ..operators import history as Hs
    return Hs.replay_seen(B.sightings(spark, sf), S_.seen_retention_days)


@register("seen_upsert", f"""WITH RECURSIVE {_REPLAY_SQL},
last_day AS (SELECT max(day) AS d FROM sight)
SELECT link, max(day) AS first_seen FROM accepted GROUP BY link""")
def q_seen_upsert(spark, sf):
    from ..operators import history as Hs
    acc = Hs.replay_seen(B.sightings(spark, sf), S_.seen_retention_days).select("link", F.col("day").alias("first_seen"))
    last = acc.select(F.max("first_seen")).scalar()
    state = acc.where(F.col("first_seen") < last)
    new = acc.where(F.col("first_seen") == last)
    return Hs.seen_upsert(state, new)


@register("recent_upsert", f"""WITH {S.recent(S_, False)}, last AS (SELECT max(day) AS d FROM recent),
today AS (SELECT p.run_date AS day, CAST(row_number() OVER (ORDER BY p.pos) AS BIGINT) AS pos, p.title, p.summary_text AS summary, p.feed AS source
          FROM pos p, last WHERE p.run_date = last.d AND p.has_full_text)
SELECT day, pos, title, summary, source FROM recent WHERE day <> (SELECT d FROM last)
UNION ALL SELECT day, pos, title, summary, source FROM today""")
def q_recent_upsert(spark, sf):
    from ..operators import history as Hs
    from ..operators.ordering import ranked
    arts = daily.positioned(_all_articles(spark, sf))
    recent = rank.day_flatten(arts)
    last = recent.select(F.max("day")).scalar()
    rerun = arts.where((F.col("run_date") == last) & F.col("has_full_text"))
    today = ranked(rerun, ["run_date"], [F.col("pos").asc()], "pos2").withColumn("pos", F.col("pos2").cast("long"))
    return Hs.recent_upsert(recent, rank.day_flatten(today))


@register("retention_seen", f"""WITH RECURSIVE {_REPLAY_SQL}, state AS (SELECT link, max(day) AS first_seen FROM accepted GROUP BY link)
SELECT link, first_seen FROM state WHERE first_seen >= (SELECT max(day) FROM sight) - {S_.seen_retention_days}""")
def q_retention_seen(spark, sf):
    """The seen state after replaying the whole history, pruned at the end of the last run."""
    from ..operators import history as Hs
    s = B.sightings(spark, sf)
    acc = Hs.replay_seen(s, S_.seen_retention_days)
    state = acc.groupBy("link").agg(F.max("day").alias("first_seen"))
    return Hs.retention_seen(state, s.select(F.max("day")).scalar(), S_.seen_retention_days)


# ------------------------------------------------------------------ paging
_PAGE_LINES = S_.article_page_lines

_PAGINATE_SQL = f"""{_PARAS_SQL},
costs AS (SELECT doc_id, para_no, paragraph, {S.paragraph_cost('paragraph')} AS cost FROM paras),
rec(doc_id, para_no, page_no, used) AS (
  SELECT doc_id, para_no, 1, cost FROM costs WHERE para_no = 1
  UNION ALL
  SELECT c.doc_id, c.para_no,
         CASE WHEN r.used + c.cost > {_PAGE_LINES}.0 THEN r.page_no + 1 ELSE r.page_no END,
         CASE WHEN r.used + c.cost > {_PAGE_LINES}.0 THEN 0.0::DOUBLE + c.cost ELSE r.used + c.cost END
  FROM rec r JOIN costs c ON c.doc_id = r.doc_id AND c.para_no = r.para_no + 1)"""


def _doc_articles(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", "text")


@register("paginate", f"""WITH RECURSIVE {_PAGINATE_SQL}
SELECT doc_id, para_no, CAST(page_no AS BIGINT) AS page_no FROM rec""")
def q_paginate(spark, sf):
    from ..operators import paging as P
    a = P.paginate(_doc_articles(spark, sf), "text", _PAGE_LINES)
    z = a.select("doc_id", F.posexplode(P.paragraph_pages()).alias("i", "page_no"))
    return z.select("doc_id", (F.col("i") + 1).cast("long").alias("para_no"), F.col("page_no").cast("long").alias("page_no"))


_DOC_PAGES_SQL = f"""{_PAGINATE_SQL},
docs AS (SELECT doc_id, {S.slug("DATE '2024-01-01'", "''", "CAST(doc_id AS VARCHAR)")} AS slug,
                {S.reading_minutes('text')} AS read_minutes FROM documents),
pg AS (SELECT r.doc_id, r.page_no, count(*) AS n_paragraphs,
              string_agg(c.paragraph, chr(10) ORDER BY c.para_no) AS page_text
       FROM rec r JOIN costs c USING (doc_id, para_no) GROUP BY r.doc_id, r.page_no),
pg_all AS (SELECT d.doc_id, d.slug, d.read_minutes, coalesce(pg.page_no, 1) AS page_no,
                  coalesce(pg.n_paragraphs, 0) AS n_paragraphs, coalesce(pg.page_text, '') AS page_text
           FROM docs d LEFT JOIN pg USING (doc_id)),
pg_tot AS (SELECT *, max(page_no) OVER (PARTITION BY doc_id) AS page_total FROM pg_all),
fonts AS (SELECT * FROM (VALUES {", ".join(f"({S.q(n)}, {S.q(s)})" for n, s in C.FONTS)}) f(font, suffix)),
man AS (SELECT p.*, f.font, f.suffix,
  CASE WHEN page_no = 1 THEN slug || '.html' ELSE slug || '-p' || page_no || '.html' END AS base,
  CASE WHEN page_no > 1 THEN CASE WHEN page_no - 1 = 1 THEN slug || '.html' ELSE slug || '-p' || (page_no - 1) || '.html' END END AS prev_base,
  CASE WHEN page_no < page_total THEN slug || '-p' || (page_no + 1) || '.html' END AS next_base
  FROM pg_tot p, fonts f)"""


def _sfx(col: str) -> str:
    return f"CASE WHEN suffix = '' THEN {col} ELSE substr({col}, 1, length({col}) - 5) || suffix || '.html' END"


def _doc_pages(spark, sf):
    from ..operators import paging as P
    d = _doc_articles(spark, sf).select(
        "doc_id", "text", T.article_slug(F.lit("2024-01-01").cast("date"), F.lit(""), F.col("doc_id").cast("string")).alias("slug"),
        T.reading_minutes("text").alias("read_minutes"))
    return P.page_manifest(d, S_)


@register("page_file_name", f"""WITH RECURSIVE {_DOC_PAGES_SQL}
SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, font, {_sfx('base')} AS file_name FROM man""")
def q_page_file_name(spark, sf):
    return _doc_pages(spark, sf).select("doc_id", _long("page_no"), "font", "file_name")


@register("font_cross", f"""WITH RECURSIVE {_DOC_PAGES_SQL}
SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, font, suffix FROM man""")
def q_font_cross(spark, sf):
    return _doc_pages(spark, sf).select("doc_id", _long("page_no"), "font", "suffix")


@register("page_neighbours", f"""WITH RECURSIVE {_DOC_PAGES_SQL}
SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, font, {_sfx('prev_base')} AS prev_file, {_sfx('next_base')} AS next_file FROM man""")
def q_page_neighbours(spark, sf):
    return _doc_pages(spark, sf).select("doc_id", _long("page_no"), "font", "prev_file", "next_file")


@register("page_first_last", f"""WITH RECURSIVE {_DOC_PAGES_SQL}
SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, CAST(page_total AS BIGINT) AS page_total, font,
       CAST(CASE WHEN page_no = 1 THEN read_minutes END AS BIGINT) AS minutes_shown, page_no = page_total AS show_qa FROM man""")
def q_page_first_last(spark, sf):
    return _doc_pages(spark, sf).select("doc_id", _long("page_no"), _long("page_total"), "font",
                                        F.col("minutes_shown").cast("long").alias("minutes_shown"), "show_qa")


@register("page_manifest", f"""WITH RECURSIVE {_DOC_PAGES_SQL}
SELECT doc_id, slug, CAST(page_no AS BIGINT) AS page_no, CAST(page_total AS BIGINT) AS page_total, font,
       {_sfx('base')} AS file_name, {_sfx('prev_base')} AS prev_file, {_sfx('next_base')} AS next_file,
       CAST(n_paragraphs AS BIGINT) AS n_paragraphs, page_text FROM man""")
def q_page_manifest(spark, sf):
    m = _doc_pages(spark, sf)
    return m.select("doc_id", "slug", _long("page_no"), _long("page_total"), "font", "file_name", "prev_file",
                    "next_file", F.size("page_paragraphs").cast("long").alias("n_paragraphs"),
                    F.array_join("page_paragraphs", "\n").alias("page_text"))


# ------------------------------------------------------------------ replies
from ..functions import replies as R  # noqa: E402


def _parsed(spark, sf):
    return R.with_parsed(B.replies(spark, sf))


_BOTH_QA = "(json_type(x, '$.question') IS NOT NULL AND json_type(x, '$.answer') IS NOT NULL)"
_SUMMARY_OK = f"(j IS NOT NULL AND json_extract(j, '$.summary') IS NOT NULL AND {S.jlist_ok('j', 'qa', 3, _BOTH_QA)})"


@register("parse_reply", f"""WITH {S.EVENT_REPLIES}, {S.parsed('replies', 'event_id')}
SELECT event_id, j IS NOT NULL AS reply_ok, json_extract_string(j, '$.k') AS k FROM parsed""")
def q_parse_reply(spark, sf):
    p = R.with_parsed(B.event_replies(spark, sf))
    return p.select("event_id", F.col("v").isNotNull().alias("reply_ok"), R.field("v", "$.k").alias("k"))


@register("clean_summary", f"""WITH {S.replies()}, {S.parsed('replies', 'conv_id')}
SELECT conv_id, {_SUMMARY_OK} AS reply_ok, {S.jtext('j', 'summary')} AS summary,
       {S.jtext('j', 'summary_secondary')} AS summary_secondary,
       CAST(len(list_slice({S.jlist('j', 'qa')}, 1, 3)) AS BIGINT) AS n_qa FROM parsed""")
def q_clean_summary(spark, sf):
    c = R.summary_reply(_parsed(spark, sf))
    return c.select("conv_id", "reply_ok", "summary", "summary_secondary", F.size("qa").cast("long").alias("n_qa"))


@register("drop_failed_reply", f"""WITH {S.replies()}, {S.parsed('replies', 'conv_id')}
SELECT conv_id, {S.jtext('j', 'summary')} AS summary FROM parsed WHERE {_SUMMARY_OK}""")
def q_drop_failed_reply(spark, sf):
    c = R.summary_reply(_parsed(spark, sf))
    return c.where(F.col("reply_ok")).select("conv_id", "summary")


@register("qa_items", f"""WITH {S.replies()}, {S.parsed('replies', 'conv_id')},
it AS (SELECT conv_id, unnest(list_slice({S.jlist('j', 'qa')}, 1, 3)) AS x,
              unnest(generate_series(1, len(list_slice({S.jlist('j', 'qa')}, 1, 3)))) AS item_no
       FROM parsed WHERE {_SUMMARY_OK})
SELECT conv_id, CAST(item_no AS BIGINT) AS item_no, {S.jtext('x', 'question')} AS question, {S.jtext('x', 'answer')} AS answer FROM it""")
def q_qa_items(spark, sf):
    c = R.summary_reply(_parsed(spark, sf)).where(F.col("reply_ok"))
    e = c.select("conv_id", F.posexplode("qa").alias("i", "qa"))
    return e.select("conv_id", (F.col("i") + 1).cast("long").alias("item_no"), "qa.question", "qa.answer")


_N_QUIZ = S_.quiz_questions
_QUIZ_OK = f"(j IS NOT NULL AND {S.jlist_ok('j', 'quiz', _N_QUIZ, "json_type(x) = 'OBJECT'")})"


@register("clean_quiz", f"""WITH {S.replies()}, {S.parsed('replies', 'conv_id')},
it AS (SELECT conv_id, unnest(list_slice({S.jlist('j', 'quiz')}, 1, {_N_QUIZ})) AS x,
              unnest(generate_series(1, len(list_slice({S.jlist('j', 'quiz')}, 1, {_N_QUIZ})))) AS src_no
       FROM parsed WHERE {_QUIZ_OK}),
kept AS (SELECT conv_id, src_no, {S.jtext('x', 'question')} AS question, {S.jtext('x', 'answer')} AS answer FROM it)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY src_no) AS BIGINT) AS item_no, question, answer
FROM kept WHERE length(question) > 0 AND length(answer) > 0""")
def q_clean_quiz(spark, sf):
    c = R.quiz_reply(_parsed(spark, sf), _N_QUIZ).where(F.col("reply_ok"))
    e = c.select("conv_id", F.posexplode("quiz").alias("i", "q"))
    return e.select("conv_id", (F.col("i") + 1).cast("long").alias("item_no"), "q.question", "q.answer")


_GLOSS_ITEM_OK = "json_type(x) = 'OBJECT'"


@register("clean_deep", f"""WITH {S.replies()}, {S.parsed('replies', 'conv_id')},
d AS (SELECT conv_id, {S.jtext('j', 'background')} AS background, {S.jtext('j', 'implications')} AS implications,
        len(list_filter(list_transform({S.jlist('j', 'points')}, lambda x: {S.strip("coalesce(json_extract_string(x, '$'), '')")}), lambda p: length(p) > 0)) AS n_points,
        len(list_filter({S.jlist('j', 'glossary')}, lambda x: length({S.jtext('x', 'term')}) > 0 AND length({S.jtext('x', 'definition')}) > 0)) AS n_glossary
      FROM parsed WHERE j IS NOT NULL AND {S.jlist_ok('j', 'glossary', None, _GLOSS_ITEM_OK)})
SELECT conv_id, background, CAST(n_points AS BIGINT) AS n_points, implications, CAST(n_glossary AS BIGINT) AS n_glossary,
       (length(background) > 0 OR n_points > 0 OR length(implications) > 0 OR n_glossary > 0) AS keep FROM d""")
def q_clean_deep(spark, sf):
    c = R.deep_reply(_parsed(spark, sf)).where(F.col("reply_ok"))
    return c.select("conv_id", "background", F.size("points").cast("long").alias("n_points"), "implications",
                    F.size("glossary").cast("long").alias("n_glossary"), "keep")


_THEMES_SQL = f"""{S.replies()}, {S.parsed('replies', 'conv_id')},
ok AS (SELECT * FROM parsed WHERE j IS NOT NULL AND {S.jlist_ok('j', 'themes', None, "json_type(x) = 'OBJECT'")}),
th AS (SELECT conv_id, unnest({S.jlist('j', 'themes')}) AS x, unnest(generate_series(1, len({S.jlist('j', 'themes')}))) AS src_no FROM ok),
th2 AS (SELECT conv_id, src_no, {S.jtext('x', 'title')} AS title, {S.jtext('x', 'body')} AS body FROM th),
kept AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY src_no) AS theme_no FROM th2
         WHERE length(title) > 0 AND length(body) > 0)"""


@register("clean_weekly", f"""WITH {_THEMES_SQL}
SELECT o.conv_id, {S.jtext('o.j', 'intro')} AS intro, CAST(count(k.conv_id) AS BIGINT) AS n_themes,
       (length({S.jtext('o.j', 'intro')}) > 0 OR count(k.conv_id) > 0) AS keep
FROM ok o LEFT JOIN kept k USING (conv_id) GROUP BY o.conv_id, o.j""")
def q_clean_weekly(spark, sf):
    c = R.weekly_reply(_parsed(spark, sf)).where(F.col("reply_ok"))
    return c.select("conv_id", "intro", F.size("themes").cast("long").alias("n_themes"), "keep")


@register("theme_paragraphs", f"""WITH {_THEMES_SQL},
ps AS (SELECT conv_id, theme_no, list_filter(list_transform(string_split(body, chr(10)), lambda p: {S.strip('p')}), lambda p: length(p) > 0) AS paras FROM kept)
SELECT conv_id, CAST(theme_no AS BIGINT) AS theme_no, CAST(generate_subscripts(paras, 1) AS BIGINT) AS para_no, unnest(paras) AS paragraph FROM ps""")
def q_theme_paragraphs(spark, sf):
    c = R.weekly_reply(_parsed(spark, sf)).where(F.col("reply_ok"))
    t = c.select("conv_id", F.posexplode("themes").alias("ti", "t"))
    p = t.select("conv_id", (F.col("ti") + 1).cast("long").alias("theme_no"),
                 F.posexplode(R.theme_paragraphs("t.body")).alias("pi", "paragraph"))
    return p.select("conv_id", "theme_no", (F.col("pi") + 1).cast("long").alias("para_no"), "paragraph")


@register("clean_brief", f"""WITH {S.replies()}, {S.parsed('replies', 'conv_id')}
SELECT conv_id, {S.jtext('j', 'brief')} AS brief FROM parsed WHERE j IS NOT NULL""")
def q_clean_brief(spark, sf):
    p = _parsed(spark, sf).where(F.col("v").isNotNull())
    return p.select("conv_id", R.brief_text("v").alias("brief"))


# -------------------------------------------------------- near-duplicates
from ..operators import dedup as D  # noqa: E402

_RATIO_SQL = """WITH RECURSIVE n AS (SELECT DISTINCT p_name AS s FROM part),
p AS (SELECT row_number() OVER (ORDER BY a.s, b.s) AS id, b.s AS x, a.s AS y FROM n a JOIN n b ON a.s < b.s),
w(id, x, y, m) AS (
  SELECT id, x, y, 0 FROM p
  UNION ALL
  SELECT id, u.x, u.y, CASE WHEN u.k = 1 THEN len ELSE 0 END
  FROM (SELECT id, x, y, best.len AS len, best.i AS i, best.j AS j
        FROM w, LATERAL (
          SELECT i, j, l AS len
          FROM (SELECT unnest(range(1, length(w.x) + 1)) AS i) a,
               (SELECT unnest(range(1, length(w.y) + 1)) AS j) b,
               (SELECT unnest(range(1, least(length(w.x), length(w.y)) + 1)) AS l) q
          WHERE i + l - 1 <= length(w.x) AND j + l - 1 <= length(w.y)
            AND substr(w.x, i, l) = substr(w.y, j, l)
          ORDER BY l DESC, i, j LIMIT 1) best
        WHERE length(w.x) > 0 AND length(w.y) > 0) z,
       LATERAL (SELECT * FROM (VALUES
          (1, substr(z.x, 1, z.i - 1), substr(z.y, 1, z.j - 1)),
          (2, substr(z.x, z.i + z.len), substr(z.y, z.j + z.len))) v(k, x, y)) u),
r AS (SELECT p.x, p.y, 2.0::DOUBLE * sum(m) / (length(p.x) + length(p.y)) AS ratio
      FROM w JOIN p USING (id) GROUP BY p.x, p.y)
SELECT x, y, ratio FROM r WHERE ratio >= 0.75"""


@register("title_ratio", _RATIO_SQL)
def q_title_ratio(spark, sf):
    """Exact ratio on the short distinct part names, through the blocked candidate path."""
    t = B.short_titles(spark, sf).withColumn("g", F.lit(0))
    s = D.similar_titles(t, "g", "title")
    return s.where(F.col("new_title") > F.col("old_title")).select(
        F.col("new_title").alias("x"), F.col("old_title").alias("y"), "ratio")


_TITLES_SQL = f"""{S.ENTRIES}, run_days AS (SELECT run_date AS run FROM entries),
rows AS (SELECT run_date AS run, feed_ord AS f, entry_pos AS pos, link, {S.norm_title('title')} AS t FROM entries),
{S.title_edges('rows')}"""


@register("similar_titles", f"""WITH RECURSIVE {_TITLES_SQL} SELECT run AS run_date, new_title, old_title, ratio FROM edges""")
def q_similar_titles(spark, sf):
    """Directed similar-title pairs inside each run."""
    e = B.entries(spark, sf).withColumn("norm_title", T.normalize_title("title"))
    return D.similar_titles(e, "run_date", "norm_title")


@register("dedup_greedy", f"""WITH RECURSIVE {_TITLES_SQL}, {S.greedy('rows', None)}
SELECT a.run AS run_date, a.pos AS entry_pos, rows.link, rows.t AS norm_title FROM accepted a JOIN rows USING (run, pos)""")
def q_dedup_greedy(spark, sf):
    """First-come de-duplication by link and similar title inside each run, over all entries."""
    e = B.entries(spark, sf).withColumn("norm_title", T.normalize_title("title"))
    d = D.dedup_greedy(e)
    return d.where(F.col("accepted")).select("run_date", "entry_pos", "link", "norm_title")


# --------------------------------------------------- prompts and stand-ins
from ..operators import prompts as PR  # noqa: E402
from ..operators import summaries as SM  # noqa: E402
from ..operators.history import week_articles as _week_articles  # noqa: E402


def _recent(spark, sf):
    return daily.recent_rows(spark, sf, S_, limit=False)


_RECENT_SQL = S.recent(S_, False)


# Day prompts cover a run's articles, i.e. after the per-feed limit: one text per day is
# bounded by feeds x limit (configuration), never by the size of the day's input.
_RUN_SQL = S.recent(S_, True)


def _run_recent(spark, sf):
    return daily.recent_rows(spark, sf, S_, limit=True)


@register("brief_prompt", f"""WITH {_RUN_SQL}
SELECT day, count(*) AS n_articles,
       {S.q(PR.BRIEF_HEAD.format(lang=S_.language))} || string_agg(CAST(pos AS VARCHAR) || '. [' || source || '] ' || title || chr(10) || summary,
                chr(10) || chr(10) ORDER BY pos) AS prompt
FROM recent GROUP BY day""")
def q_brief_prompt(spark, sf):
    return PR.brief_prompt(_run_recent(spark, sf), S_).select("day", F.col("n_articles").cast("long").alias("n_articles"), "prompt")


@register("quiz_prompt", f"""WITH {_RUN_SQL},
days AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev_day FROM (SELECT DISTINCT day FROM recent)),
blocks AS (SELECT day AS source_day, string_agg(CAST(pos AS VARCHAR) || '. ' || title || chr(10) || summary, chr(10) || chr(10) ORDER BY pos) AS b
           FROM recent GROUP BY day)
SELECT d.day, b.source_day, {S.q(PR.QUIZ_HEAD.format(n=S_.quiz_questions, lang=S_.language))} || b.b AS prompt
FROM days d JOIN blocks b ON b.source_day = d.prev_day""")
def q_quiz_prompt(spark, sf):
    return PR.quiz_prompt(_run_recent(spark, sf), S_)


@register("weekly_prompt", f"""WITH {_WEEK_SQL}
SELECT target_day, count(*) AS n_articles,
       {S.q(PR.WEEKLY_HEAD.format(lang=S_.language))} || string_agg('- (' || strftime(day, '%Y-%m-%d') || ', ' || source || ') ' || title || ': ' || summary,
                chr(10) ORDER BY week_pos) AS prompt
FROM wk WHERE week_pos <= {C.WEEKLY_MAX_ARTICLES} GROUP BY target_day""")
def q_weekly_prompt(spark, sf):
    r = _recent(spark, sf)
    return PR.weekly_prompt(r, r.select("day"), S_).select(
        "target_day", F.col("n_articles").cast("long").alias("n_articles"), "prompt")


def _article_head_sql():
    sec = PR.SECONDARY.format(lang2=S_.secondary_language) if S_.secondary_language else ""
    return S.q(PR.ARTICLE_HEAD.format(lang=S_.language, secondary=sec))


_CLIPPED_SQL = S.clip_source('text', f'(CASE WHEN long_form THEN {S_.longform_source_chars} ELSE {S_.summary_source_chars} END)')
_TITLE_BODY_SQL = f"chr(10) || chr(10) || 'Title: ' || title || chr(10) || chr(10) || 'Article:' || chr(10) || {_CLIPPED_SQL}"
_ARTICLE_PROMPT_SQL = f"""{_article_head_sql()} || CASE WHEN long_form THEN {S.q(PR.ESSAY_ANGLE)} ELSE {S.q(PR.NEWS_ANGLE)} END || {_TITLE_BODY_SQL}"""


@register("article_prompt", f"""WITH {S.candidates(S_, False)} SELECT entry_pos, {_ARTICLE_PROMPT_SQL} AS prompt FROM arts2""")
def q_article_prompt(spark, sf):
    return PR.article_prompt(_all_articles(spark, sf), S_).select("entry_pos", "prompt")


@register("deep_prompt", f"""WITH {S.positioned(S_)},
pick AS (SELECT * FROM pos QUALIFY row_number() OVER (PARTITION BY run_date ORDER BY has_full_text DESC, deep_score DESC, pos) = 1)
SELECT run_date, slug, {S.q(PR.DEEP_HEAD.format(lang=S_.language))} || chr(10) || chr(10) || 'Title: ' || title || chr(10) || chr(10)
       || 'Article:' || chr(10) || {S.clip_source('text', f'(CASE WHEN long_form THEN {S_.longform_source_chars} ELSE {S_.summary_source_chars} END)')} AS prompt
FROM pick""")
def q_deep_prompt(spark, sf):
    arts = daily.positioned(daily.candidate_articles(B.entries(spark, sf), S_))
    return PR.deep_prompt(rank.deep_read_pick(arts), S_).select("run_date", "slug", "prompt")


_WORD_SQL = S.q(SM.WORD)
_IDF_SQL = f"""nd AS (SELECT count(*) AS n FROM documents),
dw AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), {_WORD_SQL})) AS word FROM documents),
idf AS (SELECT word, ln(CAST((SELECT n FROM nd) AS DOUBLE) / count(*)) AS idf FROM dw GROUP BY word)"""


@register("extractive_summary", f"""WITH {_IDF_SQL},
s0 AS (SELECT doc_id, regexp_extract_all(text, {S.q(SM.SENTENCE)}) AS ss FROM documents),
s1 AS (SELECT doc_id, unnest(ss) AS sentence, unnest(generate_series(0, len(ss) - 1)) AS sno FROM s0),
s2 AS (SELECT doc_id, sno, trim(regexp_replace(sentence, '[\\t\\n\\f\\r ]+', ' ', 'g')) AS sentence FROM s1),
s3 AS (SELECT * FROM s2 WHERE length(sentence) > 0),
w AS (SELECT doc_id, sno, unnest(regexp_extract_all(lower(sentence), {_WORD_SQL})) AS word FROM s3),
sc AS (SELECT doc_id, sno, round(avg(idf), 9) AS score FROM w JOIN idf USING (word) GROUP BY doc_id, sno),
ranked AS (SELECT s3.*, coalesce(sc.score, 0.0) AS score FROM s3 LEFT JOIN sc USING (doc_id, sno)),
top AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, sno) <= {SM.SUMMARY_SENTENCES})
SELECT doc_id, string_agg(sentence, ' ' ORDER BY sno) AS summary FROM top GROUP BY doc_id""")
def q_extractive_summary(spark, sf):
    return SM.extractive_summary(B.table(spark, sf, "documents"), "doc_id", "text")


@register("glossary_terms", f"""WITH {_IDF_SQL},
tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), {_WORD_SQL})) AS word FROM documents) GROUP BY doc_id, word),
sc AS (SELECT doc_id, word, round(tf * idf, 9) AS score FROM tf JOIN idf USING (word))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) AS BIGINT) AS term_rank, word AS term
FROM sc QUALIFY term_rank <= {SM.GLOSSARY_TERMS}""")
def q_glossary_terms(spark, sf):
    return SM.glossary_terms(B.table(spark, sf, "documents"), "doc_id", "text").select("doc_id", "term_rank", "term")


def _theme_sql() -> str:
    hay = "lower(concat_ws(' ', title, summary))"
    whens = " ".join(f"WHEN contains({hay}, lower({S.q(k)})) THEN {S.q(k)}" for k in S_.interests)
    ords = " ".join(f"WHEN theme = {S.q(k)} THEN {i}" for i, k in enumerate(S_.interests))
    return f"""WITH {_WEEK_SQL},
th AS (SELECT target_day, CASE {whens} END AS theme FROM wk WHERE week_pos <= {C.WEEKLY_MAX_ARTICLES}),
g AS (SELECT target_day, theme, count(*) AS n_articles, CASE {ords} END AS kw_ord FROM th WHERE theme IS NOT NULL GROUP BY target_day, theme)
SELECT target_day, CAST(row_number() OVER (PARTITION BY target_day ORDER BY n_articles DESC, kw_ord) AS BIGINT) AS theme_rank, theme, n_articles
FROM g QUALIFY theme_rank <= {SM.MAX_THEMES}"""


@register("week_themes", _theme_sql())
def q_week_themes(spark, sf):
    r = _recent(spark, sf)
    return SM.week_themes(_week_articles(r, r.select("day")), S_.interests)


# ---------------------------------------------------------------- streams
from ..streaming import streams as ST  # noqa: E402

_STREAM_DELAY_H = 1


STREAM_BATCHES = 4                               # micro-batches of the registered streams


def _landed(spark, df, name, order):
    """The rows as a stream in order over several micro-batches."""
    path = ST.land(df, name, order, STREAM_BATCHES)
    return ST.read_stream(spark, path, df, max_files=ST.files_per_batch(spark, path, STREAM_BATCHES))


def _closing_row(s):
    """A sighting far ahead, of a link that does not exist, lets the watermark pass the last day."""
    return s.agg(F.max("day").alias("day")).select(F.lit("<end>").alias("link"), F.date_add("day", 40).alias("day"))


def _seen_stream(spark, s, name, days, seeds=None):
    src = _landed(spark, s.unionByName(_closing_row(s)), name, "day")
    out = ST.run_available(ST.stream_seen(src, days, S_.seen_retention_days, seeds=seeds), name)
    return out.where(F.col("link") != "<end>")


@register("stream_seen", f"WITH RECURSIVE {_REPLAY_SQL} SELECT link, day FROM accepted")
def q_stream_seen(spark, sf):
    """Sightings over several micro-batches."""
    s = B.sightings(spark, sf)
    days = [r.day for r in s.select("day").distinct().collect()]     # one row per run: the calendar
    return _seen_stream(spark, s, "stream-seen", days)


@register("stream_seen_warm", f"""WITH RECURSIVE {_REPLAY_SQL}, span AS (SELECT min(day) AS a, max(day) AS z FROM sight)
SELECT link, day FROM accepted, span WHERE day > a + CAST((z - a) // 2 AS INTEGER)""")
def q_stream_seen_warm(spark, sf):
    """The first half of the history as batch runs that save their state, the rest as a stream that starts from it."""
    from ..operators import history as Hs
    from ..session import scratch_path
    from ..sources import state as STT
    s = B.sightings(spark, sf)
    days = sorted(r.day for r in s.select("day").distinct().collect())     # one row per run: the calendar
    cut = days[0] + (days[-1] - days[0]) // 2
    first = s.where(F.col("day") <= F.lit(cut))
    state = Hs.replay_seen(first, S_.seen_retention_days).groupBy("link").agg(F.max("day").alias("first_seen"))
    root = scratch_path(spark, "seen-warm")
    STT.write_seen(state, root, max(d for d in days if d <= cut).isoformat(), S_.seen_retention_days)
    seeds = ST.seed_stream(spark, STT.read_seen(spark, root))
    return _seen_stream(spark, s.where(F.col("day") > F.lit(cut)), "stream-seen-warm", days, seeds)


@register("stream_seen_approx", f"WITH {_SIGHT_SQL} SELECT DISTINCT link FROM sight")
def q_stream_seen_approx(spark, sf):
    """With the real retention a link can pass again once its state has expired; the links that passed."""
    src = _landed(spark, B.sightings(spark, sf), "sightings", "day")
    return ST.run_available(ST.stream_seen_approx(src, S_.seen_retention_days), "stream-seen-approx").distinct()


def _events(spark, sf):
    return B.table(spark, sf, "events").select("event_id", "ts", "event_type")


@register("stream_daily", f"""WITH wm AS (SELECT max(ts) - INTERVAL {_STREAM_DELAY_H} HOUR AS w FROM events)
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events, wm
GROUP BY CAST(ts AS DATE), event_type, wm.w
HAVING CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) <= wm.w""")
def q_stream_daily(spark, sf):
    e = _events(spark, sf)
    src = _landed(spark, e, "events", "ts")
    return ST.run_available(ST.stream_daily(src, "event_type", delay=f"{_STREAM_DELAY_H} hour"), "stream-daily")


@register("stream_weekly", f"""WITH wm AS (SELECT max(ts) - INTERVAL {_STREAM_DELAY_H} HOUR AS w FROM events),
ev AS (SELECT CAST(ts AS DATE) AS d, event_type FROM events),
starts AS (SELECT ev.d - CAST(k AS INTEGER) AS start_day, event_type FROM ev, range(0, 7) r(k))
SELECT start_day, event_type, count(*) AS n FROM starts, wm
WHERE CAST(start_day + INTERVAL 7 DAY AS TIMESTAMP) <= wm.w
GROUP BY start_day, event_type""")
def q_stream_weekly(spark, sf):
    e = _events(spark, sf)
    src = _landed(spark, e, "events", "ts")
    return ST.run_available(ST.stream_weekly(src, "event_type", delay=f"{_STREAM_DELAY_H} hour"), "stream-weekly")


@register("stream_feed_lookup", ORACLE["feed_lookup"])
def q_stream_feed_lookup(spark, sf):
    e = B.entries(spark, sf)
    src = ST.read_stream(spark, ST.land(e, "entries"), e)
    out = ST.run_available(ST.stream_feed_lookup(src, B.feeds(spark, sf)), "stream-feed-lookup")
    return out.select("entry_pos", "source", "feed_category")


@register("stream_publish", f"WITH {_RECENT_SQL} SELECT day, pos, title, summary, source FROM recent")
def q_stream_publish(spark, sf):
    from ..session import scratch_path
    r = _recent(spark, sf).checkpoint(eager=True)
    table = scratch_path(spark, "published-days")
    for run in ("1", "2"):                       # the second run replaces the first one's days
        src = _landed(spark, r, f"recent-{run}", "day")        # day by day: most days lie in one micro-batch
        ST.stream_publish(src, table, f"stream-publish-{run}", run)
    return ST.published(spark, table).select("day", "pos", "title", "summary", "source")


# ------------------------------------------------------------- feed landing
@register("feed_scan", f"""WITH {S.ENTRIES}
SELECT feed, entry_pos, title, link, summary FROM entries""")
def q_feed_scan(spark, sf):
    """Entries landed as XML feed documents and scanned back (empty elements read as missing)."""
    from ..session import scratch_path
    from ..sources import feeds as FS
    path = FS.write_landing(B.entries(spark, sf), scratch_path(spark, "feeds-xml"))
    return FS.feed_scan(spark, path)


@register("feed_scan_new", f"""WITH {S.ENTRIES}, span AS (SELECT min(run_date) AS a, max(run_date) AS z FROM entries)
SELECT CASE WHEN run_date <= a + CAST((z - a) // 2 AS INTEGER) THEN 0 ELSE 1 END AS scan, feed, entry_pos, title, link, summary FROM entries, span""")
def q_feed_scan_new(spark, sf):
    """Entries that land in two parts, each scanned once: the second scan reads the second part's files only."""
    from ..session import scratch_path
    from ..sources import feeds as FS
    e = B.entries(spark, sf).checkpoint(eager=True)
    first, last = e.agg(F.min("run_date"), F.max("run_date")).first()
    cut = F.lit(first + (last - first) // 2)
    landing, store = scratch_path(spark, "feeds-new"), scratch_path(spark, "feeds-scans")
    for part in (e.where(F.col("run_date") <= cut), e.where(F.col("run_date") > cut)):
        FS.write_landing(part, landing, "append")
        FS.scan_new(spark, landing, store)
    return FS.scanned_entries(spark, store)


# -------------------------------------------------------- whole daily runs
@register("daily_digest", f"""WITH RECURSIVE {S.candidates(S_)}, run_days AS (SELECT run_date AS run FROM entries),
rows AS (SELECT run_date AS run, feed_ord AS f, entry_pos AS pos, link, {S.norm_title('title')} AS t FROM arts2),
{S.title_edges('rows')}, {S.greedy('rows', S_.seen_retention_days)},
arts3 AS (SELECT arts2.* FROM arts2 JOIN accepted ON run_date = run AND entry_pos = accepted.pos),{S.positions('arts3')}
SELECT run_date, entry_pos, slug, title, category, CAST(cat_ord AS BIGINT) AS cat_ord, CAST(cat_rank AS BIGINT) AS cat_rank, pos,
       CAST(read_minutes AS BIGINT) AS read_minutes, CAST(interest AS BIGINT) AS interest, has_full_text FROM pos""")
def q_daily_digest(spark, sf):
    """Every run day with seen state across days and first-come de-duplication."""
    d = daily.daily_digest(spark, sf, S_)
    return d.select("run_date", "entry_pos", "slug", "title", "category", _long("cat_ord"), _long("cat_rank"),
                    _long("pos"), _long("read_minutes"), _long("interest"), "has_full_text")


@register("publish_rolling", f"""WITH {_RECENT_SQL},
days AS (SELECT DISTINCT day FROM recent),
hist AS (
  SELECT day, 'weekly' AS product, CASE WHEN isodow(day) - 1 = {S_.weekly_roundup_weekday} THEN strftime(day, '%Y-%m-%d') END AS payload FROM days
  UNION ALL SELECT day, 'quiz', CASE WHEN lag(day) OVER (ORDER BY day) IS NOT NULL THEN 'quiz of ' || strftime(lag(day) OVER (ORDER BY day), '%Y-%m-%d') END FROM days)
SELECT product, max(day) AS as_of,
       CASE WHEN product = 'weekly' THEN arg_max(payload, CASE WHEN payload IS NOT NULL THEN day END) ELSE arg_max(payload, day) END AS payload
FROM hist GROUP BY product""")
def q_publish_rolling(spark, sf):
    """Rolling product pages as of the last run: weekly keeps the newest non-empty roundup."""
    from ..operators import history as Hs
    from ..sources import publish as PB
    days = _recent(spark, sf).select("day").distinct()
    weekly = days.select("day", F.lit("weekly").alias("product"),
                         F.when(Hs.weekly_gate("day", S_), F.date_format("day", "yyyy-MM-dd")).alias("payload"))
    prev = Hs.previous_day(days)
    quiz = prev.select("day", F.lit("quiz").alias("product"),
                       F.when(F.col("prev_day").isNotNull(),
                              F.concat(F.lit("quiz of "), F.date_format("prev_day", "yyyy-MM-dd"))).alias("payload"))
    return PB.rolling_products(weekly.unionByName(quiz))


_LATE_DAYS, _LATE_EVERY = 3, 10


@register("late_rows", f"""WITH wm AS (SELECT max(ts) - INTERVAL {_STREAM_DELAY_H} HOUR AS w, CAST(min(ts) AS DATE) + {_LATE_DAYS} AS late FROM events),
b AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS batch_n,
             count(*) FILTER (WHERE event_id % {_LATE_EVERY} = 0) AS moved FROM events GROUP BY CAST(ts AS DATE), event_type),
s AS (SELECT b.*, CASE WHEN day < late THEN moved ELSE 0 END AS late_n,
             CASE WHEN CAST(day + INTERVAL 1 DAY AS TIMESTAMP) <= wm.w THEN 0 ELSE batch_n END AS open_n FROM b, wm)
SELECT day, event_type, batch_n, batch_n - late_n - open_n AS stream_n, late_n, open_n FROM s""")
def q_late_rows(spark, sf):
    """Every tenth event of the first days arrives after all others, when the watermark has closed its day: what the daily stream
    did not count for that, and what it has not counted yet, per day and type."""
    e = _events(spark, sf)
    first = e.select(F.to_date(F.min("ts"))).scalar()
    late = (F.to_date("ts") < F.date_add(first, _LATE_DAYS)) & (F.col("event_id") % _LATE_EVERY == 0)
    path = ST.land(e.where(~F.coalesce(late, F.lit(False))), "events", "ts", STREAM_BATCHES)
    per_batch = ST.files_per_batch(spark, path, STREAM_BATCHES)
    ST.land(e.where(late), "events-late", path=path)                     # newer files: read last
    src = ST.read_stream(spark, path, e, max_files=per_batch)
    out = ST.run_available(ST.stream_daily(src, "event_type", delay=f"{_STREAM_DELAY_H} hour"), "stream-late")
    return ST.late_rows(e, out, "event_type", f"{_STREAM_DELAY_H} HOUR")


# ------------------------------------------------------------ day gates
@register("digest_title", f"""WITH {S.ENTRIES}
SELECT DISTINCT run_date, CASE WHEN starts_with({S.q(S_.language)}, 'zh') THEN {S.q(T.TITLES['digest'][0])} ELSE {S.q(T.TITLES['digest'][1])} END
       || ' ' || strftime(run_date, '%Y-%m-%d') AS title FROM entries""")
def q_digest_title(spark, sf):
    days = B.entries(spark, sf).select("run_date").distinct()
    return days.select("run_date", T.digest_title("digest", F.lit(S_.language), "run_date").alias("title"))


@register("day_nonempty_gate", f"""WITH {S.candidates(S_, False)}, days AS (SELECT DISTINCT run_date FROM entries),
n AS (SELECT run_date, count(*) AS n_articles FROM arts2 GROUP BY run_date)
SELECT d.run_date, coalesce(n.n_articles, 0) AS n_articles, coalesce(n.n_articles, 0) > 0 AS publish
FROM days d LEFT JOIN n USING (run_date)""")
def q_day_nonempty_gate(spark, sf):
    """Per run day: publish only when the run has at least one article (else keep pages, prune only)."""
    days = B.entries(spark, sf).select("run_date").distinct()
    n = _all_articles(spark, sf).groupBy("run_date").agg(F.count(F.lit(1)).alias("n_articles"))
    g = days.join(n, "run_date", "left").withColumn("n_articles", F.coalesce("n_articles", F.lit(0)).cast("long"))
    return g.withColumn("publish", F.col("n_articles") > 0)


# ------------------------------------------- state and sinks, written and read back
def _seen_state(spark, sf):
    """Accepted links with their newest acceptance, and the last run day."""
    from ..operators import history as Hs
    s = B.sightings(spark, sf)
    acc = Hs.replay_seen(s, S_.seen_retention_days)
    state = acc.groupBy("link").agg(F.max("day").alias("first_seen"))
    return state, s.agg(F.max("day").cast("string")).first()[0]


@register("seen_write", f"""WITH RECURSIVE {_REPLAY_SQL}
SELECT link, max(day) AS first_seen FROM accepted GROUP BY link
HAVING max(day) >= (SELECT max(day) FROM sight) - {S_.seen_retention_days}""")
def q_seen_write(spark, sf):
    """The seen state after the last run: saved over an older version, read back."""
    from ..session import scratch_path
    from ..sources import state as STT
    state, last = _seen_state(spark, sf)
    root = scratch_path(spark, "seen-state")
    STT.write_seen(state.where(F.col("first_seen") < F.lit(last).cast("date")), root, last, S_.seen_retention_days)
    STT.write_seen(state, root, last, S_.seen_retention_days)
    return STT.read_seen(spark, root)


@register("seen_read", f"""WITH RECURSIVE {_REPLAY_SQL},
state AS (SELECT link, max(day) AS first_seen FROM accepted GROUP BY link HAVING max(day) >= (SELECT max(day) FROM sight) - {S_.seen_retention_days})
SELECT DISTINCT link FROM sight WHERE link NOT IN (SELECT link FROM state)""")
def q_seen_read(spark, sf):
    """Links that the run after the last one would not find in the state it loads."""
    fresh = B.sightings(spark, sf).select("link", F.lit("").alias("x")).distinct()
    return ingest.seen_anti(fresh, q_seen_write(spark, sf)).select("link")


_KEPT_DAYS = f"day >= (SELECT max(day) FROM recent) - {S_.recent_retention_days}"


@register("recent_write", f"""WITH {_RECENT_SQL}
SELECT day, pos, CASE WHEN day = (SELECT max(day) FROM recent) THEN upper(title) ELSE title END AS title, summary, source FROM recent WHERE {_KEPT_DAYS}""")
def q_recent_write(spark, sf):
    """The recent state: all days saved, then the last day again with other titles; retention at each save."""
    from ..session import scratch_path
    from ..sources import state as STT
    r = _recent(spark, sf).checkpoint(eager=True)
    last = r.agg(F.max("day").cast("string")).first()[0]
    root = scratch_path(spark, "recent-state")
    STT.write_recent(r, root, last, S_.recent_retention_days)
    again = r.where(F.col("day") == F.lit(last).cast("date")).withColumn("title", F.upper("title"))
    STT.write_recent(again, root, last, S_.recent_retention_days)
    return STT.read_recent(spark, root)


@register("recent_read", f"""WITH {_RECENT_SQL} SELECT day, count(*) AS n_articles FROM recent WHERE {_KEPT_DAYS} GROUP BY day""")
def q_recent_read(spark, sf):
    """Articles per day in the recent state as loaded by the next run."""
    return q_recent_write(spark, sf).groupBy("day").agg(F.count(F.lit(1)).alias("n_articles"))


@register("publish_day", f"WITH {_RECENT_SQL} SELECT day, pos, title, source FROM recent")
def q_publish_day(spark, sf):
    """Digest rows under their day; published twice, and once by a run without articles."""
    from ..session import scratch_path
    from ..sources import publish as PB
    r = _recent(spark, sf).select("day", "pos", "title", "source").checkpoint(eager=True)
    path = scratch_path(spark, "digest-days")
    PB.publish_day(r, path)
    PB.publish_day(r.where(F.col("day") == r.select(F.max("day")).scalar()), path)
    PB.publish_day(r.where(F.lit(False)), path)
    return spark.read.schema(r.schema).parquet(path).select("day", "pos", "title", "source")


@register("publish_articles", f"""WITH RECURSIVE {_DOC_PAGES_SQL}
SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, font, {_sfx('base')} AS file_name, CAST(substr(slug, 1, 10) AS DATE) AS day FROM man""")
def q_publish_articles(spark, sf):
    """The page manifest as published, read back with its day."""
    from ..session import scratch_path
    from ..sources import publish as PB
    path = scratch_path(spark, "article-pages")
    PB.publish_articles(_doc_pages(spark, sf).select("doc_id", "slug", "page_no", "font", "file_name"), path)
    t = spark.read.parquet(path)
    return t.select("doc_id", _long("page_no"), "font", "file_name", F.col("day").cast("date").alias("day"))


def _stub_model(prompt: str, cap: int) -> str:
    """A deterministic stand-in for a provider: the prompt's length, and a failure for some."""
    if len(prompt) % 7 == 0:
        raise RuntimeError("provider down")
    return '{"summary": "%d"}' % len(prompt)


@register("complete_batch", f"""SELECT doc_id, CASE WHEN length(text) % 7 > 0 THEN '{{"summary": "' || length(text) || '"}}' END AS reply,
  CASE WHEN length(text) % 7 = 0 THEN 'RuntimeError: provider down' END AS error,
  CASE WHEN length(text) % 7 = 0 THEN CAST({C.RETRY_ATTEMPTS} AS BIGINT) ELSE 1 END AS attempts FROM documents""")
def q_complete_batch(spark, sf):
    """Every document as a prompt through a deterministic model function."""
    prompts = B.table(spark, sf, "documents").select("doc_id", F.col("text").alias("prompt"))
    out = SM.complete_batch(prompts, "doc_id", _stub_model, max_parallel=8, base_delay_s=0)
    return out.select("doc_id", "reply", "error", _long("attempts"))


@register("reply_store", f"""SELECT doc_id, CASE WHEN length(text) % 7 > 0 THEN '{{"summary": "' || length(text) || '"}}' END AS reply,
  CASE WHEN length(text) % 7 = 0 THEN 'RuntimeError: provider down' END AS error,
  CASE WHEN length(text) % 7 = 0 THEN 2 ELSE 1 END AS n_stored FROM documents""")
def q_reply_store(spark, sf):
    """Every document as a prompt, in two runs over one reply store: the second run sends only what failed."""
    from ..operators.reply_store import ReplyStore, reply_key
    from ..session import scratch_path
    prompts = B.table(spark, sf, "documents").select("doc_id", F.col("text").alias("prompt"))
    store = ReplyStore(spark, scratch_path(spark, "replies"))
    for run in ("1", "2"):
        out = store.complete(prompts, _stub_model, "summary", run, max_parallel=8, calls_per_task=100_000, attempts=1, base_delay_s=0)
    stored = store.read("summary").groupBy("reply_key").agg(F.count(F.lit(1)).alias("n_stored"))
    return (out.withColumn("reply_key", reply_key("summary")).join(stored, "reply_key")
            .select("doc_id", "reply", "error", _long("n_stored")))


# ------------------------------------------------ runs with the model stage
from . import run as RN  # noqa: E402


def _run_model(prompt: str, cap: int) -> str:
    """A deterministic model: some calls fail, some replies are cut off, the others hold every product's keys."""
    n = len(prompt)
    if n % 7 == 0:
        raise RuntimeError("provider down")
    if n % 7 == 1:
        return '{"summary": "about'
    return ('{"summary": "about %d", "qa": [{"question": "q%d", "answer": "a"}], "brief": "brief %d", "quiz": [{"question": "q%d", "answer": "a"}], '
            '"background": "b%d", "points": ["p"], "implications": "", "glossary": [], "intro": "i%d", "themes": []}' % ((n,) * 6))


_ASKED_SQL = f"""{S.candidates(S_, by_link=True)}, run_days AS (SELECT run_date AS run FROM entries),
asked AS (SELECT *, length({_ARTICLE_PROMPT_SQL}) AS n_prompt FROM arts2),
rows AS (SELECT run_date AS run, feed_ord AS f, entry_pos AS pos, link, {S.norm_title('title')} AS t, n_prompt % 7 < 2 AS fails FROM asked),
{S.title_edges('rows')}, {S.greedy('rows', S_.seen_retention_days, 'q.fails')},
arts3 AS (SELECT * REPLACE ({S.interest('title', 'reply', S_.interests)} AS interest)
          FROM (SELECT asked.*, 'about ' || n_prompt AS reply FROM asked JOIN accepted ON run_date = accepted.run AND entry_pos = accepted.pos)),{S.positions('arts3')},
digest AS (SELECT *, read_minutes + 3 * interest + CASE WHEN long_form THEN 5 ELSE 0 END AS score FROM pos)"""


def _model_parts(spark, sf):
    from ..operators.reply_store import ReplyStore
    from ..session import scratch_path
    root = scratch_path(spark, "run")
    return root, ReplyStore(spark, f"{root}/replies"), RN.Model(_run_model, max_parallel=8, calls_per_task=1000, attempts=1, base_delay_s=0)


@register("model_digest", f"""WITH RECURSIVE {_ASKED_SQL}
SELECT run_date, entry_pos, slug, title, category, CAST(cat_ord AS BIGINT) AS cat_ord, CAST(cat_rank AS BIGINT) AS cat_rank, pos, reply AS summary,
       'q' || n_prompt AS question, CAST(read_minutes AS BIGINT) AS read_minutes, CAST(interest AS BIGINT) AS interest, has_full_text FROM digest""")
def q_model_digest(spark, sf):
    """Every run day with bodies by link and the model inside de-duplication: failed replies block nobody."""
    _, store, model = _model_parts(spark, sf)
    d = RN.backfill(B.entries(spark, sf), B.link_bodies(spark, sf), store, model, S_, "1")
    return d.select("run_date", "entry_pos", "slug", "title", "category", _long("cat_ord"), _long("cat_rank"), _long("pos"), "summary",
                    F.col("qa")[0]["question"].alias("question"), _long("read_minutes"), _long("interest"), "has_full_text")


def _last_run(spark, sf):
    """State of all runs before the last one, then the last run as a job; its folder, day and settings (the roundup is due on that day)."""
    from ..sources import state as STT
    root, store, model = _model_parts(spark, sf)
    entries, bodies = B.entries(spark, sf), B.link_bodies(spark, sf).checkpoint(eager=True)
    last = entries.agg(F.max("run_date")).first()[0]
    before = entries.where(F.col("run_date") < F.lit(last))
    done = RN.backfill(before, bodies, store, model, S_, "0").checkpoint(eager=True)
    if not done.isEmpty():
        prev = before.agg(F.max("run_date")).first()[0].isoformat()
        STT.write_seen(done.groupBy("link").agg(F.max("run_date").alias("first_seen")), f"{root}/seen", prev, S_.seen_retention_days)
        STT.write_recent(done.select(F.col("run_date").alias("day"), "pos", "title", "summary", F.col("feed").alias("source")),
                         f"{root}/recent", prev, S_.recent_retention_days)
    settings = S_.with_(weekly_roundup_weekday=last.weekday())
    RN.run_day(spark, root, last, entries.where(F.col("run_date") == F.lit(last)).drop("run_date", "full_text"), bodies, model, settings)
    return root, last, settings


_RECENT_RUNS_SQL = f"""{_ASKED_SQL}, last AS (SELECT max(run) AS d FROM run_days),
recent AS (SELECT run_date AS day, pos, title, reply AS summary, feed AS source FROM digest, last WHERE run_date >= d - {S_.recent_retention_days}),
today AS (SELECT recent.* FROM recent, last WHERE day = d),
brief AS (SELECT length({S.q(PR.BRIEF_HEAD.format(lang=S_.language))} || string_agg(CAST(pos AS VARCHAR) || '. [' || source || '] ' || title || chr(10) || summary,
                 chr(10) || chr(10) ORDER BY pos)) AS n FROM today),
prev AS (SELECT max(day) AS day FROM recent, last WHERE day < d),
quiz AS (SELECT any_value(day) AS source_day, length({S.q(PR.QUIZ_HEAD.format(n=S_.quiz_questions, lang=S_.language))} ||
                string_agg(CAST(pos AS VARCHAR) || '. ' || title || chr(10) || summary, chr(10) || chr(10) ORDER BY pos)) AS n FROM recent JOIN prev USING (day)),
week AS (SELECT recent.*, row_number() OVER (ORDER BY day, pos) AS k FROM recent, last WHERE day >= d - 6),
weekly AS (SELECT length({S.q(PR.WEEKLY_HEAD.format(lang=S_.language))} || string_agg('- (' || strftime(day, '%Y-%m-%d') || ', ' || source || ') ' || title || ': ' || summary,
                  chr(10) ORDER BY k)) AS n FROM week WHERE k <= {C.WEEKLY_MAX_ARTICLES}),
pick AS (SELECT digest.* FROM digest, last WHERE run_date = d ORDER BY has_full_text DESC, score DESC, pos LIMIT 1),
deep AS (SELECT slug, title, length({S.q(PR.DEEP_HEAD.format(lang=S_.language))} || {_TITLE_BODY_SQL}) AS n FROM pick)"""


@register("run_day", f"""WITH RECURSIVE {_RECENT_RUNS_SQL}
SELECT run_date AS day, pos, slug, title, link, feed AS source, reply AS summary, CASE WHEN n % 7 < 2 THEN '' ELSE 'brief ' || n END AS brief
FROM digest, last, brief WHERE run_date = d""")
def q_run_day(spark, sf):
    """The last run day as a job on the state of all runs before it: its published digest."""
    root, last, settings = _last_run(spark, sf)
    d = RN.published_days(spark, root, last, settings)
    return d.select(F.col("day").cast("date").alias("day"), _long("pos"), "slug", "title", "link", "source", "summary", "brief")


@register("run_products", f"""WITH RECURSIVE {_RECENT_RUNS_SQL}
SELECT 'quiz' AS product, d AS as_of, CASE WHEN n % 7 >= 2 THEN source_day END AS source_day, CASE WHEN n % 7 >= 2 THEN 'q' || n || '/a' END AS payload
FROM last LEFT JOIN quiz ON true
UNION ALL SELECT 'deep', d, NULL, CASE WHEN n % 7 >= 2 THEN slug || '/' || title || '/b' || n || '/p' END FROM last LEFT JOIN deep ON true
UNION ALL SELECT 'weekly', d, NULL, strftime(d - 6, '%Y-%m-%d') || ' – ' || strftime(d, '%Y-%m-%d') || '/i' || n FROM last, weekly WHERE n % 7 >= 2""")
def q_run_products(spark, sf):
    """Quiz, deep read and roundup as the last run leaves them, with their payload."""
    from ..sources import products as PD
    root, _, _ = _last_run(spark, sf)
    quiz = F.array_join(F.transform("quiz", lambda x: F.concat(x["question"], F.lit("/"), x["answer"])), ";")
    deep = F.concat_ws("/", "deep.slug", "deep.title", "deep.background", F.array_join("deep.points", ";"))
    weekly = F.concat_ws("/", "weekly.label", "weekly.intro")
    payload = F.when(F.col("quiz").isNotNull(), quiz).when(F.col("deep").isNotNull(), deep).when(F.col("weekly").isNotNull(), weekly)
    return PD.read_products(spark, f"{root}/products").select("product", "as_of", "source_day", payload.alias("payload"))
