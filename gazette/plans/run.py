"""Whole daily runs with the model stage inside de-duplication.

``accepted_articles`` decides any number of run days at once: an entry goes to the model when nothing blocks it any more, and blocks
others only when its reply is good (a failed call or an unusable reply leaves neither its title nor its link behind).
``run_day`` is one run as a job: state, entries, bodies by link, de-duplication with the model, ranking, day products, publishing, retention,
state.  Layout under ``root``: ``seen/``, ``recent/`` (versioned state), ``days/``, ``pages/`` (day partitions), ``products/``
(versioned), ``replies/`` (the reply store).

A run's writes end with the state, and every write before it can be repeated: a day's partitions are replaced, replies are found in the store.
So a run that broke off is simply started again, and a second run on a day without new articles publishes nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import replies as R
from ..functions import text as T
from ..operators import dedup as D
from ..operators import history as Hs
from ..operators import ingest, paging, prompts as PR, rank
from ..operators.reply_store import Complete, ReplyStore
from ..sources import products as PD
from ..sources import publish as PB
from ..sources import state as STT


@dataclass(frozen=True)
class Model:
    """The user's model function and how it may be called."""
    complete: Complete
    max_parallel: int = 4
    calls_per_task: int = 16
    attempts: int = C.RETRY_ATTEMPTS
    base_delay_s: float = C.RETRY_BASE_DELAY_S

    def ask(self, store: ReplyStore, prompts: DataFrame, kind: str, run: str) -> DataFrame:
        return store.complete(prompts, self.complete, kind, run, self.max_parallel, self.calls_per_task, self.attempts, self.base_delay_s)


def with_bodies(entries: DataFrame, bodies: DataFrame) -> DataFrame:
    """Article bodies by link (one per link: the smallest, when a page was landed twice); an entry without a link has none."""
    b = (bodies.where(F.col("link") != "").groupBy("link").agg(F.min("body").alias("full_text")))
    return entries.drop("full_text").join(b, "link", "left")


def accepted_articles(entries: DataFrame, store: ReplyStore, model: Model, settings: C.Settings, run: str,
                      holds: DataFrame | None = None) -> DataFrame:
    """The articles of each run (``entries``: limited, with text) with ``summary``, ``summary_secondary``, ``qa`` of their replies.

    ``holds`` as in ``dedup.greedy_rounds``; ``run`` names the attempt in the store.
    """
    e = (entries.withColumn("o", F.struct("feed_ord", "entry_pos")).withColumn("link", F.coalesce("link", F.lit("")))
         .withColumn("long_form", T.is_long_form("category", settings.long_form_categories)))
    asked = PR.article_prompt(e, settings).drop("summary").checkpoint(eager=True)
    nodes = asked.select(F.col("run_date").alias("run"), "o", "link", F.coalesce(T.normalize_title("title"), F.lit("")).alias("t"))
    prompts = asked.select(F.col("run_date").alias("run"), "o", "prompt")

    def judge(new: DataFrame) -> DataFrame:
        replies = model.ask(store, new.join(prompts, ["run", "o"]).select("run", "o", "prompt"), "summary", run)
        return R.summary_reply(R.with_parsed(replies)).where(~F.col("reply_ok")).select("run", "o")
    decided = D.greedy_rounds(nodes, D.similar_titles(nodes, "run", "t"), holds, judge)
    taken = decided.where("accepted").select(F.col("run").alias("run_date"), "o")
    # every accepted prompt has its reply in the store: nothing is called here
    with_reply = model.ask(store, asked.join(taken, ["run_date", "o"]), "summary", run)
    return R.summary_reply(R.with_parsed(with_reply)).drop("v", "reply", "reply_ok", "error", "attempts", "prompt", "o")


def ranked_articles(articles: DataFrame, settings: C.Settings) -> DataFrame:
    """Scores from title and reply summary, category order, rank and day position."""
    a = (articles.withColumn("read_minutes", T.reading_minutes("text"))
         .withColumn("interest", T.interest_score("title", "summary", settings.interests))
         .withColumn("deep_score", F.col("read_minutes") + 3 * F.col("interest") + F.when(F.col("long_form"), 5).otherwise(0))
         .withColumn("slug", T.article_slug("run_date", "link", "title")))
    return rank.with_positions(a)


def run_days(entries: DataFrame, settings: C.Settings) -> DataFrame:
    """``holds`` of a history of runs: each run starts from the state that the run before it saved."""
    prev = F.lag("run").over(Window.orderBy("run"))             # one row per run day: the calendar
    keep = settings.seen_retention_days
    since = F.date_sub(prev, keep) if keep and keep > 0 else F.lit(None).cast("date")
    return entries.select(F.col("run_date").alias("run")).distinct().select("run", since.alias("since"))


def backfill(entries: DataFrame, bodies: DataFrame, store: ReplyStore, model: Model, settings: C.Settings, run: str) -> DataFrame:
    """Every run day of ``entries`` at once, as if the days had been run one after the other."""
    top = ingest.drop_no_text(ingest.body_or_fallback(with_bodies(ingest.feed_top_n(entries, settings.max_articles_per_feed), bodies)))
    return ranked_articles(accepted_articles(top, store, model, settings, run, run_days(entries, settings)), settings)


def _reply(model: Model, store: ReplyStore, prompts: DataFrame, kind: str, run: str) -> DataFrame:
    return R.with_parsed(model.ask(store, prompts, kind, run))


def run_day(spark: SparkSession, root: str, run_date: dt.date, entries: DataFrame, bodies: DataFrame, model: Model,
            settings: C.Settings) -> int:
    """One run; returns the number of new articles (0: a quiet run, which prunes the state and publishes nothing).

    ``entries``: feed_ord, feed, entry_pos, title, link, summary, category of the feeds as fetched now; ``bodies``: link, body.
    """
    day, name = F.lit(run_date).cast("date"), run_date.isoformat()
    root = root.rstrip("/")
    store = ReplyStore(spark, f"{root}/replies")
    seen, recent = STT.read_seen(spark, f"{root}/seen"), STT.read_recent(spark, f"{root}/recent")
    top = ingest.feed_top_n(entries.withColumn("run_date", day), settings.max_articles_per_feed)
    fresh = ingest.seen_anti(top, seen)
    with_text = ingest.drop_no_text(ingest.body_or_fallback(with_bodies(fresh, bodies)))
    articles = ranked_articles(accepted_articles(with_text, store, model, settings, name), settings).checkpoint(eager=True)
    new = articles.count()
    if new:
        today = articles.select(day.alias("day"), "pos", "title", "summary", F.col("feed").alias("source")).checkpoint(eager=True)
        with_today = Hs.recent_upsert(recent, today).checkpoint(eager=True)
        one_day = F.col("day") == day

        brief = _reply(model, store, PR.brief_prompt(today, settings), "brief", name).select("day", R.brief_text("v").alias("brief"))
        digest = articles.select(day.alias("day"), "pos", "slug", "category", "cat_ord", "cat_rank", "title", "link", F.col("feed").alias("source"),
                                 "summary", "summary_secondary", "qa", "long_form", "has_full_text", "read_minutes", "interest")
        digest = digest.join(F.broadcast(brief), "day", "left").withColumn("brief", F.coalesce("brief", F.lit("")))   # one row

        pick = rank.deep_read_pick(articles)
        deep = R.deep_reply(_reply(model, store, PR.deep_prompt(pick, settings).select("slug", "title", "prompt"), "deep", name))
        deep = deep.where("keep").select("slug", "title", "background", "points", "implications", "glossary")

        # the previous non-empty day is asked about; today is in ``with_today`` already
        earlier = with_today.where(F.col("day") < day).select(F.max("day")).scalar()
        asked = PR.quiz_prompt(with_today.where(one_day | (F.col("day") == earlier)), settings).where(one_day)
        quiz = R.quiz_reply(_reply(model, store, asked, "quiz", name), settings.quiz_questions or 0).where("reply_ok").select("source_day", "quiz")

        target = today.select("day").distinct().where(Hs.weekly_gate("day", settings))
        week = PR.weekly_prompt(with_today, target, settings)
        weekly = R.weekly_reply(_reply(model, store, week, "weekly", name)).where("keep").select(
            Hs.week_label("target_day", "n_articles").alias("label"), "intro", "themes")

        PB.publish_day(digest, f"{root}/days")
        pages = paging.page_manifest(articles, settings)
        PB.publish_articles(pages.select("slug", "page_no", "page_total", "font", "file_name", "prev_file", "next_file",
                                         "page_paragraphs", "minutes_shown", F.when(F.col("show_qa"), F.col("qa")).alias("qa")), f"{root}/pages")
        PD.write_products(spark, f"{root}/products", run_date, quiz, deep, weekly)
        seen = Hs.seen_upsert(seen, articles.select("link", day.alias("first_seen")))
        STT.write_recent(today, f"{root}/recent", name, settings.recent_retention_days)
    else:
        STT.write_recent(recent, f"{root}/recent", name, settings.recent_retention_days)
    STT.write_seen(seen, f"{root}/seen", name, settings.seen_retention_days)
    return new


def published_days(spark: SparkSession, root: str, run_date: dt.date, settings: C.Settings) -> DataFrame:
    """The digests that the archive retention keeps."""
    days = spark.read.parquet(f"{root.rstrip('/')}/days")
    return days.where(Hs.keep_after_cutoff("day", F.lit(run_date).cast("date"), settings.archive_retention_days, True))
