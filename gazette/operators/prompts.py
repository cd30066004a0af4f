"""Prompt tables for the reply stage: one prompt text per article, day or week.

The block layouts (numbering, ``[source] title`` then summary, dated weekly
lines) follow the reference; the instruction wording is our own and asks for
the same JSON keys the cleaners read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from .history import previous_day, week_articles

ARTICLE_HEAD = ("Summarise the article below. Answer with one JSON object only, keys: "
                '"summary" (2-4 sentences in {lang}), {secondary}"qa" (3 objects with "question" and "answer" in {lang}). ')
NEWS_ANGLE = "Open with what happened, then say who is affected."
ESSAY_ANGLE = "This is a longer piece: state its thesis, the reasons given and the conclusion."
SECONDARY = '"summary_secondary" (the same summary in {lang2}), '
BRIEF_HEAD = ('Write a 2-4 sentence editor\'s brief in {lang} connecting today\'s stories. Answer with one JSON '
              'object only, key "brief".\n\nArticles:\n')
QUIZ_HEAD = ('Write a recall quiz of {n} questions (fewer if the material is thin) in {lang} on the articles '
             'below. Answer with one JSON object only, key "quiz": a list of objects with "question" and '
             '"answer".\n\nArticles:\n')
WEEKLY_HEAD = ('Group the past week\'s articles into 3-5 themes and write a roundup in {lang}. Answer with one '
               'JSON object only, keys "intro" and "themes" (objects with "title" and "body").\n\nArticles:\n')
DEEP_HEAD = ('Write a deep-read companion in {lang} for the article below. Answer with one JSON object only, keys '
             '"background", "points" (3-5 strings), "implications", "glossary" (2-4 objects with "term" and '
             '"definition").')


def _lit(s: str) -> Column:
    return F.lit(s)


def article_prompt(articles: DataFrame, settings: C.Settings) -> DataFrame:
    """``prompt`` per article: instructions (news or essay angle) + title + clipped body."""
    sec = SECONDARY.format(lang2=settings.secondary_language) if settings.secondary_language else ""
    head = ARTICLE_HEAD.format(lang=settings.language, secondary=sec)
    budget = T.source_budget(F.col("long_form"), settings)
    angle = F.when(F.col("long_form"), _lit(ESSAY_ANGLE)).otherwise(_lit(NEWS_ANGLE))
    body = T.clip_source(F.col("text"), budget)
    return articles.withColumn("prompt", F.concat(_lit(head), angle, _lit("\n\nTitle: "), F.col("title"),
                                                  _lit("\n\nArticle:\n"), body))


def _gated(prompts: DataFrame, on: bool) -> DataFrame:
    """A product that is switched off has no prompts."""
    return prompts if on else prompts.where(F.lit(False))


def deep_prompt(picks: DataFrame, settings: C.Settings) -> DataFrame:
    picks = _gated(picks, settings.deep_read)
    budget = T.source_budget(F.col("long_form"), settings)
    return picks.withColumn("prompt", F.concat(_lit(DEEP_HEAD.format(lang=settings.language)), _lit("\n\nTitle: "),
                                               F.col("title"), _lit("\n\nArticle:\n"),
                                               T.clip_source(F.col("text"), budget)))


def _day_text(recent: DataFrame, block) -> DataFrame:
    """One text per day: blocks in position order, joined by blank lines.  The input is a
    run's articles (after the per-feed limit), so a day holds at most feeds x limit rows."""
    g = recent.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("pos", block.alias("b")))).alias("_b"))
    return g.select("day", F.array_join(F.transform("_b", lambda x: x["b"]), "\n\n").alias("blocks"),
                    F.size("_b").alias("n_articles"))


def brief_prompt(recent: DataFrame, settings: C.Settings) -> DataFrame:
    block = F.concat(F.col("pos").cast("string"), _lit(". ["), F.col("source"), _lit("] "), F.col("title"),
                     _lit("\n"), F.col("summary"))
    d = _gated(_day_text(recent, block), settings.editor_brief)
    return d.select("day", "n_articles",
                    F.concat(_lit(BRIEF_HEAD.format(lang=settings.language)), F.col("blocks")).alias("prompt"))


def quiz_prompt(recent: DataFrame, settings: C.Settings) -> DataFrame:
    """Each day's quiz is written from the previous non-empty day's articles; none without questions to ask."""
    block = F.concat(F.col("pos").cast("string"), _lit(". "), F.col("title"), _lit("\n"), F.col("summary"))
    d = _day_text(recent, block).withColumnRenamed("day", "source_day")
    prev = previous_day(recent.select("day")).where(F.col("prev_day").isNotNull())
    j = _gated(prev.join(d, prev["prev_day"] == d["source_day"]), (settings.quiz_questions or 0) > 0)
    head = QUIZ_HEAD.format(n=settings.quiz_questions, lang=settings.language)
    return j.select("day", "source_day", F.concat(_lit(head), F.col("blocks")).alias("prompt"))


def weekly_prompt(recent: DataFrame, targets: DataFrame, settings: C.Settings) -> DataFrame:
    """Per target day, dated lines of the first 60 articles of the 7 days ending there."""
    w = week_articles(recent, targets)
    line = F.concat(_lit("- ("), F.date_format("day", "yyyy-MM-dd"), _lit(", "), F.col("source"), _lit(") "),
                    F.col("title"), _lit(": "), F.col("summary"))
    g = w.groupBy("target_day").agg(F.array_sort(F.collect_list(F.struct("week_pos", line.alias("l")))).alias("_l"))
    head = WEEKLY_HEAD.format(lang=settings.language)
    return g.select("target_day", F.size("_l").alias("n_articles"),
                    F.concat(_lit(head), F.array_join(F.transform("_l", lambda x: x["l"]), "\n")).alias("prompt"))
