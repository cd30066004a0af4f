"""State over days: retention, previous day, trailing week, seen-state replay and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from .ordering import ranked, top_n


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def weekly_gate(day, settings: C.Settings) -> Column:
    """Roundup runs only on the configured weekday (0 = Monday ... 6 = Sunday)."""
    return F.lit(bool(settings.weekly_roundup)) & (F.weekday(_c(day)) == settings.weekly_roundup_weekday)


def keep_after_cutoff(d, run_date, days: int, keep_unparsable: bool) -> Column:
    """Retention rule: keep when ``d >= run_date - days``; ``days <= 0`` keeps everything."""
    if days is None or days <= 0:
        return F.lit(True)
    recent = _c(d) >= F.date_sub(_c(run_date), days)
    return F.when(_c(d).isNull(), F.lit(keep_unparsable)).otherwise(recent)


def file_date(file_name, kind) -> Column:
    """Date encoded in a published file name: article pages use the first 10 characters,
    archive pages the whole stem without ``-sans``."""
    name = _c(file_name)
    stem = F.regexp_replace(F.regexp_replace(name, r"\.html$", ""), r"-sans$", "")
    return F.when(_c(kind) == "article", T.date_parse(F.substring(name, 1, 10))).otherwise(T.date_parse(stem))


def retention_dated_files(files: DataFrame, run_date: str, days: int) -> DataFrame:
    """Published files that survive pruning (unparsable names and index pages are kept)."""
    is_index = F.col("file_name").isin("index.html", "index-sans.html") & (F.col("kind") == "archive")
    d = F.when(is_index | ~F.col("file_name").endswith(".html"), F.lit(None).cast("date")).otherwise(
        file_date("file_name", "kind"))
    return (files.withColumn("file_date", d)
            .where(keep_after_cutoff("file_date", F.lit(run_date).cast("date"), days, True)))


def retention_recent(recent_keys: DataFrame, key: str, run_date: str, days: int) -> DataFrame:
    """Stored days that survive pruning: unparsable day keys are dropped."""
    d = T.date_parse(F.col(key))
    out = recent_keys.withColumn("day", d)
    if days is None or days <= 0:
        return out
    return out.where(F.col("day").isNotNull() & keep_after_cutoff("day", F.lit(run_date).cast("date"), days, False))


def retention_seen(seen: DataFrame, run_date, days: int) -> DataFrame:
    """Seen links that survive pruning; ``first_seen`` is a typed date, so an unparsable one
    cannot reach this point (the reference fails the run)."""
    return seen.where(keep_after_cutoff("first_seen", run_date, days, False))


def previous_day(days: DataFrame, day: str = "day") -> DataFrame:
    """For each non-empty day, the latest non-empty day strictly before it.
    Input is one row per distinct day, so the un-partitioned window holds one row per calendar day."""
    w = Window.orderBy(day)
    return days.select(day).distinct().select(day, F.lag(day).over(w).alias("prev_day"))


def archive_prev(days: DataFrame, day: str = "day") -> DataFrame:
    """Newest archived day other than this one (not "earlier than"): two scalar subqueries."""
    d = days.select(day).distinct()
    m1 = d.select(F.max(day)).scalar()
    m2 = d.where(F.col(day) < m1).select(F.max(day)).scalar()
    return d.select(day, F.when(F.col(day) == m1, m2).otherwise(m1).alias("prev_day"))


def week_join(recent: DataFrame, targets: DataFrame, day: str = "day", span: int = 7) -> DataFrame:
    """Rows of the ``span`` days ending on each target day: replicate every row onto the target
    days it belongs to (``sequence``) and equi-join, instead of a range join."""
    exploded = recent.withColumn("target_day", F.explode(F.sequence(F.col(day), F.date_add(F.col(day), span - 1))))
    t = targets.select(F.col(day).alias("target_day")).distinct()
    return exploded.join(t, "target_day", "left_semi")


def week_articles(recent: DataFrame, targets: DataFrame, cap: int = C.WEEKLY_MAX_ARTICLES) -> DataFrame:
    """Trailing week per target day in (day, position) order, first ``cap`` rows (the oldest)."""
    w = week_join(recent, targets)
    return top_n(w, ["target_day"], [F.col("day").asc(), F.col("pos").asc()], cap, "week_pos")


def week_label(target_day, n_articles) -> Column:
    label = F.concat(F.date_format(F.date_sub(_c(target_day), 6), "yyyy-MM-dd"), F.lit(" – "),
                     F.date_format(_c(target_day), "yyyy-MM-dd"))
    return F.when(_c(n_articles) > 0, label).otherwise(F.lit(""))


def replay_seen(sightings: DataFrame, retention_days: int = 14) -> DataFrame:
    """Accepted (link, day) over a history of daily runs.

    A link accepted on day ``s`` stays in the state saved at the end of every run ``R``
    with ``s >= R - retention``; a sighting on day ``D`` is accepted when the state loaded
    (saved by the previous run) no longer holds the last acceptance.  A repeat does not
    refresh the date.  Per link the fold runs over its distinct sighting days, which the
    calendar bounds, after a map-side distinct on (link, day).
    """
    s = sightings.select("link", "day").distinct()
    runs = s.select("day").distinct()
    runs = runs.select("day", F.lag("day").over(Window.orderBy("day")).alias("prev_run"))
    x = s.join(F.broadcast(runs), "day")   # one row per calendar day
    per = x.groupBy("link").agg(F.array_sort(F.collect_list(F.struct("day", "prev_run"))).alias("h"))
    init = F.struct(F.lit(None).cast("date").alias("last"), F.array().cast("array<date>").alias("acc"))

    def step(st, e):
        if retention_days is None or retention_days <= 0:
            free = st["last"].isNull()
        else:
            free = st["last"].isNull() | (st["last"] < F.date_sub(e["prev_run"], retention_days))
        return F.when(free, F.struct(e["day"].alias("last"), F.array_append(st["acc"], e["day"]).alias("acc"))
                      ).otherwise(st)

    acc = F.aggregate("h", init, step)["acc"]
    return per.select("link", F.explode(acc).alias("day"))


def seen_upsert(state: DataFrame, accepted: DataFrame) -> DataFrame:
    """State plus newly accepted links; a link keeps its newest acceptance date."""
    u = state.select("link", "first_seen").unionByName(accepted.select("link", "first_seen"))
    return u.groupBy("link").agg(F.max("first_seen").alias("first_seen"))


def recent_upsert(recent: DataFrame, today: DataFrame, day: str = "day") -> DataFrame:
    """Replace the days present in ``today``; keep every other day."""
    days = today.select(day).distinct()
    return recent.join(days, day, "left_anti").unionByName(today.select(*recent.columns))


def archive_index(files: DataFrame) -> DataFrame:
    """Distinct archived day names, newest first (font variants and the index excluded)."""
    names = files.where((F.col("kind") == "archive") & F.col("file_name").endswith(".html")
                        & ~F.col("file_name").endswith("-sans.html") & (F.col("file_name") != "index.html"))
    stems = names.select(F.regexp_replace("file_name", r"\.html$", "").alias("day_key")).distinct()
    return ranked(stems, [], [F.col("day_key").desc()], "position")
