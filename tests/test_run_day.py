"""Daily runs as jobs, and their backfill, against a sequential loop over many days with a failing model."""

import datetime as dt
import difflib
import json
import os
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gazette import config as C
from gazette.operators import dedup as D
from gazette.operators.reply_store import ReplyStore
from gazette.plans import run as RN
from gazette.session import scratch_path
from gazette.sources import products as PD
from gazette.sources import state as STT

# the model functions below run in the workers, which cannot import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY = dt.date(2026, 3, 1)                                       # a Sunday
SETTINGS = C.Settings(language="en", max_articles_per_feed=6, interests=("alpha", "beta"), seen_retention_days=2, recent_retention_days=14,
                      weekly_roundup_weekday=6, archive_retention_days=60)
TITLES = ["Storm hits the coast", "Storm hits the coasts", "Storm hit the coast", "Budget vote today", "Budget vote delayed", "Quiet day", ""]
COLS = "feed_ord int, feed string, entry_pos long, title string, link string, summary string, category string"


def feeds_of(k):
    """Entries of day k: repeated links, similar titles, empty texts, a link without a page."""
    rows = []
    for feed in range(3):
        for pos in range(7):
            n = (k * 5 + feed * 3 + pos * 2) % 11
            link = "" if (k + feed + pos) % 17 == 0 else f"https://x/{n}"
            rows.append((feed, f"f{feed}", pos, TITLES[(n + pos) % len(TITLES)], link, "" if n == 4 else f"teaser {n} alpha",
                         "Tech" if feed != 1 else "Long Reads"))
    return rows


BODIES = [(f"https://x/{n}", f"Body {n} " + "word beta " * 60) for n in range(11) if n not in (3, 4)] + [("https://x/5", "short")]


def fails(prompt):
    return sum(map(ord, prompt)) % 4 == 0


def model(log):
    def complete(prompt, cap):
        with open(log, "a") as f:
            f.write(json.dumps([prompt, cap]) + "\n")
        if cap == 800 and fails(prompt):
            if len(prompt) % 2:
                raise RuntimeError("down")
            return "no json here"
        n = sum(map(ord, prompt)) % 1000
        return "```json\n" + json.dumps({
            "summary": f"sum {n}", "qa": [{"question": f"q{n}", "answer": "a"}] * 5, "brief": f"brief {n}", "quiz": [{"question": "", "answer": ""}, {"question": f"z{n}", "answer": "a"}],
            "background": f"b{n}", "points": ["", "p"], "implications": "", "glossary": [{"term": "t"}], "intro": f"i{n}", "themes": []}) + "\n```"
    return complete


def article_calls(log):
    rows = [json.loads(x) for x in open(log)] if os.path.exists(log) else []
    return sorted(p for p, cap in rows if cap == 800)


def norm(t):
    return " ".join(re.sub(r"[^\w\s]", "", t.lower()).split())


def sequential(days, by_title):
    """What the runs must do, said again in plain Python: accepted (day, feed, pos), and the texts that were sent to the model."""
    bodies = {}
    for link, body in BODIES:
        bodies[link] = min(body, bodies.get(link, body))
    seen, accepted, sent = {}, [], []
    for k in days:
        day, titles = DAY + dt.timedelta(days=k), []
        rows = feeds_of(k)
        for feed in range(3):
            for f, _, pos, title, link, teaser, cat in [r for r in rows if r[0] == feed][:SETTINGS.max_articles_per_feed]:
                t = norm(title)
                body = bodies.get(link, "") if link else ""
                text = body if len(body) >= 400 else teaser
                if link in seen or (t and any(o and difflib.SequenceMatcher(None, t, o).ratio() >= 0.75 for o in titles)) or not text:
                    continue
                prompt = by_title(title, text, cat)
                sent.append(prompt)
                if not fails(prompt):
                    titles.append(t)
                    seen[link] = day
                    accepted.append((day, feed, pos))
        seen = {x: d for x, d in seen.items() if d >= day - dt.timedelta(days=SETTINGS.seen_retention_days)}
    return accepted, sent, seen


@pytest.fixture(scope="module")
def by_title(spark):
    """Prompt of (title, text, category), from the prompt operator itself."""
    from gazette.functions import text as T
    from gazette.operators import prompts as PR
    rows = {(r[3], x, r[6]) for k in range(12) for r in feeds_of(k) for x in [b for _, b in BODIES] + [r[5]]}
    df = spark.createDataFrame(sorted(rows), "title string, text string, category string")
    df = PR.article_prompt(df.withColumn("long_form", T.is_long_form("category", SETTINGS.long_form_categories)), SETTINGS)
    known = {(r.title, r.text, r.category): r.prompt for r in df.collect()}
    return lambda *key: known[key]


def frames(spark, k):
    return spark.createDataFrame(feeds_of(k), COLS), spark.createDataFrame(BODIES, "link string, body string")


def test_backfill_equals_the_sequential_runs(spark, tmp_path, by_title):
    """The same articles, and not one call more."""
    days, log = [0, 1, 2, 4, 5, 9], str(tmp_path / "calls")
    entries = None
    for k in days:
        e = frames(spark, k)[0].withColumn("run_date", F.lit(DAY + dt.timedelta(days=k)))
        entries = e if entries is None else entries.unionByName(e)
    store = ReplyStore(spark, scratch_path(spark, "replies"))
    got = RN.backfill(entries, frames(spark, 0)[1], store, RN.Model(model(log), 4, attempts=1, base_delay_s=0), SETTINGS, "1")
    accepted, sent, _ = sequential(days, by_title)
    assert sorted((r.run_date, r.feed_ord, r.entry_pos) for r in got.collect()) == sorted(accepted)
    assert any(map(fails, sent)) and article_calls(log) == sorted(set(sent))


def test_run_day_over_days(spark, tmp_path, by_title):
    """Runs one after the other, a quiet rerun, and a run that broke off after its calls."""
    root, log = scratch_path(spark, "run-days"), str(tmp_path / "calls")
    m = RN.Model(model(log), 4, attempts=1, base_delay_s=0)
    days = [0, 1, 3]
    accepted, sent, seen = sequential(days, by_title)
    for k in days:
        day = DAY + dt.timedelta(days=k)
        new = RN.run_day(spark, root, day, *frames(spark, k), m, SETTINGS)
        assert new == sum(a[0] == day for a in accepted)
        if k == 0:                               # the roundup is due on the first day, a Sunday
            first = {r.product: r for r in PD.read_products(spark, f"{root}/products").collect()}
            assert set(first) == {"quiz", "deep", "weekly"} and first["quiz"].quiz is None and first["weekly"].weekly.intro.startswith("i")
            assert first["weekly"].weekly.label == "2026-02-23 – 2026-03-01"
    digest = RN.published_days(spark, root, day, SETTINGS).collect()
    assert sorted({(r.day, r.slug) for r in digest}) == sorted((r.day, r.slug) for r in digest) and len(digest) == len(accepted)
    assert all(r.summary.startswith("sum ") and r.brief.startswith("brief ") and len(r.qa) == 3 for r in digest)
    assert {r.link: r.first_seen for r in STT.read_seen(spark, f"{root}/seen").collect()} == seen
    recent = STT.read_recent(spark, f"{root}/recent").collect()
    assert sorted((r.day, r.pos) for r in recent) == sorted((r.day, r.pos) for r in digest)
    now = {r.product: r for r in PD.read_products(spark, f"{root}/products").collect()}
    assert now["weekly"] == first["weekly"]                        # kept from the Sunday
    assert now["quiz"].source_day == DAY + dt.timedelta(days=1) and [q.question[0] for q in now["quiz"].quiz] == ["z"]
    assert now["deep"].as_of == day and now["deep"].deep.points == ["p"] and now["deep"].deep.glossary == []
    pages = spark.read.parquet(f"{root}/pages")
    assert {r.slug for r in pages.select("slug").distinct().collect()} == {r.slug for r in digest}
    # the accepted entries again, and some without text: all seen, nothing new
    calls, before = article_calls(log), sorted(map(tuple, digest), key=str)
    entries, bodies = frames(spark, days[-1])
    taken = spark.createDataFrame([a[1:] for a in accepted if a[0] == day], "feed_ord int, entry_pos long")
    quiet = entries.join(taken, ["feed_ord", "entry_pos"], "left_semi").unionByName(
        entries.withColumns({"link": F.lit(""), "summary": F.lit("")}))
    assert RN.run_day(spark, root, day, quiet.select(*entries.columns), bodies, m, SETTINGS) == 0 and article_calls(log) == calls
    assert sorted(map(tuple, RN.published_days(spark, root, day, SETTINGS).collect()), key=str) == before
    assert {r.product: r for r in PD.read_products(spark, f"{root}/products").collect()} == now
    # a run that broke off before its state was saved has its replies in the store
    other = scratch_path(spark, "run-broken")
    os.rename(f"{root.removeprefix('file:')}/replies", f"{root.removeprefix('file:')}/moved")
    spark.read.parquet(f"{root}/moved/kind=summary").write.parquet(f"{other}/replies/kind=summary")
    assert RN.run_day(spark, other, DAY, *frames(spark, 0), m, SETTINGS) == sum(a[0] == DAY for a in accepted)
    assert article_calls(log) == calls


def test_products_switched_off(spark, tmp_path):
    root, log = scratch_path(spark, "run-off"), str(tmp_path / "calls")
    off = SETTINGS.with_(editor_brief=False, deep_read=False, quiz_questions=0, weekly_roundup=False)
    assert RN.run_day(spark, root, DAY, *frames(spark, 0), RN.Model(model(log), 4, attempts=1, base_delay_s=0), off) > 0
    rows = {r.product: r for r in PD.read_products(spark, f"{root}/products").collect()}
    assert set(rows) == {"quiz", "deep"} and rows["quiz"].quiz is None and rows["deep"].deep is None
    assert all(json.loads(x)[1] == 800 for x in open(log))


def test_a_failed_article_frees_its_title_and_link(spark):
    """a blocks b (title) and c (link); a fails, so b is asked, and c, which b does not block."""
    nodes = spark.createDataFrame([(1, 1, "l1", "abcd"), (1, 2, "l2", "abcx"), (1, 3, "l1", "zzzz"), (1, 4, "l2", "yyyy")],
                                  "run int, o int, link string, t string")
    edges = D.similar_titles(nodes, "run", "t").select("run", "new_title", "old_title")
    asked = []

    def judge(new):
        rows = [r.o for r in new.collect()]
        asked.extend(rows)
        return new.where(F.col("o") == 1)
    got = {r.o for r in D.greedy_rounds(nodes, edges, judge=judge).where("accepted").collect()}
    assert got == {2, 3} and sorted(asked) == [1, 2, 3]
