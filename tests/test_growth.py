"""Operators on one very long article: right, and without arrays that grow with it."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gazette.operators import paging as P
from gazette.operators import summaries as SM


def costs_of(paras):
    return [max(1.0, 0 / 32.0 + len(re.findall("[A-Za-z0-9]+", p)) / 12.0) + 0.7 for p in paras]


def pages_of(paras, lines):
    out, used = [], 0.0
    for p, c in zip(paras, costs_of(paras)):
        if not out or used + c > lines:
            out.append([])
            used = 0.0 + c
        else:
            used += c
        out[-1].append(p)
    return out or [[]]


@pytest.mark.parametrize("block", [1, 3, 128])
def test_pages_of_long_articles(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    rng = random.Random(block)
    texts = [[" ".join(["w"] * rng.choice([1, 3, 30, 90, 400])) + f" {k}" for k in range(n)] for n in (0, 1, 2, 7, 130, 6000)]
    df = spark.createDataFrame([(i, "\n\n".join(t)) for i, t in enumerate(texts)], "id int, text string")
    got = {}
    for r in P.pages(P.paginate(df, "text", 14)).select("id", "page_no", "page_total", "page_paragraphs").collect():
        got.setdefault(r.id, []).append((r.page_no, r.page_total, r.page_paragraphs))
    for i, t in enumerate(texts):
        want = pages_of(t, 14)
        assert sorted(got[i]) == [(k, len(want), p) for k, p in enumerate(want, 1)]
    of = {r.id: r.n for r in P.paginate(df, "text", 14).select("id", P.paragraph_pages().alias("n")).collect()}
    assert of[5] == [k for k, p in enumerate(pages_of(texts[5], 14), 1) for _ in p]
    one = P.paginate(df, "text", 0).select(F.size("pages").alias("page_total")).distinct().collect()
    assert [r.page_total for r in one] == [1]


def words(t):
    return re.findall(r"[a-z0-9]+", t.lower())


def test_summary_and_terms_with_a_long_text(spark):
    rng = random.Random(1)
    texts = {k: " ".join(" ".join(rng.choice(["the", "of", f"w{rng.randrange(300)}", f"r{rng.randrange(9000)}"]) for _ in range(rng.randint(1, 12))).capitalize()
                         + rng.choice(".!?") for _ in range(n)) for k, n in enumerate([1, 2, 3, 40, 3000])}
    texts |= {90: "", 91: None, 92: " ... !!", 93: "no end"}
    df = spark.createDataFrame(list(texts.items()), "id int, text string")
    n_docs = len(texts)
    df_of = Counter(w for t in texts.values() for w in set(words(t or "")))
    idf = {w: math.log(n_docs / n) for w, n in df_of.items()}
    got = {r.id: r.summary for r in SM.extractive_summary(df, "id", "text").collect()}
    for k, t in texts.items():
        parts = [(i, re.sub(r"\s+", " ", s).strip()) for i, s in enumerate(re.findall(r"[^.!?]+[.!?]*", t or ""))]
        parts = [(i, s) for i, s in parts if s]
        score = {i: round(sum(idf[w] for w in words(s)) / len(words(s)), 9) if words(s) else 0.0 for i, s in parts}
        best = sorted(sorted(parts, key=lambda p: (-score[p[0]], p[0]))[:3])
        assert got.get(k) == (" ".join(s for _, s in best) if best else None), k
    terms = {}
    for r in SM.glossary_terms(df, "id", "text").collect():
        terms.setdefault(r.id, []).append((r.term_rank, r.term))
    for k, t in texts.items():
        c = Counter(words(t or ""))
        best = sorted(c, key=lambda w: (-round(c[w] * idf[w], 9), w))[:4]
        assert sorted(terms.get(k, [])) == list(enumerate(best, 1)), k


def test_best_sentences_are_a_grouped_limit(spark):
    df = spark.createDataFrame([(1, "A b. C d. E f. G h.")], "id int, text string")
    plan = SM.extractive_summary(df, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rare_words_and_small_tasks_give_the_same(spark, monkeypatch):
    """Summaries and terms with few words broadcast, and tasks that follow the size of the text."""
    rng = random.Random(4)
    texts = [(k, " ".join(rng.choice(["the", "of", f"w{rng.randrange(40)}", f"r{rng.randrange(900)}."]) for _ in range(80))) for k in range(40)]
    df = spark.createDataFrame(texts + texts[:3] + [(None, "no id here. the w1")], "id int, text string")
    both = lambda: [sorted(map(str, f(df, "id", "text").collect())) for f in (SM.extractive_summary, SM.glossary_terms)]
    whole = both()
    monkeypatch.setattr(SM, "HOT_WORDS", 100)
    monkeypatch.setattr(SM, "TASK_BYTES", 1000)
    assert SM.dealt_by(df, "id", "text").rdd.getNumPartitions() >= sum(len(t) for _, t in texts) // 1000
    hot, rare = SM.split_idf(SM.word_counts(df, ["id"], "text"), SM.F.lit(44))
    assert 0 < hot.count() <= 100 < rare.count()
    assert both() == whole
