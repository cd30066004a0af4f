"""Offline stand-ins for the model and the reply stage.

* ``extractive_summary``: the 3 sentences with the highest mean word IDF, in text order.
* ``glossary_terms``: the top TF-IDF words of each article.
* ``week_themes``: a week's articles grouped by their first matching interest keyword.
* ``complete_batch``: prompt table -> reply table through a user-supplied function,
  with retries; the result is landed before use so a retried task or a second
  action never calls the model twice for the same row.

Corpus statistics are plain word counts (explode + groupBy with map-side partial
aggregation), so a frequent word is one partial count per task, not a hot key.
"""

from __future__ import annotations

import time
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C

SENTENCE = r"[^.!?]+[.!?]*"
WORD = r"[\p{L}\p{N}]+"
SUMMARY_SENTENCES = 3
GLOSSARY_TERMS = 4
MAX_THEMES = 5
TASK_BYTES = 16 << 20                            # text of one task
HOT_WORDS = 500_000                              # words whose idf is broadcast, at most


def _words(col) -> F.Column:
    return F.regexp_extract_all(F.lower(col), F.lit(WORD), 0)


def sentence_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, sno, sentence)``: the non-blank sentences in text order."""
    s = docs.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(SENTENCE), 0)).alias("sno", "sentence"))
    return s.withColumn("sentence", F.trim(F.regexp_replace("sentence", r"[\t\n\f\r ]+", " "))).where(F.length("sentence") > 0)


def word_counts(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``(keys, word, n)``: uses of each word per row key."""
    return rows.select(*keys, F.explode(_words(F.col(text))).alias("word")).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def dealt_by(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text)`` dealt by document; its readers reuse the shuffle.  A task has about ``TASK_BYTES`` of text however large the input is: the
    number of tasks is given, as adaptive coalescing goes by compressed bytes and knows nothing of the words that a text becomes."""
    size = docs.select(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select(key, text).repartition(max(least, -(-size // TASK_BYTES)), key)


def split_idf(doc_words: DataFrame, n_docs) -> tuple[DataFrame, DataFrame]:
    """``(word, idf)``, idf = ln(N / document frequency), from one row per document and word: the frequent words and the others.

    A word is frequent with at least a ``HOT_WORDS``-th of all rows, so no more than ``HOT_WORDS`` words are, and they hold most uses: they
    are broadcast, only the uses of rare words travel to their idf, and no word has many of those.
    """
    df = doc_words.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    hot = F.col("df") * HOT_WORDS >= df.select(F.sum("df")).scalar()
    idf = F.log(n_docs.cast("double") / F.col("df")).alias("idf")
    return F.broadcast(df.where(hot).select("word", idf)), df.where(~hot).select("word", idf)


def extractive_summary(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, summary)``: top sentences by mean word IDF (ties: earlier first), in text order.

    The text is dealt by document once; word counts per sentence, scores and the best sentences of a document are
    then taken where it lies.  Only the idf of rare words crosses documents: it joins their counts of (document, sentence, word).
    The best sentences are a grouped limit: no array of a document's sentences is built.
    """
    from .ordering import top_n
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    dealt = dealt_by(docs, key, text)
    s = sentence_table(dealt, key, text)
    uses = word_counts(s, [key, "sno"], "sentence")
    hot, rare = split_idf(word_counts(dealt, [key], text), n_docs)

    def sums(scored: DataFrame) -> DataFrame:
        return scored.groupBy(key, "sno").agg(F.sum(F.col("n") * F.col("idf")).alias("idf"), F.sum("n").alias("n"))
    scored = (sums(uses.join(hot, "word")).unionByName(sums(uses.join(hot, "word", "left_anti").join(rare, "word")))
              .groupBy(key, "sno").agg(F.round(F.sum("idf") / F.sum("n"), 9).alias("score")))
    ranked = s.join(scored, [key, "sno"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    best = top_n(ranked, [key], [F.col("score").desc(), F.col("sno").asc()], SUMMARY_SENTENCES, "_r")
    top = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("sno", "sentence"))).alias("_t"))                 # a few each
    return top.select(key, F.array_join(F.transform("_t", lambda x: x["sentence"]), " ").alias("summary"))


def glossary_terms(docs: DataFrame, key: str, text: str, k: int = GLOSSARY_TERMS) -> DataFrame:
    """``(key, term_rank, term, score)``: top-k words by tf * idf (ties: word order).  The text is dealt by document once.

    The best k frequent words of a document are taken where it lies, those of its rare words where they meet their idf.
    """
    from .ordering import top_n
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    tf = word_counts(dealt_by(docs, key, text), [key], text)
    hot, rare = split_idf(tf, n_docs)
    order = [F.col("score").desc(), F.col("word").asc()]

    def scored(words: DataFrame) -> DataFrame:
        return words.select(key, "word", F.round(F.col("n") * F.col("idf"), 9).alias("score"))
    near = top_n(scored(tf.join(hot, "word")), [key], order, k, "_r").drop("_r")
    sc = near.unionByName(scored(tf.join(hot, "word", "left_anti").join(rare, "word")))
    return top_n(sc, [key], order, k, "term_rank") \
        .select(key, F.col("term_rank").cast("long").alias("term_rank"), F.col("word").alias("term"), "score")


def week_themes(week: DataFrame, keywords: tuple[str, ...], k: int = MAX_THEMES) -> DataFrame:
    """Per target day: articles grouped by their first matching keyword (config order), top-k groups."""
    hay = F.lower(F.concat_ws(" ", F.col("title"), F.col("summary")))
    theme = F.lit(None).cast("string")
    for kw in reversed(keywords):
        theme = F.when(F.contains(hay, F.lower(F.lit(kw))), F.lit(kw)).otherwise(theme)
    order = F.lit(len(keywords))
    for i, kw in reversed(list(enumerate(keywords))):
        order = F.when(F.col("theme") == kw, F.lit(i)).otherwise(order)
    g = (week.withColumn("theme", theme).where(F.col("theme").isNotNull())
         .groupBy("target_day", "theme").agg(F.count(F.lit(1)).alias("n_articles"))
         .withColumn("kw_ord", order))
    from .ordering import top_n
    return top_n(g, ["target_day"], [F.col("n_articles").desc(), F.col("kw_ord").asc()], k, "theme_rank") \
        .select("target_day", F.col("theme_rank").cast("long").alias("theme_rank"), "theme", "n_articles")


def complete_batch(prompts: DataFrame, key: str, complete: Callable[[str, int], str], max_parallel: int,
                   kind: str = "summary", attempts: int = C.RETRY_ATTEMPTS,
                   base_delay_s: float = C.RETRY_BASE_DELAY_S, land: bool = True) -> DataFrame:
    """``(key, reply, error, attempts)`` for every prompt, through ``complete(prompt, max_tokens)``.

    ``repartition(max_parallel)`` bounds the concurrent calls (the provider's rate limit);
    the client is created inside the task.  A row that fails every attempt keeps its error
    and is skipped downstream, not retried by the next action: the table is landed.
    """
    cap = C.TOKEN_CAPS[kind]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies, errors, tries = [], [], []
            for prompt in pdf["prompt"]:
                reply, err, n = None, None, 0
                for n in range(1, attempts + 1):
                    try:
                        reply, err = complete(prompt, cap), None
                        break
                    except Exception as exc:  # noqa: BLE001 - any provider failure is recorded
                        err = f"{type(exc).__name__}: {exc}"
                        if n < attempts and base_delay_s > 0:
                            time.sleep(base_delay_s * (2 ** (n - 1)))
                replies.append(reply)
                errors.append(err)
                tries.append(n)
            yield pd.DataFrame({key: pdf[key], "reply": replies, "error": errors, "attempts": tries})

    key_type = dict(prompts.dtypes)[key]
    schema = f"{key} {key_type}, reply string, error string, attempts int"
    out = prompts.select(key, "prompt").repartition(max_parallel).mapInPandas(run, schema)
    return out.checkpoint(eager=True) if land else out
