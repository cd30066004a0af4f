"""Lenient parsing and cleaning of model replies, on Spark's VARIANT type.

``try_parse_json`` yields NULL for malformed text, which is what the lenient
rule needs (``from_json`` would give a struct of nulls).  The rule: strip; if
the reply is fenced, drop the backticks and a leading ``json``; parse; if that
fails, parse from the first ``{`` to the last ``}``; a value that is not a JSON
object is an error.

Each step lands in its own named column (``with_parsed``): the parsed value is
referenced many times by the cleaners, and a Column object reused inside one
expression would be copied into the plan at every use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _c, strip_ws


def brace_span(text) -> Column:
    t = _c(text)
    start = F.instr(t, "{")
    end = F.length(t) - F.instr(F.reverse(t), "}") + 1
    ok = (start > 0) & (F.instr(t, "}") > 0)
    return F.when(ok, F.substring(t, start, F.greatest(end - start + 1, F.lit(0))))


STRING = r'(?s)"(?:[^"\\]|\\.)*+"'
SCALAR = r'(?s)^(?:"(?:[^"\\]|\\.)*+"|[^\s\[\]{}":,]+)$'


def _strict(parsed: str, text: str) -> Column:
    """``try_parse_json`` also accepts trailing text after the value; Python does not.
    Keep the value only when nothing follows it: with string contents removed, the brackets of a list or object
    must close for the first time at the last character; a scalar must be the whole text."""
    p, t = F.col(parsed), F.col(text)
    bare = F.regexp_replace(t, STRING, "")
    steps = F.filter(F.split(F.regexp_replace(bare, r"[^\[\]{}]", ""), ""), lambda c: c != "")

    def step(acc, c):
        depth = acc["d"] + F.when(c.isin("[", "{"), 1).otherwise(-1)
        return F.struct(depth.alias("d"), (acc["n"] + (depth == 0).cast("int")).alias("n"))

    closed = F.aggregate(steps, F.struct(F.lit(0).alias("d"), F.lit(0).alias("n")), step, lambda acc: (acc["d"] == 0) & (acc["n"] == 1))
    nested = F.left(t, F.lit(1)).isin("[", "{")
    whole = F.when(nested, F.right(bare, F.lit(1)).isin("]", "}") & closed).otherwise(t.rlike(SCALAR))
    return F.when(p.isNotNull() & whole, p)


def with_parsed(df: DataFrame, raw: str = "reply", out: str = "v", land: bool = True) -> DataFrame:
    """Add ``out``: VARIANT of the reply, or NULL when the lenient rule fails."""
    tmp = ["_rt", "_ri", "_ru", "_rp1", "_rv1", "_rs", "_rp2", "_rv"]
    d = df.withColumn("_rt", strip_ws(F.coalesce(F.col(raw), F.lit(""))))
    d = d.withColumn("_ri", F.regexp_replace("_rt", r"^`+|`+$", ""))
    d = d.withColumn("_ri", F.when(F.startswith(F.lower("_ri"), F.lit("json")), F.substring("_ri", 5, 1 << 30))
                     .otherwise(F.col("_ri")))
    d = d.withColumn("_ru", F.when(F.startswith("_rt", F.lit("```")), strip_ws("_ri")).otherwise(F.col("_rt")))
    d = d.withColumn("_rp1", F.try_parse_json("_ru")).withColumn("_rv1", _strict("_rp1", "_ru"))
    d = d.withColumn("_rs", brace_span("_ru")).withColumn("_rp2", F.try_parse_json("_rs"))
    d = d.withColumn("_rv", F.when(F.col("_rv1").isNotNull(), F.col("_rv1")).otherwise(_strict("_rp2", "_rs")))
    d = d.withColumn(out, F.when(F.schema_of_variant("_rv").startswith("OBJECT"), F.col("_rv"))).drop(*tmp)
    # The parsed table is the stage boundary: cleaners reference ``out`` many times and
    # filters on their results would otherwise be pushed back through the whole parse.
    return d.checkpoint(eager=True) if land else d


def field(v, path: str, typ: str = "string") -> Column:
    return F.try_variant_get(_c(v), path, typ)


def has_key(v, key: str) -> Column:
    """The key is present, whatever its value (a JSON null included)."""
    return field(v, f"$.{key}", "variant").isNotNull()


def text_field(v, key: str) -> Column:
    """``str(data.get(key, "")).strip()`` for string-like values; a JSON null reads as ``None``."""
    absent = F.when(has_key(v, key), F.lit("None")).otherwise(F.lit(""))
    return strip_ws(F.coalesce(field(v, f"$.{key}"), absent))


def items(v, key: str) -> Column:
    """JSON list under ``key`` as array<variant>; empty when absent."""
    return F.coalesce(field(v, f"$.{key}", "array<variant>"), F.array().cast("array<variant>"))


def both_keys(item, a: str, b: str) -> Column:
    return has_key(item, a) & has_key(item, b)


def pair(item, a: str, b: str) -> Column:
    return F.struct(text_field(item, a).alias(a), text_field(item, b).alias(b))


def _is_obj(x) -> Column:
    return F.schema_of_variant(x).startswith("OBJECT")


def _list_ok(v, key: str, n: int | None, item_ok) -> Column:
    """The key is absent, or a list whose first ``n`` items pass ``item_ok``."""
    raw = field(v, f"$.{key}", "variant")
    arr = field(v, f"$.{key}", "array<variant>")
    head = arr if n is None else F.slice(arr, 1, n)
    return raw.isNull() | (arr.isNotNull() & F.forall(head, item_ok))


def summary_reply(df: DataFrame, v: str = "v") -> DataFrame:
    """Article reply: required ``summary``, optional ``summary_secondary``, first 3 ``qa`` items,
    each needing ``question`` and ``answer``; any violation fails the reply (``reply_ok``)."""
    c = F.col(v)
    ok = (c.isNotNull() & has_key(c, "summary")
          & _list_ok(c, "qa", 3, lambda x: both_keys(x, "question", "answer")))
    return (df.withColumn("reply_ok", F.coalesce(ok, F.lit(False)))
              .withColumn("summary", text_field(c, "summary"))
              .withColumn("summary_secondary", text_field(c, "summary_secondary"))
              .withColumn("qa", F.transform(F.slice(items(c, "qa"), 1, 3), lambda x: pair(x, "question", "answer"))))


def quiz_reply(df: DataFrame, n: int, v: str = "v") -> DataFrame:
    """First ``n`` quiz items, then those with a non-blank question and answer (so fewer may remain)."""
    c = F.col(v)
    ok = c.isNotNull() & _list_ok(c, "quiz", n, _is_obj)
    head = F.slice(items(c, "quiz"), 1, n) if n > 0 else F.array().cast("array<variant>")
    cleaned = F.transform(head, lambda x: pair(x, "question", "answer"))
    kept = F.filter(cleaned, lambda p: (F.length(p["question"]) > 0) & (F.length(p["answer"]) > 0))
    return df.withColumn("reply_ok", F.coalesce(ok, F.lit(False))).withColumn("quiz", kept)


def deep_reply(df: DataFrame, v: str = "v") -> DataFrame:
    """Deep read: blank points dropped, glossary items need both sides; kept when any part is non-empty."""
    c = F.col(v)
    ok = c.isNotNull() & _list_ok(c, "glossary", None, _is_obj)
    points = F.filter(F.transform(items(c, "points"), lambda x: strip_ws(F.coalesce(field(x, "$"), F.lit("")))),
                      lambda p: F.length(p) > 0)
    gloss = F.filter(F.transform(items(c, "glossary"), lambda x: pair(x, "term", "definition")),
                     lambda g: (F.length(g["term"]) > 0) & (F.length(g["definition"]) > 0))
    d = (df.withColumn("reply_ok", F.coalesce(ok, F.lit(False)))
           .withColumn("background", text_field(c, "background"))
           .withColumn("points", points)
           .withColumn("implications", text_field(c, "implications"))
           .withColumn("glossary", gloss))
    keep = ((F.length("background") > 0) | (F.size("points") > 0) | (F.length("implications") > 0)
            | (F.size("glossary") > 0))
    return d.withColumn("keep", F.col("reply_ok") & keep)


def weekly_reply(df: DataFrame, v: str = "v") -> DataFrame:
    """Weekly roundup: themes need title and body; kept when there is an intro or a theme."""
    c = F.col(v)
    ok = c.isNotNull() & _list_ok(c, "themes", None, _is_obj)
    themes = F.filter(F.transform(items(c, "themes"), lambda x: pair(x, "title", "body")),
                      lambda t: (F.length(t["title"]) > 0) & (F.length(t["body"]) > 0))
    d = (df.withColumn("reply_ok", F.coalesce(ok, F.lit(False)))
           .withColumn("intro", text_field(c, "intro")).withColumn("themes", themes))
    return d.withColumn("keep", F.col("reply_ok") & ((F.length("intro") > 0) | (F.size("themes") > 0)))


def brief_text(v) -> Column:
    return F.when(_c(v).isNotNull(), text_field(v, "brief"))


def theme_paragraphs(body) -> Column:
    """Theme body split on newlines, stripped, blanks dropped."""
    return F.filter(F.transform(F.split(F.coalesce(_c(body), F.lit("")), "\n", -1), strip_ws),
                    lambda p: F.length(p) > 0)
