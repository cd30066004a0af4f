"""Personal data spans (built-in functions only).

Regular expressions propose spans; validators confirm them (Luhn for cards, mod 97 for IBANs, value
ranges for addresses, digit counts for phones); words in the 40 code points before a span raise its score.  The base
kinds (email, ip, card, phone) stay whenever their validator passes; the added kinds (iban, ssn)
stay from ``min_score`` on, so a bare 3-2-4 digit group needs a context word.

A span's place comes from the gaps: splitting a text by a pattern gives the pieces between the
matches, so a running sum of piece and match lengths is the code point offset.  Patterns are written
so that a match attempt never rescans what an earlier attempt covered: runs are possessive, and the e-mail pattern starts only where a
run starts or the last match ended, which is where a leftmost search would find it.  One fold per kind carries place and context, so a
text with very many matches costs time in proportion to its length.

Defined cases: null and empty texts have no spans; spans of different kinds may overlap; a failing
match is dropped and not retried from a later start; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import let, text_or_empty

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
KINDS = BASE + ADDED
CONTEXT_WINDOW = 40
BLOCK = 64                                       # spans in a block of the fold
# no valid span of a kind is shorter
LEAST = {"email": 5, "ip": 7, "card": 13, "phone": 10, "iban": 15, "ssn": 11}

PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
# what a text must hold for a kind to be looked for
HINT = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
HINT_PATTERN = {"card": "[0-9][ -]?[0-9]", "iban": "[0-9][0-9]"}
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT_BONUS = 0.4
CONTEXT = {
    "email": "mail|contact|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|anruf",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn check of a string of digits."""
    back = F.reverse(number)

    def step(acc, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """ISO 7064 mod 97-10 check of a code whose first four characters move to its end."""
    bare = F.regexp_replace(code, " ", "")
    turned = F.concat(F.substr(bare, F.lit(5)), F.substring(bare, 1, 4))

    def step(acc, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, s: Column) -> Column:
    v, before, after = s["v"], F.right(s["near"], F.lit(1)), s["after"]
    if kind == "ip":
        return v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        d = digits(v)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(digits(v)).between(9, 15)
    if kind == "iban":
        return ~before.rlike("[A-Za-z0-9]") & ~after.rlike("[A-Za-z0-9]") & mod97(v)
    if kind == "ssn":
        return (~before.rlike("[0-9-]") & ~after.rlike("[0-9-]")
                & v.rlike("^(?:00[1-9]|0[1-9][0-9]|[1-578][0-9][0-9]|6(?:[0-57-9][0-9]|6[0-57-9]))-(?:0[1-9]|[1-9][0-9])-")
                & ~v.rlike("0000$"))
    return F.lit(True)


def _found(kind: str, text: Column) -> Column:
    """array<struct<s, e, v, near, after>>: every match that is long enough, with its place, the code points before it (up to
    ``CONTEXT_WINDOW``) and the one after it.

    The fold carries the last code points that it passed, so it never goes back into the text, and collects in blocks of ``BLOCK``, so a
    match copies one short block: the work is linear in the text, however many matches it has.
    """
    gaps, hits = F.split(text, PATTERN[kind], -1), F.regexp_extract_all(text, F.lit(PATTERN[kind]), 0)
    one = "struct<s:int,e:int,v:string,near:string,after:string>"
    none = F.array().cast(f"array<{one}>")
    window = F.lit(CONTEXT_WINDOW)

    def place(g: Column, h: Column) -> Column:
        def step(acc, i):
            def at(near):
                hit = F.get(h, i)
                s = acc["pos"] + F.length(F.get(g, i))
                e = s + F.length(hit)
                long = F.length(hit) >= LEAST[kind]
                full = F.size(acc["block"]) >= BLOCK
                after = F.left(F.concat(F.get(g, i + 1), F.coalesce(F.get(h, i + 1), F.lit(""))), F.lit(1))
                span = F.struct(s.alias("s"), e.alias("e"), hit.alias("v"), near.alias("near"), after.alias("after"))
                return F.struct(
                    e.alias("pos"), F.right(F.concat(near, hit), window).alias("near"),
                    F.when(~long, acc["block"]).when(full, F.array(span)).otherwise(F.array_append(acc["block"], span)).alias("block"),
                    F.when(long & full, F.array_append(acc["blocks"], acc["block"])).otherwise(acc["blocks"]).alias("blocks"))
            return let(F.right(F.concat(acc["near"], F.get(g, i)), window), at)
        start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("near"), none.alias("block"), F.array().cast(f"array<array<{one}>>").alias("blocks"))
        return F.aggregate(F.sequence(F.lit(0), F.size(h) - 1), start, step, lambda acc: F.flatten(F.array_append(acc["blocks"], acc["block"])))

    found = let(hits, lambda h: F.when(F.size(h) > 0, let(gaps, lambda g: place(g, h))).otherwise(none))
    hint = F.contains(text, F.lit(HINT[kind])) if kind in HINT else text.rlike(HINT_PATTERN[kind])
    return F.when(hint, found).otherwise(none)


def _check(kind: str):
    return lambda s: _valid(kind, s)


def _tagged(kind: str):
    """Span with its kind and whether a context word stands before it."""
    def tag(s: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), s["s"].alias("s"), s["e"].alias("e"), s["v"].alias("v"),
                        s["near"].rlike(f"(?i)(?:{CONTEXT[kind]})").alias("context"))
    return tag


def _scores(kind: str, min_score: float):
    return lambda s: F.lit(BASE_SCORE[kind]) + F.when(s["context"], CONTEXT_BONUS).otherwise(0.0) >= min_score


def find_pii(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` as (doc_id, spans): spans array<struct<kind, s, e, v, score, context>>
    by kind as listed in KINDS, then start.  Offsets are code points, the end exclusive."""
    d = docs.select("doc_id", text_or_empty().alias("text"))
    text = F.col("text")
    parts = []
    for kind in KINDS:
        spans = F.transform(F.filter(_found(kind, text), _check(kind)), _tagged(kind))
        if kind in ADDED and BASE_SCORE[kind] < min_score:
            spans = F.filter(spans, _scores(kind, min_score))
        parts.append(spans)
    base = F.create_map(*[F.lit(x) for k in KINDS for x in (k, BASE_SCORE[k])])
    return d.select("doc_id", F.transform(F.concat(*parts), lambda s: F.struct(
        s["kind"].alias("kind"), s["s"].alias("s"), s["e"].alias("e"), s["v"].alias("v"), s["context"].alias("context"),
        F.least(F.lit(1.0), F.element_at(base, s["kind"]) + F.when(s["context"], CONTEXT_BONUS).otherwise(0.0))
        .alias("score"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans (joined as kind:start:end), n_context."""
    def joined(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda s: F.concat_ws(
            ":", s["kind"], s["s"].cast("string"), s["e"].cast("string"))), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    spans = F.col("spans")
    counts = [counted(k) for k in KINDS]
    return found.select(
        "doc_id", *counts[:len(BASE)],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        joined(spans).alias("spans"), *counts[len(BASE):],
        F.size(F.filter(spans, lambda s: s["context"])).cast("long").alias("n_context"))
