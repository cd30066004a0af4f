"""Operators of built-in functions: DuckDB statements on the small tables, plain Python on odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from gazette.llm import exact, pii, queries, sharding
from gazette.llm.common import ascii_lower, connected_components


def rows_of(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("name", ["op1_pii", "op4_exact_dedup", "op10_sharding", "op7_vector_dedup"])
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    rel = con.sql(queries.ORACLE[name])
    order = [rel.columns.index(c) for c in sorted(rel.columns)]
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df) == Counter(tuple(r[k] for k in order) for r in rel.fetchall())


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# ---- exact de-duplication

def want_groups(rows):
    groups = {}
    for r in rows:
        groups.setdefault(lower(r["text"]), []).append(r["doc_id"])
    out, used = Counter(), set()
    for r in rows:
        t = lower(r["text"])
        ids = [i for i in groups[t] if i is not None]
        keep = max(ids) if ids else None
        first = (t, r["doc_id"]) not in used and r["doc_id"] == keep
        if first:
            used.add((t, r["doc_id"]))
        out[(r["doc_id"], len(groups[t]), keep, first, hashlib.sha256(t.encode()).hexdigest())] += 1
    return out


def test_exact_groups(docs, wide, no_docs):
    got = Counter((r.doc_id, r.group_size, r.keep_id, r.kept, r.text_sha256) for r in exact.exact_groups(docs).collect())
    assert got == want_groups(docs.collect())
    assert rows_of(exact.exact_groups(wide)) == rows_of(exact.exact_groups(docs))
    assert exact.exact_groups(no_docs).count() == 0


def test_weak_identifier_is_found_out(docs):
    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(3))            # noqa: E731
    got = Counter((r.doc_id, r.group_size) for r in exact.exact_groups(docs, [weak, exact.id128]).collect())
    assert got == Counter((r[0], r[1]) for r in want_groups(docs.collect()).elements())
    with pytest.raises(RuntimeError):
        exact.exact_groups(docs, [weak])


def test_chunks_give_the_text_back(docs):
    text = ascii_lower(F.coalesce("text", F.lit("")))
    d = docs.select(text.alias("t"), exact.chunks_of(text).alias("c")).collect()
    assert all("".join(r.c) == r.t for r in d)
    long = max(d, key=lambda r: len(r.t))
    assert len(long.c) > 20


def test_chunk_borders_follow_the_content(spark):
    body = " ".join(f"Sentence number {k} says {k * k % 97}." for k in range(400))
    d = spark.createDataFrame([(body,), ("A new beginning. " + body,)], ["t"]).select(exact.chunks_of(F.col("t")).alias("c")).collect()
    a, b = set(d[0].c), set(d[1].c)
    assert len(a & b) >= len(a) - 2


def test_drop_exact_keeps_rows_whole(docs, wide, no_docs):
    kept = exact.drop_exact_duplicates(wide)
    assert kept.columns == wide.columns and kept.count() == len({lower(r["text"]) for r in docs.collect()})
    assert exact.drop_exact_duplicates(no_docs).count() == 0


# ---- personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    out = []
    for kind, pat in PLAIN.items():
        for m in re.finditer(pat, t):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (13 <= len(d) <= 19 and luhn(d))
                    or kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = ["a.b@c.de, x@y.z@q.w.e and a@b.c_d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0255.3 1.2.3", "é😀 4111 1111 1111 1111 x",
          "4111-1111-1111-1112 +49 (0)30 123456-78 +1 2 3", "++1 23456789 +1.2.3.4.5.6.7.8.9", "a" * 3000 + "@" + "b" * 3000 + ".c",
          "1" * 6000, "1 " * 6000, "@" * 2000, "+1" * 2000, "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000",
          "GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789", "number 123-45-6789", "social 000-12-3456 666-12-3456 123-00-4567", None, "",
          "mail: jo@ex.org\nip 10.0.0.1\tcard 4000001234567899"]


def test_pii_against_plain_regex(spark):
    d = spark.createDataFrame([(k, t, "z") for k, t in enumerate(TRICKY)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.digest(pii.find_pii(d)).collect()}
    for k, t in enumerate(TRICKY):
        want = base_spans(t or "")
        assert got[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [s for s in got[k].spans.split(",") if s and s.split(":")[0] in PLAIN] == want
        assert (got[k].n_email, got[k].n_ip, got[k].n_card, got[k].n_phone) == tuple(
            sum(w.startswith(kind + ":") for w in want) for kind in PLAIN)
    assert [got[k].n_iban for k in (10, 11)] == [2, 0]
    assert [got[k].n_ssn for k in (12, 13, 14)] == [1, 0, 0]


def test_pii_odd_rows(docs, wide, no_docs):
    assert rows_of(pii.digest(pii.find_pii(wide))) == rows_of(pii.digest(pii.find_pii(docs)))
    assert pii.find_pii(docs).count() == docs.count() and pii.find_pii(no_docs).count() == 0


# ---- sharding

@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 97, 1000])
def test_feistel_is_a_permutation(spark, n):
    p = [r[0] for r in spark.range(n).select(sharding.feistel(F.col("id"), n, 2024)).collect()]
    assert sorted(p) == list(range(n))
    if n >= 97:
        assert sum(a == b for a, b in zip(p, range(n))) < n / 8
        other = [r[0] for r in spark.range(n).select(sharding.feistel(F.col("id"), n, 2025)).collect()]
        assert other != p


def test_shards(docs, wide, no_docs):
    rows = sharding.shard(docs, 5).collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == docs.count() and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    again = rows_of(sharding.shard(docs.repartition(7, "text"), 5))
    assert again == rows_of(sharding.shard(docs, 5)) == rows_of(sharding.shard(wide, 5))
    assert sharding.shard(no_docs).count() == 0


# ---- components

def test_components(spark):
    import random
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 100 + k) for k in range(1, 300)] + [(500, 500)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    par = {}

    def find(x):
        par.setdefault(x, x)
        while par[x] != x:
            x = par[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {v: find(v) for v in par}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_card_of_single_digits(spark):
    texts = ["pay 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 now", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "4-1 1-1 1-1 1-1 1-1 1-1 1-1 1-1",
             "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 2", "4  1  1", "1 2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(pii.find_pii(df)).collect()}
    for k, t in enumerate(texts):
        assert got[k].spans == ",".join(base_spans(t)) and got[k].n_card == (k < 3)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    rel = con.sql(queries.ORACLE["op1_pii"])
    have = [c for c in rel.columns]
    assert Counter(rel.fetchall()) == Counter(tuple(got[k][c] for c in have) for k in got)


def test_pii_is_linear_in_matches(spark):
    """Texts of very many proposals and of very many spans: right, and four times the text about four times the time."""
    import time

    def run(n):
        nums = ", ".join(str(k % 90 + 10) for k in range(n)) + " card 4111111111111111 end"
        mails = " mail ".join(f"u{k}@é{k}x.org" if k % 2 else f"u{k}@x{k}.org" for k in range(n // 8))
        df = spark.createDataFrame([(1, nums), (2, mails)], "doc_id long, text string").checkpoint(eager=True)
        t = time.time()
        rows = {r.doc_id: r for r in pii.digest(pii.find_pii(df)).collect()}
        return rows, nums, mails, time.time() - t
    run(1000)
    _, _, _, small = run(16_000)
    rows, nums, mails, large = run(64_000)
    assert large < 8 * small + 1 and large < 12
    assert rows[1].n_card == 1 and rows[1].spans == f"card:{nums.index('4111')}:{nums.index(' end')}"
    want = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", mails)]
    assert rows[2].spans == ",".join(want) and rows[2].n_context == len(want) - 1
