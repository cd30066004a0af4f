"""Near-duplicates of documents, passages and vectors against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gazette.llm import common, minhash, substring, vectors
from gazette.llm.shingles import shingle_hashes, word_hashes, text_bytes


def norm(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


def shingles(t):
    w = norm(t)
    return [tuple(w[k:k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def test_shingle_hashes_follow_the_words(docs, monkeypatch):
    from gazette.llm import shingles as mod
    texts = [r["text"] or "" for r in docs.collect()] + ["a b c d e f", "", "A. b, c-d e F", "漢字 é b c d e"]
    monkeypatch.setattr(mod, "SLAB", 1000)                     # many slabs
    s, starts, n_words = shingle_hashes(pa.array(texts))
    seen = {}
    for k, t in enumerate(texts):
        want, got = shingles(t), s[starts[k]:starts[k + 1]].tolist()
        assert len(want) == len(got) and n_words[k] == len(norm(t))
        for x, h in zip(want, got):
            assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)
    part = pa.array(["skip", *texts]).slice(1)                  # an offset array
    assert (shingle_hashes(part)[0] == s).all()
    assert len(word_hashes(*text_bytes(pa.array(["", None])))[0]) == 0


def classes(links, ids):
    par = {i: i for i in ids}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def edited(rng, base, n):
    w = list(base)
    for k in rng.sample(range(len(w)), n):
        w[k] = f"new{rng.randrange(10 ** 6)}"
    return w


def corpus():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(3000)}"                   # noqa: E731
    out = [[word() for _ in range(rng.randint(30, 200))] for _ in range(60)]
    line = [word() for _ in range(15)]
    for k in range(0, 60, 2):
        out[k] = out[k] + line                                  # boilerplate
    for n in (1, 2, 3, 4, 6, 10, 30):
        for k in range(5):
            out.append(edited(rng, out[10 + k], min(n, len(out[10 + k]))))
    out += [out[3], out[3], out[4][:4], [], []]
    return [(k, " ".join(w)) for k, w in enumerate(out)]


def test_near_classes_against_all_pairs(spark):
    rows = corpus()
    sets = {i: Counter(shingles(t)) for i, t in rows}
    df = Counter(x for s in sets.values() for x in s)
    idf = {x: 1 - minhash.DAMP + minhash.DAMP * np.log(min(max(len(rows) / n, 1), minhash.RARE)) / np.log(minhash.RARE) for x, n in df.items()}
    links, clear = [], []
    for a, x in sets.items():
        for b, y in sets.items():
            if a < b:
                both = sum(min(x[k], y[k]) * idf[k] for k in x if k in y)
                all_ = sum(x[k] * idf[k] for k in x) + sum(y[k] * idf[k] for k in y) - both
                sim = 1.0 if dict(rows)[a] == dict(rows)[b] else both / all_ if all_ else 0
                if sim >= 0.8:
                    links.append((a, b))
                if sim >= 0.78:
                    clear.append((a, b))
    got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want, most = classes(links, got), classes(clear, got)
    assert sum(got[i] != want[i] for i in got) <= 1            # the sampling may miss a rare link
    assert all(most[i] == most[c] for i, c in got.items())     # and never makes one


def templated(rng, n, share, pairs, edits):
    """n texts of 120 words with one template in ``share`` of their words; ``pairs`` edited copies of the first ones."""
    word = lambda: f"w{rng.randrange(10 ** 6)}"                # noqa: E731
    line = [word() for _ in range(int(120 * share))]
    texts = [line + [word() for _ in range(120 - len(line))] for _ in range(n)]
    return texts + [t[:len(line)] + edited(rng, t[len(line):], edits) for t in texts[:pairs]]


def test_copies_among_texts_of_one_template(spark):
    """Near copies meet although thousands of texts share most of their weight with them."""
    rng = random.Random(31)
    for share in (0.7, 0.8):
        texts, n, pairs = [], 1000, 100
        for edits in (2, 3, 4):
            texts += templated(rng, n, share, pairs, edits)
        rows = [(k, " ".join(w)) for k, w in enumerate(texts)]
        sets = [Counter(shingles(t)) for _, t in rows]
        df = Counter(x for s in sets for x in s)
        idf = {x: 1 - minhash.DAMP + minhash.DAMP * np.log(min(max(len(rows) / c, 1), minhash.RARE)) / np.log(minhash.RARE) for x, c in df.items()}

        def similarity(x, y):
            both = sum(min(x[k], y[k]) * idf[k] for k in x if k in y)
            return both / (sum(x[k] * idf[k] for k in x) + sum(y[k] * idf[k] for k in y) - both)
        mutual = similarity(sets[0], sets[1])
        planted = [(s + k, s + n + k) for s in (0, n + pairs, 2 * (n + pairs)) for k in range(pairs)]
        near = [(a, b) for a, b in planted if similarity(sets[a], sets[b]) >= 0.8]
        got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        met = sum(got[a] == got[b] for a, b in near)
        print(f"template {share}: mutual {mutual:.2f}, near {len(near)}, met {met}")
        assert len(near) > 100 and met >= 0.98 * len(near)
        assert all(got[a] != got[b] for a, b in planted if similarity(sets[a], sets[b]) < 0.795)


def test_links_that_no_leader_brings(spark, monkeypatch):
    """Two copies in a bucket led by a text unlike both are linked; the blocks of a large bucket lose no pair."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(10 ** 6)}"                # noqa: E731
    texts = [[word() for _ in range(150)] for _ in range(40)]
    texts += [edited(rng, t, 1) for t in texts]
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], schema)
    rows = df.select("doc_id", minhash.text_hash(minhash.text_or_empty()).alias("th"), "text")
    n, counts = minhash.document_frequencies(df)
    idf = minhash.idf_table(n, counts)
    out = "doc_id long, th long, bands array<long>, wordy boolean, s0 long, s1 long, s2 long"
    sketches = rows.mapInArrow(minhash._signatures(idf, minhash.steep_table(n, counts)), out).select("doc_id", "th", *minhash.SKETCH).checkpoint()
    one = sketches.selectExpr("th", "7L as key")               # all in one bucket: one leader
    ids = {r.th: r.doc_id for r in sketches.collect()}
    led = {(r.a, r.b) for r in minhash.candidate_pairs(one).collect()}
    none = spark.createDataFrame([], "a long, b long")
    for block in (2000, 7):
        monkeypatch.setattr(minhash, "BLOCK", block)
        more = minhash.more_links(one, sketches.drop("doc_id"), none, rows.select("th", "text"), idf, 0.8).collect()
        assert {tuple(sorted((ids[r.a], ids[r.b]))) for r in more} == {(k, k + 40) for k in range(40)}
        assert len(more) == 40 and sum((r.a, r.b) not in led for r in more) >= 39
    # one bucket per text and class: nothing is left open
    done = spark.createDataFrame([(r.a, r.b) for r in more], "a long, b long")
    assert minhash.more_links(one, sketches.drop("doc_id"), done, rows.select("th", "text"), idf, 0.8).count() == 0


def test_rows_of_open_buckets_grow_with_the_members():
    """Texts that are all near each other leave one row each and a forest of links, not their pairs; a pair counts in its least key only."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
    m, long, keys = 60, minhash.FINE // 8, minhash.BANDS + minhash.SINGLES
    texts = [" ".join(edited(rng, base, 1)) for _ in range(m)]
    idf = np.ones(minhash.BUCKETS, np.float32)

    def batches(key, other):
        """All in one bucket of two blocks, which meet, with equal sketches; rows also share the bucket ``other``."""
        cols = [[key] * m, [0] * m, [1] * m, [k % 2 for k in range(m)], list(range(m)), list(range(m))]
        cols += [[9] * m for _ in range(len(minhash.SKETCH) + long)] + [[min(key, other)] * m, [max(key, other)] * m]
        cols += [[(1 << 63) - 1] * m for _ in range(keys - 2)]
        table = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols] + [pa.array(texts)], [f"c{k}" for k in range(len(cols))] + ["text"])
        return [table.slice(0, 25), table.slice(25, 30), table.slice(55)]      # a group may span batches
    met = [r for b in minhash._met(minhash.FINE_LEAST, long, True)(iter(batches(7, 8))) for r in b.to_pylist()]
    assert sorted(r["th"] for r in met) == list(range(m))                      # before: 900 pairs
    links = [(r["a"], r["b"]) for b in minhash._links(minhash.FINE_LEAST, long, idf, 0.8)(iter(batches(7, 8))) for r in b.to_pylist()]
    assert len(links) == m - 1 and {x for pair in links for x in pair} == set(range(m))
    assert not any(b.num_rows for b in minhash._met(minhash.FINE_LEAST, long, True)(iter(batches(7, 3))))
    assert not any(b.num_rows for b in minhash._links(minhash.FINE_LEAST, long, idf, 0.8)(iter(batches(7, 3))))


def test_near_classes_odd_rows(docs, wide, no_docs):
    rows = minhash.near_classes(docs).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.class_id, r.class_size].add(r.kept)
    assert len(rows) == docs.count()
    kept = minhash.drop_near_duplicates(wide)
    assert kept.columns == wide.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert len(ids) == len(set(ids)) and 4 in ids and not {5, 6, 7} & set(ids)
    assert kept.count() == sum(r.kept for r in rows)
    assert minhash.near_classes(no_docs).count() == 0 == minhash.drop_near_duplicates(no_docs).count()


def test_bit_table_holds_its_hashes(spark):
    inside = np.random.default_rng(4).integers(-(1 << 63), (1 << 63) - 1, 50_000)
    test = common.perhaps_in(spark.createDataFrame([(int(v),) for v in inside[:25_000]], "th long"))
    got = spark.createDataFrame([(int(v),) for v in inside], "th long").withColumn("ok", test(F.col("th"))).toPandas().set_index("th").ok
    assert got[inside[:25_000]].all() and not got[inside[25_000:]].mean() > 0.01


def shown_plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_texts_that_stay_are_not_shuffled(spark, monkeypatch, capsys):
    """Rows are told apart by hashes that are broadcast, or by a table of bits; only rows that go, or have copies, move."""
    rows = spark.createDataFrame([(k, "en", f"text {k % 90}") for k in range(100)] + [(7, "en", "text 7"), (None, "en", None), (None, "en", None)],
                                 "doc_id long, lang string, text string")
    decided = rows.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), (F.col("doc_id").isNull() | (F.col("doc_id") < 90)).alias("kept"))
    want = Counter([(k, f"text {k}") for k in range(90)] + [(None, None)])
    some = spark.createDataFrame([(k,) for k in range(50)], "th long")
    for most in (100, 0):
        monkeypatch.setattr(common, "BROADCAST_HASHES", most)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            kept = common.keep_rows(rows, decided, F.xxhash64(F.coalesce("text", F.lit(""))))
            plan = shown_plan(kept, capsys)
            assert Counter((r.doc_id, r.text) for r in kept.collect()) == want
            few, others = common.parted(spark.range(200).select(F.col("id").alias("th"), F.lit("text").alias("text")), some)
            assert set(range(50)) <= {r.th for r in few.collect()} and {r.th for r in others.collect()} <= set(range(50, 200))
            assert few.count() + others.count() == 200
            assert "Exchange hashpartitioning" not in shown_plan(few, capsys) + shown_plan(others, capsys)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert ("LeftAnti" in plan) if most else ("test(" in plan)


def test_near_classes_by_the_bit_table(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(60)) for _ in range(40)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, t + " one more") for k, t in enumerate(texts[:15])] + [(200, texts[0]), (200, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(minhash.near_classes(docs).select("doc_id", "class_id", "class_size", "kept").collect())
    left = sorted(minhash.drop_near_duplicates(docs).collect())
    assert [r.doc_id for r in left] == list(range(40))
    monkeypatch.setattr(common, "BROADCAST_HASHES", 0)
    assert sorted(minhash.near_classes(docs).select("doc_id", "class_id", "class_size", "kept").collect()) == want
    assert sorted(minhash.drop_near_duplicates(docs).collect()) == left


def test_samples_agree_with_the_similarity():
    rng = random.Random(2)
    base = [f"w{k}" for k in range(600)]
    texts = [" ".join(base), " ".join(edited(rng, base, 15)), " ".join(edited(rng, base, 60))]
    sh, w, first = minhash.weighted_sets(pa.array(texts), None)
    w = w * np.where(sh % np.uint64(2) == 0, 3.0, 0.5).astype(np.float32)
    hits, trials = Counter(), 40
    true = {}
    for t in range(trials):
        sig = minhash.sample(minhash.mix64(sh + np.uint64(t * 7919)) >> np.uint64(20), w, first)
        for k in (1, 2):
            hits[k] += int((sig[0] == sig[k]).sum())
    sets = [dict(zip(sh[first[k]:first[k + 1]].tolist(), w[first[k]:first[k + 1]].tolist())) for k in range(3)]
    for k in (1, 2):
        both = sum(min(v, sets[k].get(x, 0)) for x, v in sets[0].items())
        true[k] = both / (sum(sets[0].values()) + sum(sets[k].values()) - both)
        assert abs(hits[k] / (trials * minhash.BANDS * minhash.ROWS) - true[k]) < 0.06


# ---- passages

def test_compact_windows_against_brute_force():
    rng = np.random.default_rng(5)
    starts = np.array([0, 30, 30, 37, 90, 94])
    a = rng.permutation(1000)[:94].astype(np.uint64) + np.uint64(1)
    l, c, r = substring.compact_windows(a, starts, 8)
    got = sorted(zip(l.tolist(), c.tolist(), r.tolist()))
    want = set()
    for s, e in zip(starts[:-1], starts[1:]):
        for i in range(s, e):
            lo, hi = i, i
            while lo > s and a[lo - 1] > a[i]:
                lo -= 1
            while hi < e - 1 and a[hi + 1] > a[i]:
                hi += 1
            if hi - lo + 1 >= 8:
                want.add((lo, i, hi))
    assert got == sorted(want)


def test_passages_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"                   # noqa: E731
    docs = [[word() for _ in range(rng.randint(20, 300))] for _ in range(50)]
    shared, line = [word() for _ in range(50)], [word() for _ in range(30)]
    for k in range(0, 20):
        at = rng.randrange(len(docs[k]))
        docs[k] = docs[k][:at] + (shared if k < 12 else line) + docs[k][at:]
    docs[30] = edited(rng, docs[31], 1)
    docs[33] = docs[34][:200] * 1 + docs[33]
    docs[36] = (["loop"] * 3 + ["de", "lop"]) * 30
    docs[37] = ["x"] * 20 + (["loop"] * 3 + ["de", "lop"]) * 20
    docs += [docs[40], docs[40], docs[41][:10], docs[41][:10]]
    rows = [(k, " ".join(w)) for k, w in enumerate(docs)]
    found = defaultdict(list)
    for r in substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r.doc_id].append((r.start_word, r.end_word, r.class_id))
    at = defaultdict(set)
    for k, w in enumerate(docs):
        for i in range(len(w) - 49):
            at[tuple(w[i:i + 50])].add(k)
    need = defaultdict(set)
    for k, w in enumerate(docs):
        for i in range(len(w) - 49):
            if len(at[tuple(w[i:i + 50])]) > 1:
                need[k].add(i)
    for k, starts in need.items():
        assert all(any(a <= i and i + 50 <= b for a, b, _ in found[k]) for i in starts), k
    assert set(found) <= set(need) | {30, 31}
    assert not set(range(13, 20)) & set(found)                  # a shared line of 30 words is no passage
    assert {c for k in range(12) for _, _, c in found[k]} <= set(range(12))


def test_passage_classes_are_components(spark):
    rng = random.Random(12)
    fill = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]      # noqa: E731
    p, q, r = fill(60), fill(70), fill(70)
    mixed = fill(20) + q + r[:70] + fill(20)
    docs = {5 + 13 * k: fill(40) + p + fill(40) for k in range(9)}
    docs |= {200: mixed, 201: fill(30) + q + r[:20] + fill(9), 202: fill(30) + q[-20:] + r + fill(9), 203: q + fill(5), 204: fill(5) + r}
    docs |= {300: fill(90), 301: None}
    docs[301] = docs[300]
    got = defaultdict(list)
    for x in substring.repeated_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")).collect():
        got[x.doc_id].append((x.class_id, x.n_links, x.end_word - x.start_word))
    assert all(got[5 + 13 * k] == [(5, 8, 60)] for k in range(9))       # whoever led, one class
    assert got[300] == got[301] == [(300, 1, 90)]
    # q + 20 words of r and 20 words of q + r overlap by 40 words in 200: two passages, no link lost
    assert sorted(got[200]) == [(200, 2, 90), (200, 2, 90)]
    assert got[201] == [(200, 2, 90)] == got[202] and got[203] == [(200, 2, 70)] == got[204]


def passage_share(spark, rng, line_words, length, pairs, change, texts=3000):
    """Share of planted pairs that end in one class: texts with one common line, pairs with a passage that begins with it."""
    word = lambda: f"w{rng.randrange(10 ** 7)}"                # noqa: E731
    line = [word() for _ in range(line_words)]
    rows = []
    for k in range(pairs):
        passage = line + [word() for _ in range(length - line_words)]
        for copy in (passage, change(list(passage))):
            rows.append([word() for _ in range(30)] + copy + [word() for _ in range(30)])
    rows += [[word() for _ in range(30)] + line + [word() for _ in range(30)] for _ in range(texts - 2 * pairs)] if line else []
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], "doc_id long, text string").repartition(8)
    got = defaultdict(set)
    for r in substring.repeated_passages(df).collect():
        got[r.doc_id].add(r.class_id)
    assert not [k for k in got if k >= 2 * pairs]              # the line alone is no passage
    return sum(bool(got[2 * k] & got[2 * k + 1]) for k in range(pairs)) / pairs


def test_passages_behind_a_common_line(spark):
    """Word-for-word passages of which most is a line that thousands of texts share."""
    rng = random.Random(77)
    for line, length in ((40, 50), (46, 50), (46, 60)):
        share = passage_share(spark, rng, line, length, 200, lambda p: p)
        print(f"line {line}, passage {length}: {share}")
        assert share >= 0.99


def test_passages_with_an_edited_word(spark):
    rng = random.Random(78)

    def change(kind):
        def run(p):
            at = len(p) // 2
            return p[:at] + {"replace": ["edit"], "insert": ["edit", p[at]], "delete": []}[kind] + p[at + 1:]
        return run
    for kind in ("replace", "insert", "delete"):
        share = passage_share(spark, rng, 0, 60, 300, change(kind))
        print(f"{kind}: {share}")
        assert share >= 0.9


def test_pairs_do_not_depend_on_the_rows_held(monkeypatch):
    """One key longer than what is held at once: the same pairs as with all of it held."""
    rng = np.random.default_rng(15)
    n = 6000
    marks = rng.integers(0, 1 << 40, n, dtype=np.uint64) | (np.uint64(0xEE) << np.uint64(56))
    marks[rng.integers(0, n, 1500)] = marks[rng.integers(0, n, 1500)]
    key = np.where(np.arange(n) < 5000, 7, 8)
    table = pa.table({"key": pa.array(key), "th": pa.array(np.arange(n)), "marks": pa.array(marks.view(np.int64))})
    got = []
    for rows in (2_000_000, 4000, 1000):
        monkeypatch.setattr(substring, "HELD_ROWS", rows)
        got.append({p for b in substring._meet(iter(table.to_batches(max_chunksize=100))) for p in zip(*[c.to_pylist() for c in b.columns])})
    assert len(got[0]) > 500 and got[0] == got[1] == got[2]


def test_passages_that_their_leader_does_not_share(spark):
    """Passages of 62 words, one replaced, that begin with a line of 44 words that all 60 texts share: 28 of 30 pairs were found by leaders alone."""
    rng = random.Random(81)
    word = lambda: f"w{rng.randrange(10 ** 7)}"                # noqa: E731
    line, rows = [word() for _ in range(44)], []
    for _ in range(30):
        p = line + [word() for _ in range(18)]
        for copy in (p, p[:53] + ["edit"] + p[54:]):
            rows.append([word() for _ in range(30)] + copy + [word() for _ in range(30)])
    got = defaultdict(set)
    for r in substring.repeated_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], "doc_id long, text string")).collect():
        got[r.doc_id].add(r.class_id)
    assert dict(got) == {2 * k + e: {2 * k} for k in range(30) for e in (0, 1)}


def test_windows_that_agree_meet_whoever_leads():
    """One key, a leader that agrees with nobody: all pairs of agreeing windows of different classes come, with the leader alone none did."""
    rng = np.random.default_rng(16)
    n = 40
    around = rng.integers(0, 1 << 31, (n, 2 * substring.AROUND + 1), dtype=np.uint32) | np.uint32(1)
    marks = rng.integers(0, 1 << 56, n, dtype=np.uint64)
    around[21:], marks[21:] = around[1:20], marks[1:20]        # windows 1 + k and 21 + k are of one passage
    around[:, substring.AROUND] = 7
    marks |= np.uint64(0xEE) << np.uint64(56)
    th, root = np.arange(n), np.arange(n) + 100
    want = {(k, k + 20) for k in range(1, 20)}
    star = set(zip(*[a.tolist() for a in substring.star_pairs(np.full(n, 7), th, marks)[:2]]))
    agreeing = {p for i, j in substring.crossing(th, root, marks, th, th) for p in zip(i.tolist(), j.tolist()) if p[0] < p[1]}
    assert want <= agreeing and star <= agreeing
    assert [k for k in np.flatnonzero(substring.long_runs(around[1:20], around[21:]))] == list(range(19))
    assert not substring.long_runs(around[1:20], around[2:21]).any()
    zero = np.zeros(n, np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(a) for a in (zero + 7, zero, zero, zero, th, root, marks.view(np.int64))] + [
        pa.array([r.tobytes() for r in around], pa.binary())], ["key", "b1", "b2", "own", "th", "root", "marks", "text"])
    got = {p for b in substring._cross(iter([batch])) for p in zip(*[c.to_pylist() for c in b.columns])}
    assert got == want
    root[21:] = root[1:20]                                     # of one class: they have met
    batch = batch.set_column(5, "root", pa.array(root))
    assert not sum(b.num_rows for b in substring._cross(iter([batch])))


def test_a_run_meets_its_first_text():
    """Texts that share a run of words are joined through it, whatever else their windows hold."""
    rng = random.Random(80)
    fill = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))      # noqa: E731
    runs = [fill(55) for _ in range(3)]
    texts = [f"{fill(30)} {runs[k % 3]} {fill(30)}" for k in range(12)]
    table = pa.RecordBatch.from_pydict({"th": pa.array(range(12), pa.int64()), "text": pa.array(texts)})
    rows = [r for b in substring._runs(iter([table]), np.zeros(1 << 18, bool), lambda h: np.ones(len(h), bool)) for r in zip(*[c.to_pylist() for c in b.columns])]
    table = pa.table(dict(zip(("run", "th"), zip(*sorted(rows)))), schema=pa.schema([("run", pa.int64()), ("th", pa.int64())]))
    for size in (1000, 7, 1):
        got = {p for b in substring._first_holders(iter(table.to_batches(max_chunksize=size))) for p in zip(*[c.to_pylist() for c in b.columns])}
        assert got == {(k % 3, k) for k in range(3, 12)}


def test_passages_odd_rows(docs, wide, no_docs):
    a = sorted(map(tuple, substring.repeated_passages(docs).collect()))
    assert a == sorted(map(tuple, substring.repeated_passages(wide).collect()))
    assert {4, 5, 6, 7} <= {r[0] for r in a} and not {1, 2, 3, 8, 9} & {r[0] for r in a}
    assert substring.repeated_passages(no_docs).count() == 0


# ---- vectors

def test_vectors_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = []
    for label in (1, 2, -3):
        centers = rng.normal(size=(40, 64))
        for k in range(420):
            v = centers[k % 40] + rng.normal(size=64) * rng.choice([0.05, 0.15, 0.25, 0.4])
            rows.append([float(x) for x in v.astype(np.float32)])
    rows = [(k, v, (1, 2, -3)[k // 420]) for k, v in enumerate(rows)]
    hot = rows[0][1]
    rows += [(5000 + k, [x * (1 + k) for x in hot], 1) for k in range(400)] + [(6000, hot, 1), (6000, hot, 1), (6001, hot, None)]
    rows += [(7000, None, 1), (7001, [0.0] * 64, 1), (7002, [float("nan")] * 64, 1), (7003, [float("nan")] * 64, 1),
             (7004, [None] + [1.0] * 63, 1), (7005, [], 1), (7006, [1.0, 0.0], 1), (7007, [2.0, 0.0], 1), (7008, [float("inf")] * 64, 1),
             (None, [3.0, 0.1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = vectors.link_vectors(df).collect()
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) and lab is not None
            for _, v, lab in rows]
    unit = [np.array(v, float) / np.linalg.norm(v) if g else None for (_, v, _), g in zip(rows, good)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if good[i] and good[j] and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.93]
    n = Counter(x for p in links for x in p)
    par = classes(links, range(len(rows)))
    low = defaultdict(list)
    for i, r in par.items():
        if rows[i][0] is not None:
            low[r].append(rows[i][0])
    want = Counter((rows[i][0], n[i], min(low[par[i]]) if low[par[i]] else None) for i in range(len(rows)))
    have = Counter((r.vec_id, r.n_links, r.component_id) for r in got)
    found, all_ = sum(r.n_links for r in got), 2 * len(links)
    assert len(got) == len(rows) and 0.99 * all_ <= found <= all_
    assert sum((have - want).values()) <= 0.02 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert vectors.link_vectors(df.limit(0)).count() == 0


def test_estimate_is_unbiased_and_bounded():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotated, f = vectors.encode(x)
    est = (np.sign(rotated) / 8) @ rotated.T / f[:, None]
    true = x @ x.T
    off = ~np.eye(400, dtype=bool)
    err = (est - true)[off]
    bound = (vectors.EPSILON * np.sqrt((1 - f ** 2) / f ** 2 / 63))[:, None].repeat(400, 1)[off]
    assert abs(err.mean()) < 0.002 and (np.abs(err) <= bound).mean() > 0.998


def test_samples_do_not_depend_on_runs(monkeypatch):
    """Samples drawn in cache-sized runs are those of the plain statement over all shingles."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{v}" for v in rng.integers(0, 60, n)) for n in (0, 1, 3, 4, 5, 6, 400, 2, 90, 0, 33)]
    sh, tf, first = minhash.weighted_sets(pa.array(texts), None)
    idf = minhash.idf_table(100, np.full(minhash.BUCKETS, 3))
    w = tf * idf[minhash.bucket(sh)]

    def plain(k: int, text: int) -> int:
        s, log_w = sh[first[text]:first[text + 1]], np.log(w[first[text]:first[text + 1]])
        if not len(s):
            return 0
        x = (s + minhash.ADD[k]) * minhash.ODD[k]
        x ^= x >> np.uint64(29)
        x *= minhash.ODD[-1 - k]
        x ^= x >> np.uint64(32)
        r, b = minhash.RATE[x >> np.uint64(48)], ((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float32) / np.float32(65536)
        t = np.floor(log_w / r + b)
        a = minhash.LOG_C[(x >> np.uint64(32)) & np.uint64(0xFFFF)] - r * (t - b + 1)
        low = (x ^ (x >> np.uint64(20)) ^ (t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B1))) & np.uint64(0xFFFFFFFF)
        return min(zip(a.tolist(), low.tolist()))[1]
    want = [[plain(k, text) for k in range(len(minhash.ODD))] for text in range(len(texts))]
    for run in (1, 50, 1 << 17):
        monkeypatch.setattr(minhash, "RUN", run)
        assert minhash.sample(sh, w, first).tolist() == want
