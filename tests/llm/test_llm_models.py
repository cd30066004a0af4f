"""Language identification, page text, mixing, packing and the pipeline."""

import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gazette.llm import html_extract, html_labelled, langid, mixing, packing
from gazette.llm.common import table

TOKENIZER = __import__("public_tokenizers").path("byte_bpe_50k.json")


# ---- language identification

@pytest.fixture(scope="module")
def net(spark):
    return langid.train_langid(table(spark, "/root/testdata/sf0.01", "documents"))


def test_held_out_accuracy(spark, net):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    r = langid.identify(d, net).join(d.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(r) == d.count() and r.score.between(0, 1).all()
    assert (r.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in r.doc_id]).all()
    held = r[r.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98


def test_tables_equal_the_network(net):
    rng = np.random.default_rng(1)
    x = langid.windows(bytes(rng.integers(0, 256, 3000, dtype=np.uint8)))
    h, _, _ = net._forward(x)
    slow = langid.softmax(h @ net.w["O"] + net.w["o"])
    assert np.allclose(slow, net.probabilities(x, net.tables()), atol=1e-4)


def test_gradients():
    net = langid.Net(["a", "b"], seed=1)
    x = langid.windows(b"the quick brown fox jumps over the lazy dog " * 10)
    y = np.array([0, 1])[:len(x)]
    losses = []
    for _ in range(2):
        p = net.predict([b"the quick brown fox jumps over the lazy dog " * 10], net.tables())[0]
        losses.append(-np.log(p[0]))
        net.train(x, np.zeros_like(y), epochs=5)
    assert losses[1] < losses[0]


def test_langid_odd_rows(spark, docs, wide, no_docs, net):
    r = {(x.doc_id): x for x in langid.identify(docs, net).collect()}
    assert r[1].lang_pred == r[2].lang_pred == r[9].lang_pred == r[13].lang_pred == "und" and r[1].score == 0
    assert r[4].lang_pred in net.langs and r[10].lang_pred in net.langs
    kept = langid.accepted(wide, net=net)
    assert kept.columns == wide.columns
    assert not {1, 2, 9, 13} & {x["doc_id"] for x in kept.collect()}
    assert langid.identify(no_docs).count() == 0 and langid.accepted(no_docs).count() == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {x.lang_pred for x in langid.identify(none).collect()} == {"und"}


def test_whole_text_counts(net):
    langs = net.langs
    d = {"de": "der und die schen keit ung ", "en": "the and of thing tion that "}
    long = (d["en"] * 40 + d["de"] * 400).encode()
    p = net.predict([long], net.tables())[0]
    assert langs[p.argmax()] == "de"


# ---- page text

def test_every_language_is_learned(spark):
    rows = [(100 * k + n, f"word{k} text{n}", f"l{k:03}") for k in range(150) for n in range(90 if k < 70 else 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = Counter(r[0] for r in langid.training_rows(df))
    assert len(got) == 150
    few = Counter(r[0] for r in langid.training_rows(df, most=1000))
    assert set(few) == set(got) and max(few.values()) < max(got.values()) and all(few[x] == got[x] for x in got if got[x] < 20)


def test_elements_that_swallow_no_text():
    texts = lambda page: [n.text for n in html_extract.parse(page) if n.text is not None]      # noqa: E731
    assert texts("<article><p>One <svg class=icon /> two.</p><p>Three.</p></article>") == ["One two.", "Three."]
    assert texts("<p>One <svg><title/><g><text>label</text></g></svg> two.</p><p>Three.</p>") == ["One two.", "Three."]
    assert texts("<p>One <svg class=a/><text>label</text></svg> two.</p>") == ["One two."]
    assert texts("<p>If <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> then <math /> so.</p><p>End.</p>") == [
        "If x=1 then so.", "End."]
    assert texts("<div><object data=a><p>Fallback.</p></object><p>After.</p></div>") == ["Fallback.", "After."]
    assert texts("<div><object data=a><p>After.</p></div><p>End.</p>") == ["After.", "End."]
    assert texts("<div>One <select><option>A<option>B</select> two.<p>Three.</p></div>") == ["One two.", "Three."]
    assert texts("<div><p>One.</p><select><option>A<p>Two.</p></div><p>End.</p>") == ["One.", "Two.", "End."]
    assert texts("<div><select><option>A</div>Two.") == ["Two."]
    assert texts("<p>One.</p><noscript><p>Two.</p><p>Three.</p>") == ["One.", "Two.", "Three."]
    assert texts("<p>One.</p><template><p>Two.</p></template><script>x</script><p>Three.</p>") == ["One.", "Three."]


def test_blocks_of_held_out_layouts():
    model, right, total = html_extract.trained_model(), 0, 0
    for page in html_labelled.pages(60, seed=77):
        nodes = html_extract.parse(page)
        for v, p in zip(nodes, model.marginals(nodes)):
            if v.text is not None:
                right += (p >= 0.5) == bool(v.y)
                total += 1
    assert right / total > 0.97


def test_only_guesses_are_rejected(docs):
    """Relative to the number of languages: of two a score of 0.5 is a guess, of forty 0.2 is not."""
    def scored(k, lift):
        net = langid.Net([f"l{i:02}" for i in range(k)])
        net.w["O"][:], net.w["o"][0] = 0, np.log(lift)
        return net
    letters = [r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)]
    for k, lift, kept in ((2, 1.0, False), (2, 9.0, True), (40, 1.0, False), (40, 10.0, True), (1, 1.0, True)):
        got = [r.doc_id for r in langid.accepted(docs, net=scored(k, lift)).collect()]
        assert Counter(got) == Counter(letters if kept else []), (k, lift)


# a family of layouts that no training page uses: other elements, other orders, names in camelCase
HELD_OUT = (
    '<body><div class="siteNavBar"><a href="/">Start</a> <a href="/w">World</a> <a href="/c">Culture</a></div><div class="cookieBanner">We store '
    'small files on your device, read how. <button>Fine</button></div><main><h2 y>A walk in the hills</h2><p y>The first hour leads through '
    'woods, and the path is wet until June.</p><dl><dt y>Length</dt><dd y>Nine km</dd><dt y>Climb</dt><dd y>300 m</dd></dl><section><h3 y>Way back'
    '</h3><p y>Buses leave every hour.</p></section></main><div class="relatedLinks"><a href="/1">Ten huts to see</a><a href="/2">Boots</a></div>'
    '<p>Copyright 2024</p></body>',
    '<body><header><a href="/">The Valley Post</a></header><article><h1 y>Bread</h1><figure><img src="b.png"><figcaption y>A loaf from Monday.'
    '</figcaption></figure><p y>You need few things, but good ones, and some time.</p><ul><li y>One</li><li y>Two</li></ul><p y>See also:</p><ul>'
    '<li y><a href="/f">Kinds of flour</a></li><li y><a href="/o">Ovens</a></li></ul><table><tr><th y>Part</th><th y>Grams</th></tr><tr>'
    '<td y>Water</td><td y>300</td></tr></table></article><section><h3>2 answers</h3><div><p><b>Ida</b> wrote:</p><p>I tried it on Sunday, '
    'and it worked very well for us.</p></div></section><footer><p>All rights reserved.</p></footer></body>',
    '<body><div><a href="/">Home</a> <a href="/f">Forum</a> <a href="/m">Maps</a></div><main><section><h1 y>Night trains</h1><p y>They are back'
    ', although slower than forty years ago.</p><blockquote><p y>I slept from border to border.</p></blockquote></section></main><aside><p>Win a '
    'ticket, today only!</p></aside><div>&copy; 2023 Rail Letter</div></body>')


def test_a_family_of_layouts_held_out_of_training():
    model, wrong = html_extract.trained_model(), []
    for page in HELD_OUT:
        nodes = html_extract.parse(page)
        wrong += [v.text for v, p in zip(nodes, model.marginals(nodes)) if v.text is not None and (p >= 0.5) != bool(v.y)]
    assert not wrong


def article(page):
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?(?:b|br|i)>", " ", inner))
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_pages_of_the_small_table(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = html_extract.extract(pages).toPandas().set_index("page_id")
    raw = pages.toPandas().set_index("page_id").html
    good = [i for i in raw.index if "<article>" in raw[i] and "</article>" in raw[i]]
    assert len(good) > 200
    assert [got.text[i] for i in good] == [article(raw[i]) for i in good]
    assert (got.n_chars == got.text.map(len)).all()


def test_marginals_against_enumeration():
    import itertools
    import math
    model = html_extract.trained_model()
    nodes = html_extract.parse("<div class='menu'><p>Home</p></div><article><h1>A title</h1><p>Some text, long enough.</p></article>")
    n, z, total = len(nodes), 0.0, np.zeros(len(nodes))
    for y in itertools.product((0, 1), repeat=n):
        e = sum(model.w[f] for i, v in enumerate(nodes) if y[i] for f in v.feats)
        e += sum(model.pair[0 if v.text is None else 1][y[v.parent], y[i]] for i, v in enumerate(nodes) if v.parent >= 0)
        z += math.exp(e)
        total += math.exp(e) * np.array(y)
    assert np.allclose(total / z, model.marginals(nodes), atol=1e-6)


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p"), (4, "u", "no tags at all, just a sentence. " * 5), (5, "u", "<!-- <p>x</p>"),
            (6, "u", "<article><p>A &amp; b &lt;c&gt;<script>var t='</p>'</script> d<p>Second,\n\t part.<!-- c --> End.</article>"),
            (7, "u", "<div " + "x" * 5000), (8, "u", "<article>" + "<div>" * 3000 + "<p>Deep text, but still text.</p>"),
            (6, "u", "<article><p>A &amp; b &lt;c&gt;<script>var t='</p>'</script> d<p>Second,\n\t part.<!-- c --> End.</article>")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(0))
    got = html_extract.extract(d).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == by[5].text == "" and by[1].n_chars == 0
    assert by[6].text == "A & b <c> d\nSecond, part. End."
    assert by[8].text == "Deep text, but still text."
    assert html_extract.extract(d.limit(0)).count() == 0


# ---- mixing

def plain_targets(sizes):
    """The rule as stated: shares by weight, capped, the excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check_mix(df, docs):
    got = mixing.mix(docs).toPandas()
    rows = docs.collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))     # noqa: E731
    assert sorted(got["size"]) == sorted(count(r["text"]) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += count(r["text"])
    want = plain_targets(sizes)
    got["src"] = [None if pd.isna(s) else s for s in got.source]
    for s, t in want.items():
        part = got[got.src.map(lambda v, s=s: v == s or (v is None and s is None))]
        assert np.allclose(part.target, t) and (part.source_size == sizes[s]).all()
        assert (part.taken <= 2 * part["size"]).all()
    return got, want


def test_mix_on_the_small_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got, want = check_mix(None, docs)
    taken = got.groupby("source").taken.sum()
    assert max(abs(taken[s] - t) for s, t in want.items()) < 60
    again = mixing.mix(docs.repartition(5)).toPandas()
    key = ["doc_id", "taken"]
    assert sorted(map(tuple, again[key].to_numpy())) == sorted(map(tuple, got[key].to_numpy()))
    rows = mixing.mix_rows(docs)
    assert rows.columns == docs.columns and rows.count() == got.copies.sum()


def test_mix_through_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 20)
    monkeypatch.setattr(mixing, "FAN", 3)
    docs = table(spark, "/root/testdata/sf0.01", "documents").withColumn("source", F.when(F.col("doc_id") < 700, "hot").otherwise("other"))
    got, want = check_mix(None, docs)
    taken = got.groupby("source").taken.sum()
    assert max(abs(taken[s] - t) for s, t in want.items()) < 60


def test_flight_keeps_totals_and_expectation():
    rng = np.random.default_rng(1)
    size = rng.integers(0, 60, 90).astype(float)
    pi = np.full(90, 0.3)
    mean = np.zeros(90)
    for k in range(400):
        out = mixing.flight(size, pi, np.random.default_rng(k))
        assert abs(out.sum() - pi.sum()) < 1e-6 and abs(out @ size - pi @ size) < 1e-5
        assert ((out > 0) & (out < 1)).sum() <= 2
        mean += out / 400
    assert abs(mean - 0.3).max() < 0.12


def test_mix_odd_rows(docs, wide, no_docs):
    check_mix(None, docs)
    out = mixing.mix_rows(wide)
    assert out.columns == wide.columns
    assert out.count() == mixing.mix(docs).agg(F.sum("copies")).first()[0]
    assert mixing.mix(no_docs).count() == 0 and mixing.mix_rows(no_docs).count() == 0
    empty = docs.withColumn("text", F.lit(""))
    assert mixing.mix(empty).agg(F.sum("taken")).first()[0] == 0


# ---- packing

def check_pack(df, docs, capacity):
    p = df.toPandas()
    e = packing.encoder(TOKENIZER)
    texts = Counter((r["doc_id"], e.whole(r["text"] or "") + b"\0\0\0\0") for r in docs.collect())
    pieces = Counter()
    for (doc, raw), times in texts.items():
        total = len(raw) // 4
        k = -(-total // capacity)
        first = total - (k - 1) * capacity
        cuts = [0] + [first + i * capacity for i in range(k)]
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            pieces[(doc, i, a, b - a, zlib.crc32(raw[4 * a:4 * b]))] += times
    got = Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in p.itertuples())
    assert got == pieces
    s = p.sort_values(["sequence_id", "offset"])
    assert (s.groupby("sequence_id").length.cumsum() - s.length == s.offset).all()
    assert p.groupby("sequence_id").length.sum().max() <= capacity
    return p


def test_pack_odd_rows(docs, wide, no_docs):
    check_pack(packing.pack(docs, TOKENIZER, 256), docs, 256)
    check_pack(packing.pack(wide.repartition(6), TOKENIZER, 2048), docs, 2048)
    assert packing.pack(no_docs, TOKENIZER).count() == 0


def test_pack_is_tight_and_merges(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 16)
    docs = table(spark, "/root/testdata/sf0.01", "documents").repartition(40)
    p = check_pack(packing.pack(docs, TOKENIZER, 2048), docs, 2048)
    least = p.length.sum() / 2048
    assert p.sequence_id.nunique() <= 1.03 * least + 1
    ids = packing.pack(docs, TOKENIZER, 2048, with_ids=True).select("length", "ids_crc32", "ids").toPandas()
    assert [zlib.crc32(b) for b in ids.ids] == list(ids.ids_crc32)
    assert [len(b) // 4 for b in ids.ids] == list(ids.length)


def test_encoder_equals_the_tokenizer():
    e, rng = packing.Encoder(TOKENIZER), random.Random(5)
    letters = list("abcXYZ019 .,'!?_-\n\t\r") + [" ", " ", "  ", "   ", "'s", " 're", "é", "ß", "Ü", "ª", "²", "漢", "😀", " ", " ", "…",
                                                  "’", "\x1c", "<|endoftext|>", "Ⅷ", "ˇ", "Ж"]
    for k in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 25)))
        assert e(t) == e.whole(t), repr(t)


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 101, 500)
    bins, offsets, fill = packing.best_fit(lengths, 100)
    room = []
    for k in np.argsort(-lengths, kind="stable"):
        fits = [(r, b) for b, r in enumerate(room) if r >= lengths[k]]
        if fits:
            best = min(r for r, _ in fits)
            b = next(b for r, b in fits if r == best)
            room[b] -= lengths[k]
        else:
            room.append(100 - lengths[k])
    assert sorted(100 - f for f in fill) == sorted(room)
    assert all(sum(lengths[bins == b]) == f for b, f in enumerate(fill))


def test_encoder_keeps_a_bounded_table(monkeypatch):
    """Parts that come again stay in the table, the others go; ids do not depend on it."""
    monkeypatch.setattr(packing, "CACHE", 20)
    e = packing.Encoder(TOKENIZER)
    for k in range(60):
        text = "a common part " + " ".join(f"x{k}y{j}" for j in range(7))
        assert e(text) == e.whole(text)
        assert len(e.known) + len(e.old) <= 2 * (20 + 10) and "common" in e.known | e.old
    assert len(e.old) > 0


def test_parts_are_encoded_many_at_once(monkeypatch):
    """Merges of many words at once give the model's ids, and the model is asked for none of the short parts."""
    e, rng = packing.Encoder(TOKENIZER), random.Random(6)
    letters = list("aabcdeeehilnorsttuXYZ0192__--.,'!?()\n\t") + ["'s", "'re", "é", "ß", "漢", "😀", "\xa0", "ing", "tion", "the"]
    parts = ["", " ", "a", "\n", "'", " '", " 's", "_a", " _"] + [
        rng.choice(["", " "]) + "".join(rng.choice(letters) for _ in range(rng.randrange(0, 17))) for _ in range(4000)]
    long = [" " + "na" * 40, "é" * 40, "x" * 3000]
    want = [e.split(p) for p in parts]
    assert e.split_all([*long, *parts, *long]) == [*map(e.split, long), *want, *map(e.split, long)]
    assert e.split_all([]) == [] and e.split_all([""]) == [b""]
    short = [p for p in parts if len(p) <= 16]
    kept = [w for p, w in zip(parts, want) if len(p) <= 16]
    monkeypatch.setattr(packing.Encoder, "split", None)
    assert e.split_all(short) == kept


def test_texts_are_encoded_many_at_once():
    e, rng = packing.Encoder(TOKENIZER), random.Random(7)
    words = ["a", "the", "of", "Ünit", "x1", "don't", "end.", "\n", "two\nlines", "<|endoftext|>", "", "漢字", "long" * 30]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 30))) for _ in range(300)] + ["", " ", "  "]
    assert e.encode(texts) == [e.whole(t) for t in texts] and e.encode([]) == []
