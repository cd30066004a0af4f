"""Cross-tokenizer alignment against whole-text tokenizations."""

import bisect
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from gazette.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_chars():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    more = [x for x in range(256) if x not in keep]
    return {chr(x): x for x in keep} | {chr(256 + i): x for i, x in enumerate(more)}


@pytest.fixture(scope="module")
def plain():
    tok, sp, chars = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), byte_chars()
    tok.encode_special_tokens = True

    def one(text):
        """Groups of one text, or none."""
        if not text:
            return []
        want = b" " + text.encode()
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        pa = [bytes(chars[c] for c in tok.id_to_token(i)) for i in a]
        pb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(pa) != want or b"".join(pb) != want:
            return []
        ends = []
        for parts in (pa, pb):
            at, e = 0, []
            for p in parts:
                at += len(p)
                e.append(at)
            ends.append(e)
        common = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in common]
        for side, ids in enumerate((a, b)):
            for x, e in zip(ids, ends[side]):
                groups[bisect.bisect_left(common, e)][side].append(x)
        return groups

    def table(rows):
        docs = [(i, one(t)) for i, t in rows]
        links = []
        for _, g in docs:
            c = Counter()
            for a, b in g:
                for x, n in Counter(a).items():
                    for y, m in Counter(b).items():
                        c[x, y] += n * m
            links.append(c)
        count = Counter(p for c in links for p in c)
        best = defaultdict(int)
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        out = []
        for (i, g), c in zip(docs, links):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                        sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
                        hashlib.sha256(text.encode()).hexdigest() if g else ""))
        return out
    return table


SPECIAL = ["<|endoftext|> in a text", "a ▁ b", "½ ﬁ ligature", "tab\tand\nlines\r\n and  two   spaces ", " leading", "trailing ", " no break",
           "he said 'tis 12345678901234567890 ...!!!??? --- ===", "漢字かな交じり文 と 空白", "😀😀 👩‍👩‍👧 éé", "x" * 300, "\0 nul \0", "ab " * 200,
           "1" * 500, "a​b c", "don't we'll I'm ' s", "﷽ ﷽﷽"]


def key(r):
    return (r[0] is not None, r[0] or 0, r[1:])


def got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.select(*NAMES).collect()), key=key)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()] + [(100 + k, t) for k, t in enumerate(SPECIAL)]


@pytest.fixture(scope="module")
def want(plain, rows):
    return sorted(plain(rows), key=key)


def test_alignment_of_odd_rows(spark, rows, want):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(alignment.alignment_digest(df, A, B)) == want


@pytest.mark.parametrize("size", [7, 40])
def test_fragments_of_any_range_compose_to_the_same(spark, rows, plain, size):
    """Every text above 20 bytes is cut into ranges, at places where no token ends as well."""
    some = [(i, t[:1500] if t else t) for i, t in rows]
    df = spark.createDataFrame(some, "doc_id long, text string")
    assert got(alignment.alignment_digest(df, A, B, size=size, long=20)) == sorted(plain(some), key=key)


def test_open_ends_are_met(rows):
    """Ranges do leave open prefixes and suffixes."""
    al = alignment.aligner(A, B)
    text = "\n".join(t for _, t in rows if t)[:5000]
    units = al.cut.split(text)
    made = [alignment.fragment(al, " ".join(units[i:j]), at, lo, hi) for lo, hi, i, j, at in alignment.byte_ranges(units, 9)]
    assert any(f["cut"] and (f["sa"] or f["sb"]) for f in made)


@pytest.mark.parametrize("fan_in", [2, 3, 8])
def test_composition_is_associative(spark, fan_in):
    """Random fragments, all-open ones among them: any tree closes the groups that one pass closes."""
    rng = random.Random(5)
    rows, want = [], []
    for rid in range(12):
        a, b = [], []
        for k in range(rng.choice([1, 2, 7, 8, 9, 30])):
            cut = rng.random() < 0.5
            ids = [[rng.randrange(99) for _ in range(rng.randrange(3))] for _ in range(4)]
            rows.append((rid, k, cut, ids[0], ids[1], *(ids[2:] if cut else ([], []))))
            a, b = a + ids[0], b + ids[1]
            if cut:
                want.append((rid, k, a, b))
                a, b = ids[2], ids[3]
    df = spark.createDataFrame(rows, "rid long, k int, cut boolean, pa array<int>, pb array<int>, sa array<int>, sb array<int>")
    assert sorted(map(tuple, alignment.reduce_fragments(df, fan_in).select("rid", "k", "a", "b").collect())) == sorted(want)


def test_pairs_without_broadcast(spark, rows, want, monkeypatch):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 0)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(alignment.alignment_digest(df, A, B)) == want


def test_unit_table_that_starts_anew(rows, monkeypatch):
    al = alignment.Aligner(A, B)
    texts = [al.cut.split(t) if t else [] for _, t in rows]
    once = list(al.closed(texts))
    monkeypatch.setattr(alignment, "CACHE", 50)
    monkeypatch.setattr(alignment, "WIDE", 2)
    again = [r for t in texts for r in al.closed([t])]

    def plain(r):
        return r and (*r[:4], *(x.tolist() for x in r[4:]))
    assert [plain(r) for r in once] == [plain(r) for r in again]


def test_clashing_columns_and_no_rows(spark, wide, docs, no_docs):
    names = wide.withColumns({c: wide["lang"] for c in ("n_a", "keys", "mults", "k", "closed", "groups_sha256", "best", "docs")})
    assert got(alignment.alignment_digest(names, A, B)) == got(alignment.alignment_digest(docs, A, B))
    assert alignment.alignment_digest(no_docs, A, B).count() == 0


def test_small_table(spark, plain):
    from __spark_entry__ import queries
    sf = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries()["op13_alignment"](spark, sf)) == sorted(plain(rows), key=key)
