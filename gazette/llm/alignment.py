"""Alignment of two tokenizations of the same text by an associative fragment monoid.

Tokenizer A (byte-level BPE) reads a space and the text; tokenizer B (pieces with byte fallback) reads the text and puts the
space before it itself.  Byte offsets where a token of A and a token of B both end cut the tokens into groups.  A byte range
of a text is a fragment: an open prefix (tokens up to its first common end), closed groups, and an open suffix (tokens after its
last common end); a range without a common end is all open.  Two neighbouring fragments compose: the suffix of the
left and the prefix of the right are one group.  Composition is associative, so texts above ``LONG`` bytes are cut into ranges of
``RANGE`` bytes that different tasks tokenise and fold, and the open ends (a few ids) are tree-reduced with a bounded fan-in;
closed groups stay where they are.  A shorter text is one fragment that is folded in its task.

Neither tokenizer joins what a single space between two visible characters separates (a piece of B with a space after another
character would forbid that, and then texts are never cut), so the text between two such spaces, a unit, has the same tokens
alone as in its text.  A range is tokenised with the units that its two ends cut, and keeps the tokens that end in it.  A range border inside a unit
longer than ``RANGE`` is left out, so no unit is tokenised more than twice.  Units seen before are looked up in a table
per worker, which starts anew at ``CACHE`` entries.

The document count of an id pair comes from the texts' distinct pairs (partial counts per task).  Its table is broadcast up to
``BROADCAST_PAIRS`` pairs (12 bytes each) and joined beyond.

Defined cases: null and empty texts and texts whose joined token bytes of A or B differ from space and text have zeros and an empty
``groups_sha256``; they count no pairs.  Repeated rows are documents of their own, in the counts as well; ties for the highest count
all count as best; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import land, text_or_empty
from gazette.llm.packing import LETTERS

RANGE, LONG = 32_768, 65_536
CACHE = 250_000
FAN_IN = 8
BROADCAST_PAIRS = 3_000_000
FLUSH = 4_000_000
# groups of up to so many links are linked token by token, wider ones by the counts of their ids
WIDE = 256
# a single space between visible characters: words, digits and ASCII signs
CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
NEVER = re.compile(r"(?!)")
VISIBLE = re.compile(r"[\w!-~]{2}")
JOINED = 64                                      # units in one call of A

_LOADED: dict = {}


def cut_groups(a: list[int], ends_a: list[int], b: list[int], ends_b: list[int]) -> tuple[list, tuple[int, int]]:
    """Groups (ids of A, ids of B) closed by a common end, and how many tokens of A and B they take."""
    out, i, j, from_i, from_j = [], 0, 0, 0, 0
    while i < len(a) and j < len(b):
        if ends_a[i] < ends_b[j]:
            i += 1
        elif ends_a[i] > ends_b[j]:
            j += 1
        else:
            i, j = i + 1, j + 1
            out.append((a[from_i:i], b[from_j:j]))
            from_i, from_j = i, j
    return out, (from_i, from_j)


def shown(group: tuple[list[int], list[int]]) -> str:
    return ",".join(map(str, group[0])) + "|" + ",".join(map(str, group[1]))


class Aligner:
    """Both tokenizers, and the table of known units."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {c: k for k, c in LETTERS.items()}
        added = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.bytes_a = [added.get(i, b"") if i in added or i not in names else bytes(byte_of[c] for c in names[i])
                        for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_b = len(pieces)
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.signed = [f"{i}{sign}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for sign in ",|;"]
        self.cut = NEVER if any(re.search("[^▁]▁", p) for p in pieces) else CUT
        self.forget()

    @property
    def key_type(self) -> str:
        """Id pairs are numbered a * size_b + b."""
        return "int" if len(self.bytes_a) * self.size_b < 2 ** 31 else "long"

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.shown: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)                   # n_a, n_b, n_groups (-1: bytes differ), entries in pairs
        self.pairs, self.mults = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def tokens(self, units: list[str]) -> list[tuple[list[int], list[int], list[int], list[int]] | None]:
        """Per unit (which follows a space) ids and byte ends of both; None where the bytes differ from space and unit."""
        out = []
        for u, x, b in zip(units, self.a.encode_batch([" " + u for u in units], add_special_tokens=False), self.b.encode(units, num_threads=1)):
            a = x.ids
            parts_a, parts_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
            want = b" " + u.encode()
            if b"".join(parts_a) != want or b"".join(parts_b) != want:
                out.append(None)
                continue
            ends_a, ends_b, at = [], [], 0
            for p in parts_a:
                at += len(p)
                ends_a.append(at)
            at = 0
            for p in parts_b:
                at += len(p)
                ends_b.append(at)
            out.append((a, ends_a, b, ends_b))
        return out

    def pair_counts(self, groups: list) -> Counter:
        """How often each pair is linked: occurrence pairs inside a group, from the ids' counts."""
        found: Counter = Counter()
        for a, b in groups:
            if len(a) == len(b) == 1:
                found[a[0] * self.size_b + b[0]] += 1
                continue
            of_b = Counter(b)
            for x, n in Counter(a).items():
                for y, m in of_b.items():
                    found[x * self.size_b + y] += n * m
        return found

    def _ids_a(self, units: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A of all units, and how many each has.  Units that start and end with a visible character are tokenised many at a time, a
        space between them; where they end follows from the bytes."""
        texts, held = [], []
        for u in units:
            if held and len(held) < JOINED and VISIBLE.fullmatch(u[0] + held[-1][-1:]):
                held.append(u)
            else:
                if held:
                    texts.append(" " + " ".join(held))
                held = [u]
        if held:
            texts.append(" " + " ".join(held))
        got = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(got), np.int64, sum(map(len, got)))
        at, ends = np.cumsum(self.len_a[flat]), np.cumsum(size)
        upto = np.searchsorted(at, ends, "right")
        if len(at) and (at[upto - 1] == ends).all():
            return flat, np.diff(upto, prepend=0)
        got = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]    # A does not keep all bytes
        many = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int64, int(many.sum())), many

    def _ids_b(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.b.encode(units, num_threads=1)
        many = np.fromiter(map(len, got), np.int64, len(units))
        return np.fromiter(chain.from_iterable(got), np.int64, int(many.sum())), many

    def learn(self, units: set[str]) -> None:
        new = [u for u in units if u not in self.number]
        if len(new) + len(self.number) > CACHE and self.number:
            self.forget()
            new = list(units)
        if not new:
            return
        want = [b" " + u.encode() for u in new]
        size = np.fromiter(map(len, want), np.int64, len(new))
        stream = b"".join(want)
        sides, good = [], np.ones(len(new), bool)
        for flat, many, table, length in (*self._ids_a(new, size), self.bytes_a, self.len_a), (*self._ids_b(new), self.bytes_b, self.len_b):
            of = np.repeat(np.arange(len(new)), many)
            joined = b"".join([table[i] for i in flat.tolist()])
            if joined != stream or (np.bincount(of, length[flat], len(new)) != size).any():
                cuts = np.concatenate([[0], np.cumsum(many)]).tolist()
                ids = flat.tolist()
                good &= np.array([b"".join([table[i] for i in ids[x:y]]) == w for x, y, w in zip(cuts[:-1], cuts[1:], want)])
            sides.append((flat, of))
        # of the units whose bytes agree, tokens of both end in one stream of bytes; units end there in both
        (a, of_a), (b, of_b) = ((flat[good[of]], of[good[of]]) for flat, of in sides)
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # tokens without bytes of their own end with the token before them
        common = ends_a[:0] if not len(ends_b) else ends_a[ends_b[np.searchsorted(ends_b, ends_a).clip(max=len(ends_b) - 1)] == ends_a]
        common = common[np.append(common[1:] != common[:-1], True)] if len(common) else common
        to_a, to_b = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")
        from_a, from_b = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
        group_of = of_a[from_a] if len(common) else np.zeros(0, np.int64)
        wide_a, wide_b = to_a - from_a, to_b - from_b
        # as shown: a group's ids of A, then its ids of B, each with the sign that follows it
        at_a, at_b = np.repeat(np.arange(len(common)), wide_a), np.repeat(np.arange(len(common)), wide_b)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + from_b[at_a]] = 3 * a + (np.arange(len(a)) == to_a[at_a] - 1)
        order[np.arange(len(b)) + to_a[at_b]] = 3 * b + 2 * (np.arange(len(b)) == to_b[at_b] - 1)
        signed = [self.signed[k] for k in order.tolist()]
        links = wide_a * wide_b
        few = np.flatnonzero(links <= WIDE)
        base = np.repeat(few, links[few])
        nth = np.arange(len(base)) - np.repeat(np.cumsum(links[few]) - links[few], links[few])
        keys = a[from_a[base] + nth // wide_b[base]] * self.size_b + b[from_b[base] + nth % wide_b[base]]
        owner, mult = group_of[base], np.ones(len(base), np.int64)
        for g in np.flatnonzero(links > WIDE):                   # a wide group: by the counts of its ids
            pairs = self.pair_counts([(a[from_a[g]:to_a[g]].tolist(), b[from_b[g]:to_b[g]].tolist())])
            keys = np.concatenate([keys, np.fromiter(pairs.keys(), np.int64, len(pairs))])
            mult = np.concatenate([mult, np.fromiter(pairs.values(), np.int64, len(pairs))])
            owner = np.concatenate([owner, np.full(len(pairs), group_of[g])])
        by_unit = np.argsort(owner, kind="stable")
        self.pairs = np.concatenate([self.pairs, keys[by_unit]])
        self.mults = np.concatenate([self.mults, mult[by_unit]])
        n = len(new)
        n_groups = np.bincount(group_of, minlength=n)
        n_a, n_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        cuts = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        start = len(self.shown)
        self.number.update(zip(new, range(start, start + n)))
        self.shown += ["".join(signed[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, np.where(good, n_groups, -1), np.bincount(owner, minlength=n)], 1)])

    def closed(self, texts: list[list[str]]) -> Iterator[tuple]:
        """Per list of whole units: (n_a, n_b, n_groups, shown groups, pairs, mults), or None where a unit's bytes differ."""
        self.learn(set(chain.from_iterable(texts)))
        many = np.fromiter(map(len, texts), np.int64, len(texts))
        at = [self.number[u] for u in chain.from_iterable(texts)]
        idx, of = np.array(at, np.int64), np.repeat(np.arange(len(texts)), many)
        own = self.sizes[idx]
        bad = np.bincount(of[own[:, 2] < 0], minlength=len(texts)) > 0
        total = np.zeros((len(texts), 3), np.int64)
        np.add.at(total, of, own[:, :3])
        # the units' entries in the tables, one after the other; equal pairs of a text are added up
        first = np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3]
        n = own[:, 3]
        where = np.repeat(first[idx] - np.cumsum(n) + n, n) + np.arange(n.sum())
        span = len(self.bytes_a) * self.size_b
        code = np.repeat(of, n) * span + self.pairs[where]
        order = np.argsort(code)
        code = code[order]
        begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        sums = np.add.reduceat(self.mults[where][order], begin) if len(begin) else np.zeros(0, np.int64)
        keys, cuts = code[begin] % span, np.searchsorted(code[begin], np.arange(len(texts) + 1) * span).tolist()
        ends = np.cumsum(many).tolist()
        for k, (i, j) in enumerate(zip([0, *ends[:-1]], ends)):
            if bad[k]:
                yield None
            else:
                shown_ = "".join([self.shown[u] for u in at[i:j]])[:-1]
                yield (*total[k].tolist(), shown_, keys[cuts[k]:cuts[k + 1]], sums[cuts[k]:cuts[k + 1]])


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]


def _lists(values: list, kind: str) -> pa.Array:
    flat = np.concatenate([np.asarray(v, np.int64) for v in values]) if values else np.zeros(0, np.int64)
    at = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.astype(np.int32 if kind == "int" else np.int64)))


def _whole(path_a: str, path_b: str, kind: str, batch_chars: int = 2_000_000):
    """Texts of one fragment each."""
    def flush(al: Aligner, ids: list, texts: list[str]) -> pa.RecordBatch:
        rows = [r or (0, 0, 0, "", [], []) for r in al.closed([al.cut.split(t) if t else [] for t in texts])]
        n_a, n_b, n_groups, strings, keys, mults = zip(*rows)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_a": pa.array(n_a, pa.int64()), "n_b": pa.array(n_b, pa.int64()),
            "n_groups": pa.array(n_groups, pa.int64()), "n_links": pa.array([int(np.sum(m)) for m in mults], pa.int64()),
            "groups_sha256": pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in strings]),
            "keys": _lists(keys, kind), "mults": _lists(mults, "long")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, ids, texts, held = aligner(path_a, path_b), [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1])
                if held >= batch_chars or len(ids) >= 2000:
                    yield flush(al, ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield flush(al, ids, texts)
    return run


def byte_ranges(units: list[str], size: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(from, to, first unit, unit after the last, the first unit's place) of the ranges (from, to] of a text's bytes."""
    ends = np.cumsum([1 + len(u.encode()) for u in units])
    starts = np.concatenate([[0], ends[:-1]])
    borders = np.arange(size, ends[-1], size)
    inside = np.searchsorted(ends, borders)                       # the unit that a border lies in, or ends
    borders = borders[(ends[inside] == borders) | (ends[inside] - starts[inside] <= size)]
    edges = [0, *borders.tolist(), int(ends[-1])]
    for lo, hi in zip(edges[:-1], edges[1:]):
        i, j = int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(starts, hi, "left"))
        yield lo, hi, i, j, int(starts[i])


def _cut(path_a: str, path_b: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = aligner(path_a, path_b).cut
        for batch in batches:
            for rid, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                units = cut.split(text)
                rows = [(rid, doc_id, k, lo, hi, at, " ".join(units[i:j]))
                        for k, (lo, hi, i, j, at) in enumerate(byte_ranges(units, size))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                    names=["rid", "doc_id", "k", "lo", "hi", "at", "piece"])
    return run


def fragment(al: Aligner, piece: str, at: int, lo: int, hi: int) -> dict:
    """The tokens of a piece (which starts at byte ``at``) that end in (lo, hi], folded."""
    units = al.cut.split(piece)
    a, ends_a, b, ends_b, ok = [], [], [], [], True
    for u, got in zip(units, al.tokens(units)):
        if got is None:
            ok = False
            break
        for ids, ends, (x, e) in ((a, ends_a, got[:2]), (b, ends_b, got[2:])):
            keep = [k for k, v in enumerate(e) if lo < at + v <= hi]
            ids += [x[k] for k in keep]
            ends += [at + e[k] for k in keep]
        at += 1 + len(u.encode())
    if not ok:
        a, ends_a, b, ends_b = [], [], [], []
    groups, (i, j) = cut_groups(a, ends_a, b, ends_b)
    pre, inner = (groups[0], groups[1:]) if groups else ((a, b), [])
    suf = (a[i:], b[j:]) if groups else ([], [])
    pairs = al.pair_counts(inner)
    return {"ok": ok, "cut": bool(groups), "pa": pre[0], "pb": pre[1], "sa": suf[0], "sb": suf[1], "n_a": len(a), "n_b": len(b),
            "n_groups": len(inner), "closed": ";".join(map(shown, inner)), "keys": list(pairs), "mults": list(pairs.values())}


_FRAGMENT = (("ok", "boolean"), ("cut", "boolean"), ("pa", "array<int>"), ("pb", "array<int>"), ("sa", "array<int>"), ("sb", "array<int>"),
             ("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("closed", "string"), ("keys", "array<long>"), ("mults", "array<long>"))
_ARROW = {"boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "long": pa.int64(), "string": pa.string()}


def _fragments(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        for batch in batches:
            rid, doc_id, k, lo, hi, at, piece = (c.to_pylist() for c in batch.columns)
            made = [fragment(al, *x) for x in zip(piece, at, lo, hi)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *(pa.array([m[n] for m in made], _ARROW[t]) for n, t in _FRAGMENT)],
                names=["rid", "doc_id", "k", *(n for n, _ in _FRAGMENT)])
    return run


def _group_pairs(path_a: str, path_b: str):
    """Groups that were closed by composition: shown, with their pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            pairs = [al.pair_counts([g]) for g in zip(a, b)]
            yield pa.RecordBatch.from_pydict({
                "rid": batch.column(0), "k": batch.column(1), "closed": pa.array([shown(g) for g in zip(a, b)], pa.string()),
                "keys": _lists([list(p) for p in pairs], "long"), "mults": _lists([list(p.values()) for p in pairs], "long")})
    return run


def compose(x, y):
    """The monoid's operation on fragments as struct columns; a group that it closes goes to ``out``, at the range where it closes."""
    def pick(c, a, b):
        return F.when(c, a).otherwise(b)
    joined = F.struct(y["first"].alias("k"), F.concat(x["sa"], y["pa"]).alias("a"), F.concat(x["sb"], y["pb"]).alias("b"))
    return F.struct(
        (x["cut"] | y["cut"]).alias("cut"), pick(x["cut"], x["first"], y["first"]).alias("first"),
        pick(x["cut"], x["pa"], F.concat(x["pa"], y["pa"])).alias("pa"), pick(x["cut"], x["pb"], F.concat(x["pb"], y["pb"])).alias("pb"),
        pick(y["cut"], y["sa"], pick(x["cut"], F.concat(x["sa"], y["pa"]), x["sa"])).alias("sa"),
        pick(y["cut"], y["sb"], pick(x["cut"], F.concat(x["sb"], y["pb"]), x["sb"])).alias("sb"),
        pick(x["cut"] & y["cut"], F.concat(x["out"], F.array(joined)), x["out"]).alias("out"))


def reduce_fragments(frags: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(rid, k, a, b): the groups that neighbouring fragments (rid, k, cut, pa, pb, sa, sb) close together, by tree reduction."""
    group = "array<struct<k:int,a:array<int>,b:array<int>>>"
    level = frags.select("rid", "k", "cut", F.when(F.col("cut"), F.col("k")).alias("first"), "pa", "pb", "sa", "sb")
    last = frags.agg(F.max("k")).first()[0] or 0
    closed = None
    while last > 0:
        last //= fan_in
        one = F.struct("cut", "first", "pa", "pb", "sa", "sb", F.array().cast(group).alias("out"))
        level = (level.groupBy("rid", F.floor(F.col("k") / fan_in).cast("int").alias("k"))
                 .agg(F.array_sort(F.collect_list(F.struct("k", one.alias("f")))).alias("fs"))
                 .select("rid", "k", F.transform("fs", lambda x: x["f"]).alias("fs"))
                 .select("rid", "k", F.aggregate(F.slice("fs", 2, fan_in), F.get("fs", F.lit(0)), compose).alias("f"))
                 .select("rid", "k", "f.*"))
        level = land(level)
        found = level.select("rid", F.inline("out"))
        closed = found if closed is None else closed.unionByName(found)
        level = level.drop("out")
    begin = level.where("cut").select("rid", F.col("first").alias("k"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    return begin if closed is None else closed.unionByName(begin)


def _align_long(docs: DataFrame, path_a: str, path_b: str, kind: str, size: int) -> DataFrame:
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = land(docs.withColumn("rid", F.monotonically_increasing_id()).select("rid", "doc_id", "text").mapInArrow(
        _cut(path_a, path_b, size), "rid long, doc_id long, k int, lo long, hi long, at long, piece string"))
    frags = land(ranges.repartition(parts, "rid", "k").mapInArrow(
        _fragments(path_a, path_b), "rid long, doc_id long, k int, " + ", ".join(f"{n} {t}" for n, t in _FRAGMENT)))
    joints = land(reduce_fragments(frags).repartition(parts, "rid", "k").mapInArrow(
        _group_pairs(path_a, path_b), "rid long, k int, closed string, keys array<long>, mults array<long>"))
    docs_of = frags.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.min("ok").alias("ok"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    # a range's joint comes before its closed groups
    parts_of = (frags.where("closed != ''").select("rid", "k", F.lit(1).alias("s"), "closed", "n_groups")
                .unionByName(joints.select("rid", "k", F.lit(0).alias("s"), "closed", F.lit(1).cast("long").alias("n_groups"))))
    strings = parts_of.groupBy("rid").agg(
        F.sum("n_groups").alias("n_groups"),
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "s", "closed"))), lambda x: x["closed"]), ";"), 256).alias("sha"))
    links = frags.select("rid", F.arrays_zip("keys", "mults").alias("p")).unionByName(joints.select("rid", F.arrays_zip("keys", "mults").alias("p")))
    pairs = (links.select("rid", F.inline("p")).groupBy("rid", "keys").agg(F.sum("mults").alias("mults"))
             .groupBy("rid").agg(F.sum("mults").alias("n_links"), F.collect_list(F.struct("keys", "mults")).alias("p")))
    ok = F.col("ok")
    none = F.array().cast("array<long>")
    return (docs_of.join(strings, "rid", "left").join(pairs, "rid", "left").select(
        "doc_id", *(F.when(ok, F.coalesce(c, F.lit(0))).otherwise(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")),
        F.when(ok, F.coalesce("sha", F.lit(""))).otherwise("").alias("groups_sha256"),
        F.when(ok, F.transform("p", lambda x: x["keys"])).otherwise(none).cast(f"array<{kind}>").alias("keys"),
        F.when(ok, F.transform("p", lambda x: x["mults"])).otherwise(none).alias("mults")))


def _count_pairs(kind: str):
    """Per task: (key, documents) of the documents' distinct pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate(held), return_inverse=True)
            return keys, np.bincount(back, np.concatenate(times), len(keys)).astype(np.int64)

        size = 0
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            held.append(flat)
            times.append(np.ones(len(flat), np.int64))
            size += len(flat)
            if size >= FLUSH:
                keys, n = merged()
                held, times, size = [keys], [n], len(keys)
                if size >= FLUSH // 2:
                    yield pa.RecordBatch.from_pydict({"key": pa.array(keys), "docs": pa.array(n)})
                    held, times, size = [], [], 0
        if size:
            keys, n = merged()
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys), "docs": pa.array(n)})
    return run


def _look_up(table):
    """Sums over a document's links from the broadcast table (keys ascending, documents, best)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, best = table.value
        names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        for batch in batches:
            lists, mults = batch.column(6), batch.column(7)
            flat, m = lists.flatten().to_numpy(zero_copy_only=False), mults.flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, flat)
            of = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            sums = []
            for weight in (best[at], docs[at]):                   # exact in integers
                s = np.zeros(batch.num_rows, np.int64)
                np.add.at(s, of, weight.astype(np.int64) * m)
                sums.append(pa.array(s))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(6)), *sums], names=[*names, "n_best", "count_sum"])
    return run


def align(docs: DataFrame, path_a: str, path_b: str, size: int = RANGE, long: int = LONG) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct id pairs (keys: a * size_b + b) with
    how often each is linked (mults).  Landed."""
    kind = aligner(path_a, path_b).key_type
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    schema = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<{kind}>, mults array<long>"
    is_long = F.octet_length("text") > long
    short = t.where(~is_long).mapInArrow(_whole(path_a, path_b, kind), schema)
    return land(short.unionByName(_align_long(t.where(is_long), path_a, path_b, kind, size)))


def pair_table(aligned: DataFrame, size_b: int) -> DataFrame:
    """(key, docs, best): documents per id pair, and whether no pair of its A id has more.  An A id has at most
    ``size_b`` pairs."""
    kind = aligned.schema["keys"].dataType.elementType.simpleString()
    counts = (aligned.select("keys").mapInArrow(_count_pairs(kind), f"key {kind}, docs long")
              .groupBy("key").agg(F.sum("docs").alias("docs")))
    a = F.floor(F.col("key") / size_b)
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy(a)))


def alignment_digest(docs: DataFrame, path_a: str, path_b: str, size: int = RANGE, long: int = LONG) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    aligned = align(docs, path_a, path_b, size, long)
    table = land(pair_table(aligned, aligner(path_a, path_b).size_b))
    if table.count() <= BROADCAST_PAIRS:
        t = table.toArrow()
        keys = t.column("key").to_numpy()
        order = np.argsort(keys)
        shared = spark.sparkContext.broadcast((keys[order], t.column("docs").to_numpy()[order], t.column("best").to_numpy()[order]))
        out = aligned.mapInArrow(_look_up(shared), "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                                   "groups_sha256 string, n_best long, count_sum long")
    else:
        rows = land(aligned.withColumn("rid", F.monotonically_increasing_id()))
        sums = (rows.select("rid", F.inline(F.arrays_zip("keys", "mults"))).join(table, F.col("keys") == F.col("key"))
                .groupBy("rid").agg(F.sum(F.when(F.col("best"), F.col("mults"))).alias("n_best"),
                                    F.sum(F.col("docs") * F.col("mults")).alias("count_sum")))
        out = rows.join(sums, "rid", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                      *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")), "groups_sha256")
