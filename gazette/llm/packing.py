"""Best-fit packing of tokenised documents, hierarchically.

A document's ids, closed by id 0, are cut into pieces of ``capacity`` from the end, so only the
first piece may be shorter.  Each partition packs its pieces best-fit by decreasing length as it tokenises;
bins that are full to within ``slack`` are final.  The underfull bins of all partitions become items of
the next round: they are dealt into groups of about ``GROUP`` items, packed best-fit again (a bin is never taken
apart), and what stays underfull meets in fewer groups, until one group is left or a round merges almost
nothing.  Only bin numbers and lengths travel between rounds, never ids.

Tokenising keeps a table from space-separated parts to ids per worker: where Python's ``re`` classifies all
characters like the tokenizer's own splitting, unknown parts are split here; any other text is encoded whole.  The unknown parts of
many texts are encoded at once: the merges of the tokenizer's model are applied to all their words together, one merge of each word a step
(parts above ``LONG_WORD`` bytes, and models with rules beside merges, go through the model itself).  The table has two halves of ``CACHE``
entries: a full one becomes the old one, from which parts that come again are taken over, so frequent parts stay and a worker's memory is bounded.

Defined cases: a null or empty text is the single id 0; a doc of exactly ``capacity`` ids is one piece; repeated rows
are packed separately; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from itertools import chain
from typing import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import land, text_or_empty
from gazette.llm.shingles import slices

GROUP = 5000
CACHE = 160_000
LONG_WORD = 64
RUN = 1 << 19                                    # bytes of text that are encoded at once
NO_MERGE = np.iinfo(np.int32).max
LOCAL_ITEMS = 50_000
# fixed values: the splitting pattern of byte-level BPE, over characters that Python classifies alike
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
OTHER = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-՗‐-‧‰-⁃]")
# ASCII letters, digits and signs; white space, controls, the apostrophe of contractions and all beyond ASCII are left to the pattern
ODD_KIND = 0
KIND = np.array([1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 3 if 33 <= c <= 126 and c != 39 else ODD_KIND for c in range(128)]
                + [ODD_KIND], np.uint8)

_LOADED: dict = {}


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the others take the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


LETTERS = byte_letters()


class Merges:
    """The merges of a byte-level model, applied to many words at once."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        self.letter = np.array([vocab[LETTERS[b]] for b in range(256)], np.int64)
        self.size = max(vocab.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]]
        code = np.array([vocab[x] * self.size + vocab[y] for x, y in pairs], np.int64)
        self.joined = np.array([vocab[x + y] for x, y in pairs], np.int64)
        # a hash table from pairs to ranks (places in the list), with free slots between: a pair stands in the first free one from its own
        bits = max(8, (4 * len(code)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.pair, self.place = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_MERGE, np.int32)
        for k, (h, c) in enumerate(zip(self.slot(code).tolist(), code.tolist())):
            while self.pair[h] not in (-1, c):
                h = (h + 1) & self.mask
            if self.pair[h] < 0:
                self.pair[h], self.place[h] = c, k

    @staticmethod
    def fits(model: dict) -> bool:
        """Whether merges are the model's only rule and every byte has an id."""
        plain = all(not model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        return model["type"] == "BPE" and plain and bool(model["merges"]) and all(c in model["vocab"] for c in LETTERS.values())

    def slot(self, code: np.ndarray) -> np.ndarray:
        return ((code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        code = x * self.size + y
        at = self.slot(code)
        held = self.pair[at]
        out = np.where(held == code, self.place[at], np.int32(NO_MERGE))
        left = np.flatnonzero((held != code) & (held >= 0))          # the slot is another pair's: the next one
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            held = self.pair[at[left]]
            same = held == code[left]
            out[left[same]] = self.place[at[left[same]]]
            left = left[~same & (held >= 0)]
        return out

    def __call__(self, data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that stand one after another in ``data``, ``sizes`` bytes each (one at least), and how many each has.

        Every step joins the leftmost pair of the least rank of each word; words without such a pair are done.
        """
        ids = self.letter[np.frombuffer(data, np.uint8)]
        n, word, ends = sizes.astype(np.int64), np.arange(len(sizes)), np.cumsum(sizes)
        rank = np.full(len(ids), NO_MERGE, np.int32)
        rank[:-1] = self.rank(ids[:-1], ids[1:])
        rank[ends - 1] = NO_MERGE                                    # an id's rank is that of it and the next of its word
        many, done = np.zeros(len(sizes), np.int64), []
        while len(word):
            least = np.minimum.reduceat(rank, np.cumsum(n) - n)
            open_ = least < NO_MERGE
            if not open_.all():
                of = np.repeat(open_, n)
                many[word[~open_]] = n[~open_]
                done.append((word[~open_], ids[~of]))
                ids, rank, word, n, least = ids[of], rank[of], word[open_], n[open_], least[open_]
                if not len(word):
                    break
            hits = np.flatnonzero(rank == np.repeat(least, n))
            at = hits
            if len(hits) > len(word):
                owner = np.searchsorted(np.cumsum(n), hits, "right")
                at = hits[np.append(True, owner[1:] != owner[:-1])]
            ids[at] = self.joined[least]
            last = rank[at + 1] == NO_MERGE                          # perhaps the word's last: the next id may be another word's
            stays = np.ones(len(ids), bool)
            stays[at + 1] = False
            ends = np.cumsum(n)
            last &= at + 2 == ends
            first = at == ends - n
            ids, rank, n = ids[stays], rank[stays], n - 1
            at = at - np.arange(len(at))
            rank[at] = NO_MERGE
            x = at[~last]
            rank[x] = self.rank(ids[x], ids[x + 1])
            x = at[~first] - 1
            rank[x] = self.rank(ids[x], ids[x + 1])
        out, begin = np.empty(int(many.sum()), np.int64), np.cumsum(many) - many
        for w, found in done:
            k = many[w]
            out[np.repeat(begin[w] - np.cumsum(k) + k, k) + np.arange(len(found))] = found
        return out, many


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        model = json.loads(self.tokenizer.to_str())["model"]
        self.merges = Merges(model) if Merges.fits(model) else None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def split(self, text: str) -> bytes:
        ids = []
        for word in PRE_TOKEN.findall(text):
            ids += [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def split_all(self, texts: list[str]) -> list[bytes]:
        """``split`` of many short texts."""
        if self.merges is None or not texts:
            return [self.split(t) for t in texts]
        out: list[bytes] = [b""] * len(texts)
        data = "".join(texts)
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(chars)
        code = np.frombuffer(data.encode("utf-32-le"), np.uint32)
        kind = KIND[np.minimum(code, 128)]
        hard = np.zeros(len(texts), bool)                            # other than ASCII letters, digits and signs behind at most one space
        starts = (ends - chars)[chars > 0]
        inner = kind == ODD_KIND
        inner[starts] &= code[starts] != 32
        hard[np.searchsorted(ends, np.flatnonzero(inner), "right")] = True
        hard |= (chars == 0) | (chars > LONG_WORD)
        if not hard.all():
            stay = np.flatnonzero(~hard)
            mine = np.repeat(~hard, chars)
            raw, kind, n = code[mine].astype(np.uint8), kind[mine], chars[stay]
            begin = np.cumsum(n) - n
            cut = np.append(True, (kind[1:] != kind[:-1]) & (kind[:-1] != ODD_KIND))      # a space goes with what follows it
            cut[begin] = True
            at = np.flatnonzero(cut)
            self._merged(raw.tobytes(), np.diff(np.append(at, len(raw))), np.searchsorted(at, np.append(begin, len(raw))), stay, out)
        few = [k for k in np.flatnonzero(hard).tolist() if 0 < len(texts[k]) <= LONG_WORD // 4]
        if few:
            words = [PRE_TOKEN.findall(texts[k]) for k in few]
            flat = [w.encode() for w in chain.from_iterable(words)]
            self._merged(b"".join(flat), np.fromiter(map(len, flat), np.int64, len(flat)),
                         np.append(0, np.cumsum([len(w) for w in words])), few, out)
        for k in np.flatnonzero(hard & (chars > LONG_WORD // 4)).tolist():
            out[k] = self.split(texts[k])
        return out

    def _merged(self, data: bytes, sizes: np.ndarray, first: np.ndarray, places: Iterable[int], out: list[bytes]) -> None:
        """Put ids into ``places`` of ``out``: words of ``sizes`` bytes stand in ``data``, ``first`` are the texts' first words and the end."""
        ids, many = self.merges(data, sizes)
        raw, cuts = ids.astype("<u4").tobytes(), (4 * np.append(0, np.cumsum(many))[first]).tolist()
        for k, i, j in zip(places, cuts[:-1], cuts[1:]):
            out[k] = raw[i:j]

    def __call__(self, text: str) -> bytes:
        return self.encode([text])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """A single space before a non-space always starts a pre-token, so without double spaces the
        parts between spaces (each with the space before it) encode alone as they do in the text."""
        if len(self.known) > CACHE:
            self.old, self.known = self.known, {}
        known, old, out, new = self.known, self.old, [], {}
        for text in texts:
            if OTHER.search(text) or "  " in text or any(s in text for s in self.special):
                out.append(self.whole(text))
                continue
            first, *parts = text.split(" ")
            ids = list(map(known.get, parts))
            gaps = [(k, p) for k, (p, i) in enumerate(zip(parts, ids)) if i is None] if None in ids else []
            new.update([(p, old.get(p)) for _, p in gaps])
            out.append((first, ids, gaps))
        unseen = [p for p, i in new.items() if i is None]
        new.update(zip(unseen, self.split_all([" " + p for p in unseen])))
        known.update(new)
        plain = [k for k, x in enumerate(out) if isinstance(x, tuple)]
        for k, start in zip(plain, self.split_all([out[k][0] for k in plain])):
            _, ids, gaps = out[k]
            for j, p in gaps:
                ids[j] = new[p]
            out[k] = start + b"".join(ids)
        return out


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item (best fit by decreasing length), and each bin's fill."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0                                   # bit r is set while a bin has exactly r free places
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[k], offsets[k] = b, fill[b]
        fill[b] += n
        if room - n:
            by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, fill


def _tokenise_and_pack(path: str, capacity: int, with_ids: bool):
    """Per partition: pieces with the partition's bins."""
    def flush(rows: list, first_bin: int) -> tuple[pa.RecordBatch, int]:
        cols = list(zip(*rows))
        bins, offsets, fill = best_fit(np.array(cols[3]), capacity)
        data = {"doc_id": pa.array(cols[0], pa.int64()), "piece": pa.array(cols[1], pa.int32()),
                "start": pa.array(cols[2], pa.int64()), "length": pa.array(cols[3], pa.int64()),
                "ids_crc32": pa.array(cols[4], pa.int64()), "bin": pa.array(bins + first_bin),
                "offset": pa.array(offsets), "fill": pa.array(np.array(fill, np.int64)[bins])}
        if with_ids:
            data["ids"] = pa.array(cols[5], pa.binary())
        return pa.RecordBatch.from_pydict(data), first_bin + len(fill)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, rows = encoder(path), []
        next_bin = TaskContext.get().partitionId() << 36
        for batch in batches:
            col = batch.column(1)
            encoded = chain.from_iterable(encode.encode(col.slice(lo, hi - lo).to_pylist()) for lo, hi in slices(col, RUN))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded):
                ids += b"\0\0\0\0"
                total = len(ids) // 4
                at, end = 0, (total - 1) % capacity + 1
                piece = 0
                while at < total:
                    raw = ids[4 * at:4 * end]
                    rows.append((doc_id, piece, at, end - at, zlib.crc32(raw), raw if with_ids else None))
                    at, end, piece = end, end + capacity, piece + 1
                if len(rows) >= LOCAL_ITEMS:
                    out, next_bin = flush(rows, next_bin)
                    yield out
                    rows = []
        if rows:
            yield flush(rows, next_bin)[0]
    return run


def _merge(capacity: int, round_: int):
    """Best fit over one group's underfull bins: each bin's new bin and offset."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        bins, offsets, fill = best_fit(pdf["fill"].to_numpy(), capacity)
        base = (1 << 62) | (round_ << 54) | (int(key[0]) << 24)
        return pd.DataFrame({"bin": pdf["bin"].to_numpy(), "parent": bins + base, "shift": offsets,
                             "fill": np.array(fill, np.int64)[bins]})
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, slack: int = 16, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long"
              + (", ids binary" if with_ids else ""))
    pieces = land(docs.select("doc_id", text_or_empty().alias("text"))
                  .mapInArrow(_tokenise_and_pack(tokenizer, capacity, with_ids), schema))
    under = F.col("fill") < capacity - slack
    items = pieces.where((F.col("offset") == 0) & under).select("bin", "fill")
    left, steps = items.count(), []
    while left > 1:
        groups = -(-left // GROUP)
        step = land(items.withColumn("g", F.pmod(F.xxhash64("bin"), F.lit(groups))).groupBy("g")
                    .applyInPandas(_merge(capacity, len(steps)), "bin long, parent long, shift long, fill long"))
        steps.append(step)
        items = step.where((F.col("shift") == 0) & under).select(F.col("parent").alias("bin"), "fill")
        before, left = left, items.count()
        if groups == 1 or left > 0.95 * before:
            break
    moves = None                                 # from a partition's bin to its last bin
    for step in reversed(steps):
        here = step.select("bin", "parent", "shift")
        if moves is not None:
            later = moves.select(F.col("bin").alias("b2"), F.col("parent").alias("p2"), F.col("shift").alias("s2"))
            here = here.join(later, F.col("parent") == F.col("b2"), "left").select(
                "bin", F.coalesce("p2", "parent").alias("parent"),
                (F.col("shift") + F.coalesce("s2", F.lit(0))).alias("shift"))
        moves = here
    out = pieces if moves is None else pieces.join(moves, "bin", "left")
    parent, shift = (F.lit(None).cast("long"), F.lit(0)) if moves is None else (F.col("parent"), F.col("shift"))
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce(parent, F.col("bin")).alias("sequence_id"),
        (F.col("offset") + F.coalesce(shift, F.lit(0))).cast("long").alias("offset"), *(["ids"] if with_ids else []))
