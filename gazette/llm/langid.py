"""Language identification with a byte convolutional network, trained and applied in numpy.

Text bytes are reduced (A-Z lowered, other ASCII but letters to space) and cut into windows of ``WINDOW``
bytes.  Filters of several widths slide over embedded bytes; each filter's maximum over a window feeds a softmax over the learned
languages.  A document's probabilities are the mean over all windows of its whole text, weighted by their bytes.

Training uses every language and at most about ``PER_LANG`` rows of each, chosen by hash, and one window of each row; beyond
``TRAIN_ROWS // PER_LANG`` languages about ``TRAIN_ROWS`` rows in all, but ``LEAST_ROWS`` or all rows of each.  The language counts
behind that choice cover all rows.  ``text`` is the only feature.  The
trained weights (a few kilobytes) go to the tasks; each worker expands them once into tables by byte
pair, so applying a filter is a table lookup.

Defined cases: null text, or text without a letter, is ``und`` with score 0; rows with a null language are not
learned from; without any labelled row everything is ``und``; ties take the first language by code
point; an empty table gives an empty result; extra columns are ignored or, by ``accepted``, passed through.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW, DIM, FILTERS, WIDTHS = 256, 8, 16, (2, 3, 4)
PER_LANG, TRAIN_ROWS, LEAST_ROWS, EPOCHS, BATCH = 1200, 76_800, 50, 14, 64
SLAB = 96                       # windows expanded at once

REDUCE = np.arange(256, dtype=np.uint8)
REDUCE[:128] = 32
REDUCE[97:123] = np.arange(97, 123)
REDUCE[65:91] = np.arange(97, 123)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_rows(docs: DataFrame, per_lang: int = PER_LANG, most: int = TRAIN_ROWS, seed: int = 5) -> list[tuple[str, str]]:
    """(lang, passage) of a bounded sample of the labelled rows that are not held out.

    Every language is in it.  Its rows are kept by a hash threshold that expects ``per_lang`` of them (fewer where ``most``
    is not enough for all languages), so no rank or sort per language is needed; passages are at most ``WINDOW`` characters, from anywhere in the text.
    """
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return []
    each = min(per_lang, max(LEAST_ROWS, most // len(counts)))
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.length("text")), F.lit(1 << 30))
    bounds = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(1.0, each / r["count"]) * (1 << 30))) for r in counts], "lang string, bound long")
    chosen = rows.select("lang", "text", "doc_id").join(F.broadcast(bounds), "lang").where(place < F.col("bound"))
    start = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int") + 1
    got = (chosen.select("lang", F.substring("text", start, F.lit(WINDOW)).alias("passage"), "doc_id")
           .where(has_letter(F.col("passage"))).limit(2 * max(most, each * len(counts))).collect())
    return sorted((r["lang"], r["passage"]) for r in got)


def windows(data: bytes) -> np.ndarray:
    """(n, WINDOW) reduced bytes of one text, the last window filled with spaces."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.full(n * WINDOW, 32, np.uint8)
    out[:len(data)] = REDUCE[np.frombuffer(data, np.uint8)]
    return out.reshape(n, WINDOW)


class Net:
    """Weights: embedding (256, DIM), filters per width (width * DIM, FILTERS) with bias, softmax layer."""

    def __init__(self, langs: Sequence[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        self.langs = list(langs)
        self.w = {"E": rng.normal(0, 0.5, (256, DIM)), "O": rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(langs))),
                  "o": np.zeros(len(langs))}
        for k in WIDTHS:
            self.w[f"W{k}"] = rng.normal(0, 1 / np.sqrt(k * DIM), (k * DIM, FILTERS))
            self.w[f"b{k}"] = np.zeros(FILTERS)
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _forward(self, x: np.ndarray):
        """Pooled features, where each maximum stood, and the embedded bytes."""
        e = self.w["E"][x]
        pooled, at = [], []
        for k in WIDTHS:
            n = x.shape[1] - k + 1
            patches = np.concatenate([e[:, j:j + n] for j in range(k)], axis=2)
            z = patches.reshape(-1, k * DIM) @ self.w[f"W{k}"]
            z = z.reshape(len(x), n, FILTERS)
            best = z.argmax(1)
            at.append(best)
            pooled.append(np.take_along_axis(z, best[:, None], 1)[:, 0] + self.w[f"b{k}"])
        return np.maximum(np.concatenate(pooled, 1), 0), at, e

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 4) -> None:
        """Adam on the cross entropy, languages weighted alike; gradients pass through the maxima only."""
        rng = np.random.default_rng(seed)
        share = np.bincount(y, minlength=len(self.langs)).astype(float)
        weight = (share.sum() / (np.count_nonzero(share) * np.maximum(share, 1)))[y].astype(np.float32)
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        var = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                idx = order[lo:lo + BATCH]
                xb, n = x[idx], len(idx)
                cut = rng.integers(WINDOW // 16, WINDOW + 1, n)          # short texts occur, so learn from short windows too
                xb = np.where(np.arange(WINDOW)[None] < np.where(rng.random(n) < 0.4, cut, WINDOW)[:, None], xb, 32)
                h, at, e = self._forward(xb)
                p = softmax(h @ self.w["O"] + self.w["o"])
                p[np.arange(n), y[idx]] -= 1
                p *= weight[idx][:, None] / n
                g = {"O": h.T @ p, "o": p.sum(0)}
                dh = (p @ self.w["O"].T) * (h > 0)
                de = np.zeros((256, DIM), np.float32)
                for i, k in enumerate(WIDTHS):
                    d = dh[:, i * FILTERS:(i + 1) * FILTERS]
                    where = at[i][:, :, None] + np.arange(k)             # (n, FILTERS, k)
                    rows = np.arange(n)[:, None, None]
                    patch = e[rows, where].reshape(n, FILTERS, k * DIM)
                    g[f"W{k}"] = np.einsum("nfp,nf->pf", patch, d)
                    g[f"b{k}"] = d.sum(0)
                    back = d[:, :, None] * self.w[f"W{k}"].T[None]
                    np.add.at(de, xb[rows, where].reshape(-1), back.reshape(-1, DIM))
                g["E"] = de
                step += 1
                for key, grad in g.items():
                    mean[key] += 0.1 * (grad - mean[key])
                    var[key] += 0.01 * (grad * grad - var[key])
                    self.w[key] -= rate * (mean[key] / (1 - 0.9 ** step)) / (np.sqrt(var[key] / (1 - 0.99 ** step)) + 1e-8)
            rate *= 0.85

    def tables(self) -> dict[str, np.ndarray]:
        """Filter responses by byte pair: one row holds what a pair gives to every filter it can start."""
        part = {(k, j): self.w["E"] @ self.w[f"W{k}"][j * DIM:(j + 1) * DIM] for k in WIDTHS for j in range(k)}
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)      # noqa: E731
        first = np.concatenate([pair(part[k, 0], part[k, 1]) for k in WIDTHS], 1).astype(np.float32)
        return {"first": first, "third": part[3, 2].astype(np.float32), "later": pair(part[4, 2], part[4, 3]).astype(np.float32),
                "bias": np.concatenate([self.w[f"b{k}"] for k in WIDTHS])}

    def probabilities(self, x: np.ndarray, t: dict[str, np.ndarray]) -> np.ndarray:
        """Softmax of every window in ``x``, by the tables of ``tables()``."""
        pairs = (x[:, :-1].astype(np.uint16) << 8) | x[:, 1:]
        n, f = x.shape[1], FILTERS
        z = t["first"][pairs]                                            # (m, n - 1, 3 f)
        a = z[:, :, :f].max(1)
        b = (z[:, :n - 2, f:2 * f] + t["third"][x[:, 2:]]).max(1)
        c = (z[:, :n - 3, 2 * f:] + t["later"][pairs[:, 2:]]).max(1)
        h = np.maximum(np.concatenate([a, b, c], 1) + t["bias"], 0)
        return softmax(h @ self.w["O"] + self.w["o"])

    def predict(self, texts: Sequence[bytes], t: dict[str, np.ndarray]) -> np.ndarray:
        """(texts, languages): mean window probabilities, weighted by the windows' bytes."""
        out = np.zeros((len(texts), len(self.langs)))
        waiting, owner, weight = [], [], []

        def flush():
            x = np.concatenate(waiting)
            who, w = np.concatenate(owner), np.concatenate(weight)
            for lo in range(0, len(x), SLAB):
                np.add.at(out, who[lo:lo + SLAB], self.probabilities(x[lo:lo + SLAB], t) * w[lo:lo + SLAB, None])
            waiting.clear(), owner.clear(), weight.clear()

        held = 0
        for k, data in enumerate(texts):
            x = windows(data)
            w = np.full(len(x), 1.0)
            w[-1] = (len(data) - (len(x) - 1) * WINDOW) / WINDOW
            waiting.append(x), owner.append(np.full(len(x), k)), weight.append(w)
            held += len(x)
            if held >= 8 * SLAB:
                flush()
                held = 0
        if held:
            flush()
        return out / np.maximum(out.sum(1, keepdims=True), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train_langid(docs: DataFrame, per_lang: int = PER_LANG) -> Net | None:
    rows = training_rows(docs, per_lang)
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    x = np.concatenate([windows(r[1].encode("utf-8", "replace"))[:1] for r in rows])
    net = Net(langs)
    net.train(x, np.array([langs.index(r[0]) for r in rows]))
    return net


_TABLES: dict = {}


def _tables(net: Net) -> dict[str, np.ndarray]:
    key = net.w["E"].tobytes()
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = net.tables()
    return _TABLES[key]


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predicted(net: Net | None, text: Column) -> Column:
    """Struct (lang_pred, score) of a text column."""
    und = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    if net is None:
        return und

    @F.pandas_udf(RESULT)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = _tables(net)
        for texts in batches:
            known = texts.notna().to_numpy()
            p = net.predict([v.encode("utf-8", "replace") for v in texts[known]], t)
            lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if len(p):
                lang[known] = np.array(net.langs, object)[p.argmax(1)]
                score[known] = p.max(1)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return apply(F.when(has_letter(text), text))


def identify(docs: DataFrame, net: Net | None = None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score; trains on ``docs`` unless a net is given."""
    net = net or train_langid(docs)
    p = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted(net, F.col("text")).alias("p"))
    return p.select("doc_id", "held_out", "p.lang_pred", "p.score")


def accepted(docs: DataFrame, min_lift: float = 0.05, net: Net | None = None) -> DataFrame:
    """Rows of ``docs`` that have a language, with all their columns.  Rejected are rows predicted ``und`` and rows whose best
    probability is no better than a guess: of k languages, it lies less than ``min_lift`` of the way from 1 / k to 1."""
    net = net or train_langid(docs)
    p = predicted(net, F.col("text"))
    if net is None:
        return docs.limit(0)
    k = len(net.langs)
    least = 1 / k + min_lift * (1 - 1 / k) if k > 1 else 0.0
    return docs.where((p["lang_pred"] != "und") & (p["score"] >= least))
