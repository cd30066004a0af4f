"""Hard negatives and nearest neighbours against brute force."""

import duckdb
import math
import random

import numpy as np
import pytest

from gazette.llm import ann, hardneg, oracles, search
from __spark_entry__ import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def odd_vectors():
    """Nulls, zeros, non-finite components, other lengths, ties, repeated rows, and a vector that a third of the rows share."""
    rng = random.Random(4)
    rows = [(k, [rng.gauss(k % 5 == d, 0.4) for d in range(6)], rng.randrange(4)) for k in range(400)]
    rows += [(1000 + k, [0.5, 0.25, 0.0, -0.5, 0.125, 1.0], k % 3) for k in range(200)]
    rows += [(1300, None, 1), (1400, [0.0] * 6, 2), (1500, [0.1] * 6, None), (1600, [float("nan")] + [0.1] * 5, 1), (1700, [float("inf")] * 6, 1),
             (1800, [None, 0.1, 0.2, 0.3, 0.4, 0.5], 1), (1900, [], 1), (2000, [0.3, 0.4], 1), (2001, [0.3, 0.5], 1), (2002, [0.1, 0.5], 2),
             (None, [0.2] * 6, 1), (None, None, None), (100, rows[100][1], rows[100][2]), (100, rows[100][1], 3), (7, rows[7][1], rows[7][2]),
             (2100, [1e3] * 6, 3), (2200, [-2.0] * 6, 9)]
    return rows


def key(r):
    return tuple((x is not None, x or 0) for x in r)


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=key)


NEG = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain_negatives(rows):
    d = []
    for n, (i, e, label) in enumerate(rows):
        if label is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        d.append((n, i, [math.floor(256 * float(np.float32(x))) for x in e], label))
    out = []
    for n, i, e, label in d:
        if i is None or i % 100:
            continue
        s = sorted(((-sum(x * y for x, y in zip(e, f)), j is None, j or 0, m, j, g) for m, j, f, g in d if m != n and len(f) == len(e)))
        for p in [r for r in s if r[5] == label][:5]:
            fit = [r for r in s if r[5] != label and 30 * -p[0] <= 100 * -r[0] <= 90 * -p[0]][:10]
            out += [(i, p[4], k, r[4], -p[0], -r[0]) for k, r in enumerate(fit, 1)]
    return sorted(out, key=key)


@pytest.mark.parametrize("unit", [4096, 60])
def test_hard_negatives_of_odd_rows(spark, monkeypatch, unit):
    monkeypatch.setattr(search, "UNIT_ROWS", unit)
    monkeypatch.setattr(hardneg.Tiles.__init__, "__defaults__", (unit,))
    rows = odd_vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({}).selectExpr("*", "1 as rid", "'x' as tile", "2 as unit", "3 as slots", "4 as vec")
    assert rows_of(hardneg.hard_negatives(hardneg.scaled(df)), *NEG) == plain_negatives(rows)


def test_hard_negatives_against_the_statement(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(f"SELECT {', '.join(NEG)} FROM ({oracles.HARD_NEGATIVES})").fetchall()
    assert want and rows_of(queries()["op11_hard_negatives"](spark, sf), *NEG) == sorted(want, key=key)


def test_boxes_hold_their_products():
    rng = np.random.default_rng(2)
    x, a = rng.integers(-300, 300, (500, 9)), rng.integers(-300, 300, (20, 9))
    pages = hardneg.str_order(x, 16)
    assert sorted(np.concatenate(pages).tolist()) == list(range(500)) and max(map(len, pages)) <= 16
    low, high = np.array([x[p].min(0) for p in pages]), np.array([x[p].max(0) for p in pages])
    lower, upper = hardneg.intervals(a, low, high)
    for n, p in enumerate(pages):
        s = a @ x[p].T
        assert (s >= lower[:, n, None]).all() and (s <= upper[:, n, None]).all()
    big = np.array([[2 ** 40, -1]])
    assert hardneg.product(big, np.array([[2 ** 20, 5]]))[0, 0] == 2 ** 60 - 5


ANN = ("query_id", "rank", "vec_id", "score")


def plain_neighbours(rows, k=10):
    d = [(n, i, np.array(e, np.float32).astype(float)) for n, (i, e, _) in enumerate(rows)
         if e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    out = {}
    for n, i, e in d:
        if i is not None and i % 100 == 0:
            s = sorted((float(np.sqrt(((e - f) ** 2).sum())), j is None, j or 0, m, j) for m, j, f in d if m != n and len(f) == len(e))
            out.setdefault(i, []).append([(i, r, x[4], x[0]) for r, x in enumerate(s[:k], 1)])
    return out


def test_neighbours_of_odd_rows_in_one_leaf(spark):
    """With one leaf the result is exact."""
    rows = odd_vectors()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rid", "'x' as leaf", "2 as unit", "3 as bound", "4 as vec")
    got = rows_of(ann.nearest_rows(df, df["vec_id"] % 100 == 0), *ANN)
    want = sorted((r for lists in plain_neighbours(rows).values() for x in lists for r in x), key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=0)


def test_recall_of_the_tree(spark, monkeypatch):
    """Many leaves, parted ones among them, on a table without clusters: recall as calibrated; every score exact."""
    monkeypatch.setattr(ann, "LEAF_ROWS", 40)
    monkeypatch.setattr(search, "UNIT_ROWS", 60)
    sf = "/root/testdata/sf0.1"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    table += [(5000 + k, table[3][1], 1) for k in range(700)]
    df = spark.createDataFrame(table, SCHEMA)
    got = rows_of(ann.nearest_rows(df, df["vec_id"] % 100 == 0), *ANN)
    want = {q: lists[0] for q, lists in plain_neighbours(table).items()}
    assert sorted({r[0] for r in got}) == sorted(want) and len(got) == 10 * len(want)
    hits = sum(r[3] <= want[r[0]][-1][3] * (1 + 1e-12) for r in got)
    assert hits >= 0.93 * len(got)
    vec = {i: np.array(e, np.float32).astype(float) for i, e, _ in table}
    assert all(abs(r[3] - math.sqrt(((vec[r[0]] - vec[r[2]]) ** 2).sum())) <= 1e-12 for r in got)
    by = {}
    for q, rank, i, s in got:
        by.setdefault(q, []).append((rank, s, i))
    assert all([r for r, _, _ in x] == list(range(1, 11)) and [y[1:] for y in x] == sorted(y[1:] for y in x) for x in by.values())


def test_best_bins_come_nearest_first():
    rng = np.random.default_rng(1)
    tree = ann.Tree(rng.normal(size=(2000, 4)), 40_000)
    assert tree.leaves > 20
    q = rng.normal(size=4)
    order = tree.best_bins(q, tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and order[0] == tree.leaf_of(q[None])[0]


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hardneg.hard_negatives(hardneg.scaled(none)).count() == 0
    assert ann.nearest_rows(none, none["vec_id"] % 100 == 0).count() == 0
    nulls = spark.createDataFrame([(None, None, None), (100, None, 1)], SCHEMA)
    assert hardneg.hard_negatives(hardneg.scaled(nulls)).count() == 0
    assert ann.nearest_rows(nulls, nulls["vec_id"] % 100 == 0).count() == 0
