"""Whitening and hard negatives against brute force, and on odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbflow.llm import hard_negatives as gnat
from curbflow.llm import vectors, whitening
from curbflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, x string, z int, key int, q int, leaf int, copies int, n int"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, 3, 4, 5, 6) for row in rows], SCHEMA)


def drawn(seed, n, d=6, labels=3, copies=3):
    """Rows with equal vectors, equal scores, labels that occur once, and a large group of copies."""
    rng = np.random.default_rng(seed)
    base = rng.integers(-3, 4, size=(n, d)) / 16.0
    base[n // 2 :: copies] = base[0]
    return [(k * 5, base[k].tolist(), int(rng.integers(labels)) if k else 99) for k in range(n)]


ODD = [
    (None, [0.5, 0.25, 0.0], 1),
    (None, [0.5, 0.25, 0.0], 1),
    (1, None, 1),
    (2, [], 1),
    (3, [1.0, None, 0.0], 1),
    (4, [NAN, 0.0, 0.0], 1),
    (5, [INF, 0.0, 0.0], 1),
    (6, [0.1, 0.2], 1),
    (7, [0.1, 0.2, 0.3], None),
    (100, [0.5, 0.5, 0.5], 1),
    (100, [0.5, 0.5, 0.5], 1),
    (100, [0.25, 0.5, 0.5], 1),
    (200, [-0.0, 0.5, 0.5], 2),
    (300, [0.5, -0.5, 1e30], 2),
    (400, [0.5, -0.5, -1e30], 1),
    (8, [0.5, 0.5, 0.25], 2),
    (9, [0.5, 0.5, 0.25], 3),
]


def usable(rows, size):
    for key, vector, label in rows:
        if vector is not None and len(vector) == size and all(c is not None and math.isfinite(c) for c in vector):
            floats = [float(np.float32(c)) for c in vector]
            yield key, tuple(max(-int(vectors._MOST), min(int(vectors._MOST), math.floor(256 * c))) for c in floats), label


# 12 whitening


def brute_whitening(rows, size, components=4):
    kept = list(usable(rows, size))
    distinct = sorted({x for _, x, _ in kept})
    n, sums = len(distinct), [int(sum(x[k] for x in distinct)) for k in range(size)]
    x = np.array(distinct, float)
    centred = x - np.array([s / n for s in sums])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    deviation = {v: sum((n * int(c) - s) ** 2 for c, s in zip(v, sums)) for v in distinct}
    whitened = dict(zip(distinct, centred @ basis[:, order] / np.sqrt(np.maximum(values[order], 1e-300))))
    return kept, n, deviation, whitened, values[order] / values.sum()


def test_whitening_equals_brute_force(spark):
    rows = drawn(1, 300)
    kept, n, deviation, whitened, explained = brute_whitening(rows, 6)
    found = whitening.whiten(table(spark, rows)).toPandas()
    assert len(found) == 4 * len(kept) and set(found["n"]) == {n}
    assert found["identity_error"].nunique() == 1 and found["identity_error"].max() < 1e-9
    signs = {}
    for key, x, _ in kept:
        own = found[found.vec_id == key].sort_values("component")
        assert own.component.tolist() == [1, 2, 3, 4]
        assert {int(v) for v in own.deviation} == {deviation[x]}
        assert np.allclose(own.explained, explained, rtol=1e-9)
        for k, value in enumerate(own.whitened):
            if abs(value) > 1e-6:
                signs.setdefault(k, math.copysign(1, value * whitened[x][k]))
            assert value == pytest.approx(signs.get(k, 1) * whitened[x][k], abs=1e-8)


def test_whitening_counts_as_weights(spark):
    rows = drawn(2, 200)
    found = whitening.whiten(table(spark, rows), weights="count").toPandas()
    x = np.array([v for _, v, _ in usable(rows, 6)], float)
    centred = x - x.mean(axis=0)
    values = np.linalg.eigvalsh(centred.T @ centred / len(x))[::-1]
    assert set(found["n"]) == {200}
    assert np.allclose(sorted(set(found["explained"]), reverse=True), values[:4] / values.sum(), rtol=1e-9)
    for k in (1, 2, 3, 4):
        z = found[found.component == k].whitened
        assert z.var(ddof=0) == pytest.approx(1, abs=1e-8) and found.identity_error.max() < 1e-8


def test_whitening_does_not_depend_on_partitions(spark):
    rows = table(spark, drawn(3, 400))
    few, many = [whitening.whiten(rows.repartition(k)).toPandas() for k in (1, 40)]
    order = ["vec_id", "component"]
    few, many = few.sort_values(order).reset_index(drop=True), many.sort_values(order).reset_index(drop=True)
    assert (few.deviation == many.deviation).all() and np.allclose(few.whitened, many.whitened, atol=1e-9)


def test_deviation_beyond_a_long_is_exact():
    x = np.array([[3, -(2**40)], [2**40, 5]])
    sums, n = (7 * 10**9, -(10**15)), 10**9
    expected = [sum((n * int(c) - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert whitening._long_deviations(x, n, sums, 2.0**40) == expected
    assert whitening._long_deviations(x * 2**22, n, sums, 2.0**62)[0] == sum((n * int(c) - s) ** 2 for c, s in zip(x[0].astype(object) * 2**22, sums))


def test_whitening_on_odd_input(spark):
    found = whitening.whiten(table(spark, ODD)).toPandas()
    kept, n, deviation, _, _ = brute_whitening(ODD, 3)
    assert len(found) == 3 * len(kept) and set(found["n"]) == {n}
    assert sorted(found["vec_id"].fillna(-1)) == sorted(3 * [-1 if k is None else k for k, _, _ in kept])
    assert all(d is None or int(d) in deviation.values() for d in found["deviation"])
    # One vector only: nothing varies.
    alone = whitening.whiten(table(spark, [(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1)])).toPandas()
    assert len(alone) == 4 and alone.whitened.isna().all() and alone.explained.isna().all() and alone.identity_error.isna().all()
    assert set(alone.copies) == {2} and {int(d) for d in alone.deviation} == {0}
    # A dimension that never varies.
    flat = whitening.whiten(table(spark, [(k, [k / 8, 0.5], 1) for k in range(9)])).toPandas()
    assert flat[flat.component == 2].whitened.isna().all() and flat[flat.component == 1].identity_error.max() < 1e-9
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None, 1), (2, [], 1)])).collect() == []


def test_whitening_query(spark):
    found = QUERIES["op12_whitening"](spark, FOLDER)
    assert dict(found.dtypes)["deviation"] == "bigint" and found.count() == 4 * 500


# 13 hard negatives


def brute_negatives(rows, size, is_anchor, positives=5, negatives=5, low=80, high=100):
    cut = gnat.Tree(size).cut
    kept = {(k, lab, tuple(int(max(-cut, min(cut, c))) for c in x)) for k, x, lab in usable(rows, size) if lab is not None}
    out = []

    def first(found, most):
        return sorted(found, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:most]

    for anchor in kept:
        if not is_anchor(anchor[0]):
            continue
        scored = [(sum(a * b for a, b in zip(anchor[2], r[2])), r[0], r[1]) for r in kept if r != anchor]
        for p, positive, _ in first([s for s in scored if s[2] == anchor[1]], positives):
            fitting = [s for s in scored if s[2] != anchor[1] and low * p <= 100 * s[0] <= high * p]
            out += [(anchor[0], positive, rank, k, p, s) for rank, (s, k, _) in enumerate(first(fitting, negatives), 1)]
    return sorted(out, key=repr)


def mined(frame, **more):
    found = gnat.hard_negatives(frame, anchors=F.col("vec_id") % 10 == 0, **more)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


def tens(key):
    return key is not None and key % 10 == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed):
    for name, value in (("SAMPLE_ROWS", 40), ("FANOUT", 3), ("LEVELS", 3), ("BLOCK_ROWS", 16), ("PACK_ROWS", 7)):
        monkeypatch.setattr(gnat, name, value)
    rows = drawn(seed, 250)
    expected = brute_negatives(rows, 6, tens)
    assert len(expected) > 100 and mined(table(spark, rows)) == expected


def test_hard_negatives_of_the_test_table(spark):
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in frame.collect()]
    expected = brute_negatives(rows, 64, lambda k: k % 100 == 0)
    found = QUERIES["op13_hard_negatives"](spark, FOLDER)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected


def test_hard_negatives_on_odd_input(spark):
    assert mined(table(spark, ODD)) == brute_negatives(ODD, 3, tens)
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(10, [1.0, 1.0], 1)])) == []
    assert mined(table(spark, [(10, [1.0, 1.0], 1), (11, [1.0, 1.0], 2)])) == []
    # Scores of 0 and below: 0 fits 0 only, and nothing lies between 80 and 100 percent of a negative score.
    signs = [(10, [0.5, 0.0], 1), (11, [0.0, 0.5], 1), (12, [0.0, -0.5], 2), (13, [-0.5, 0.0], 1), (14, [-0.5, 0.0], 2)]
    assert mined(table(spark, signs)) == brute_negatives(signs, 2, tens) == [(10, 11, 1, 12, 0, 0)]


def test_ranges_cover_all_rows_and_prune(spark, monkeypatch):
    monkeypatch.setattr(gnat, "SAMPLE_ROWS", 200)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    rows = [(k, (centres[k % 12] + rng.normal(size=8) / 50).tolist(), k % 3) for k in range(1200)]
    whole = vectors.whole_vectors(table(spark, rows), "embedding", {"key": F.col("vec_id"), "label": F.col("label").cast("long")})
    tree = gnat._planted(whole, 8)
    blocks = gnat._indexed(whole, tree)
    x = np.array([v for _, v, _ in usable(rows, 8)], np.int64)
    leaf = gnat.leaves(tree, x)
    sizes = {r["leaf"]: r["rows"] for r in blocks.groupBy("leaf").agg(F.sum(F.octet_length("keys") / 8).alias("rows")).collect()}
    assert sizes == {k: n for k, n in enumerate(np.bincount(leaf)) if n}
    for k, path in enumerate(tree.paths):
        for place, j in path:
            split, own = tree.splits[place], x[leaf == k]
            far = gnat.distances(own, split.points)
            assert (far >= split.low[:, j] - 1e-6).all() and (far <= split.high[:, j] + 1e-6).all()
    # The rows with a score as high as that of the tenth best lie in the leaves that stay, and most leaves go.
    square = (x.astype(float) ** 2).sum(axis=1)
    score = gnat.products(x, x)
    tenth = np.sort(score, axis=1)[:, -10].astype(float)
    stay = {(leaf_, q) for leaf_, qs in gnat._reached(tree, x, square, tenth, np.full(len(x), 9e18), np.arange(len(x))) for q in qs}
    for q in range(0, len(x), 7):
        assert {leaf[k] for k in np.flatnonzero(score[q] >= tenth[q])} <= {a for a, b in stay if b == q}
    assert len(stay) < 0.5 * len(x) * len(tree.paths)


def test_products_are_exact():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-(2**29), 2**29, size=(5, 16)), rng.integers(-(2**29), 2**29, size=(7, 16))
    assert (gnat.products(a, b) == (a.astype(object) @ b.T.astype(object))).all()
