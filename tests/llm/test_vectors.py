"""Whitening against exact fractions and numpy; neighbours against brute force; and the cases that the docstrings define."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import op12_whitening as op12
from millrace.llm import op13_learned_partitions as op13

BAD = [None, [], [1.0, None, 2.0, 3.0, 4.0, 5.0], [1.0, float("nan"), 2.0, 3.0, 4.0, 5.0], [1.0, float("inf"), 2.0, 3.0, 4.0, 5.0], [1.0, 2.0]]


def frame(spark, rows, name="embedding", key="vec_id"):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"`{key}` long, `{name}` array<double>, n int, `a.b` int").repartition(3)


def whitened_by_hand(rows, scale=256):
    x = {i: [int(np.floor(scale * c)) for c in v] for i, v in rows}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = lambda v: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)] for v in fit])
    e, q = np.linalg.eigh(centred.T @ centred / n)
    trace = float(Fraction(sum(map(deviation, fit)), n**3))
    return n, {i: deviation(v) for i, v in x.items()}, e[::-1], q[:, ::-1], trace, {i: np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)]) for i, v in x.items()}


def test_whitening_by_hand(spark):
    rng = np.random.default_rng(12)
    good = [(i, (rng.standard_normal(6) * [5, 3, 2, 1, 0.5, 0.1] + 100).tolist()) for i in range(150)]
    good += [(1000 + i, good[3][1]) for i in range(90)]  # a third of the rows is one vector
    got = op12.whitened(frame(spark, good + [(5000 + i, v) for i, v in enumerate(BAD)])).collect()
    n, deviation, e, q, trace, centred = whitened_by_hand(good)
    assert {r.vec_id for r in got} == {i for i, _ in good} and len(got) == 4 * len(good)
    assert {r.n for r in got} == {n} and all(r.deviation == deviation[r.vec_id] for r in got)
    assert max(r.identity_error for r in got) < 1e-9
    sign = {c: np.sign(next(r.whitened for r in got if r.component == c and r.vec_id == 0) * (centred[0] @ q[:, c - 1])) for c in range(1, 5)}
    for r in got:
        c = r.component - 1
        assert r.whitened == pytest.approx(sign[r.component] * (centred[r.vec_id] @ q[:, c]) / e[c] ** 0.5, abs=1e-8)
        assert r.explained == pytest.approx(e[c] / trace, rel=1e-10)


def test_whitening_cases(spark):
    flat = [(i, [float(i % 7), 2.0 * (i % 7), 1.0]) for i in range(30)]  # one direction only: three components are noise
    got = op12.whitened(frame(spark, flat)).collect()
    assert {r.component for r in got} == {1} and len(got) == 30 and got[0].explained == pytest.approx(1)
    assert op12.whitened(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert op12.whitened(frame(spark, [])).count() == 0 and op12.whitened(frame(spark, [(i, v) for i, v in enumerate(BAD[:5])])).count() == 0
    repeated = op12.whitened(frame(spark, [(None, [1.0, 2.0]), (7, [0.5, 2.0]), (7, [0.5, 2.0])])).collect()
    assert sorted((r.vec_id or 0) for r in repeated) == [0, 7, 7]
    named = op12.whitened(frame(spark, flat, "v.x", "component2"), "component2", "v.x")
    assert named.columns[0] == "component2" and named.count() == 30
    huge = op12.whitened(frame(spark, [(i, [1e30 * (i % 3), float(i)]) for i in range(9)])).collect()
    assert all(r.deviation is None for r in huge) and np.isfinite([r.whitened for r in huge]).all()
    large = [(i, [float(2**40 * (i % 5)), float(i % 3)]) for i in range(15)]  # squares beyond 64 bits on the way, sums exact
    small = op12.whitened(frame(spark, [(i, [x / 2**20 for x in v]) for i, v in large])).collect()
    _, deviation, *_ = whitened_by_hand([(i, [x / 2**20 for x in v]) for i, v in large])
    assert all(r.deviation == deviation[r.vec_id] for r in small)


SMALL = op13.Partitions(nearest=5, sample=400, degree=6, cell_rows=60, measured=60, block=50)


def brute(rows, chosen, nearest):
    rows = list({(i, tuple(v)): (i, np.array(v)) for i, v in rows}.values())
    return {i: sorted((-float(v @ w), j) for j, w in rows if j != i)[:nearest] for i, v in rows if chosen(i)}


def test_neighbours(spark):
    rng = np.random.default_rng(13)
    centres = rng.standard_normal((12, 8)) * 3
    rows = [(i, (centres[i % 12] + rng.standard_normal(8)).tolist()) for i in range(600)]
    rows[7] = (7, [10 * c for c in rows[7][1]])
    rows += [(1000 + i, (np.array(rows[5][1]) + 0.01 * rng.standard_normal(8)).tolist()) for i in range(200)]  # near copies
    rows += [(2000 + i, rows[7][1]) for i in range(300)] + rows[:4]  # copies, repeated rows
    table = frame(spark, rows + [(7000 + i, v) for i, v in enumerate([*BAD, [0.0] * 8])] + [(None, rows[0][1])])
    got = op13.neighbours(table, F.col("id") % 20 == 0, settings=SMALL).collect()
    want = brute(rows, lambda i: i % 20 == 0, 5)
    assert {r.query_id for r in got} == set(want) and len(got) == 5 * len(want)
    by = {q: sorted((r for r in got if r.query_id == q), key=lambda r: r.rank) for q in want}
    vector = dict(rows)
    hits = 0
    for q, found in by.items():
        assert [r.rank for r in found] == [1, 2, 3, 4, 5] and q not in {r.vec_id for r in found} and len({r.vec_id for r in found}) == 5
        for r in found:
            assert r.score == pytest.approx(float(np.dot(vector[q], vector[r.vec_id])), rel=1e-12)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        hits += len({r.vec_id for r in found} & {j for _, j in want[q]})
    assert hits >= 0.9 * 5 * len(want)
    copies = [r.vec_id for r in by[2000]]
    assert copies == [7, 2001, 2002, 2003, 2004]  # of equal vectors the smallest ids


def test_all_cells_are_exact(spark):
    rng = np.random.default_rng(14)
    rows = [(i, (rng.standard_normal(6) * (1 + i % 9)).tolist()) for i in range(400)]
    got = op13.neighbours(frame(spark, rows, "v.x", "k"), F.col("id") % 20 == 0, "k", "v.x", op13.Partitions(nearest=7, sample=300, cell_rows=40, recall=1.0, measured=400, block=64))
    want = brute(rows, lambda i: i % 20 == 0, 7)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got.collect()) == sorted((q, n, j) for q, near in want.items() for n, (_, j) in enumerate(near, 1))


def test_few_rows(spark):
    few = op13.neighbours(frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]), F.col("id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(few, key=lambda r: r.rank)] == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]
    assert op13.neighbours(frame(spark, [(0, [1.0])]), F.col("id") % 20 == 0).count() == 0
    assert op13.neighbours(frame(spark, []), F.col("id") % 20 == 0).count() == 0


def test_partitions_are_balanced_and_cut_few_edges(spark):
    rng = np.random.default_rng(15)
    x = rng.standard_normal((8, 10))[rng.integers(0, 8, 512)] * 4 + rng.standard_normal((512, 10))
    edges = op13.neighbour_graph(spark, x, 6)
    assert len(edges) == 512 * 6 and (edges[:, 0] != edges[:, 1]).all()
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    assert all(set(edges[edges[:, 0] == i, 1]) == set(np.argsort(-score[i])[:6]) for i in range(0, 512, 50))
    label = op13.partitioned(edges, 512, 8, 1)
    assert (np.bincount(label) == 64).all()
    inside = (label[edges[:, 0]] == label[edges[:, 1]]).mean()
    assert inside > 3 * (rng.permutation(label)[edges[:, 0]] == label[edges[:, 1]]).mean()
    router = op13.learned(x, edges, label, 8, 1)
    assert (router.probabilities(x).argmax(axis=1) == label).mean() > 0.6
