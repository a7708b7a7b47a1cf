"""Hard negatives (11), whitening (12) and exact top-k (13) against brute force, on odd inputs too."""

import math
from fractions import Fraction
from itertools import product

import numpy as np
import pytest

from tillwise.llm import op11_hard_negatives as hard
from tillwise.llm import op12_whitening as white
from tillwise.llm import op13_top_k as top
from tillwise.llm.common import scratch
from tillwise.llm.vector_blocks import (
    NONE, Best, BlockFile, Extent, Scorer, extent, hilbert_keys, takes_part, write_blocks,
)

SCHEMA = "score double, vec_id bigint, embedding array<double>, label int, row string, q bigint, file_no int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    """``rows`` of (vec_id, embedding, label) between columns whose names clash with the operators' own."""
    return spark.createDataFrame([(0.5, i, e, c, "x" if n % 2 else None, n, None) for n, (i, e, c) in enumerate(rows)],
                                 SCHEMA).repartition(3)


def odd_rows(dim=6, n=160, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i * 10, [float(v) for v in rng.normal(0, 0.3, dim)], int(rng.integers(0, 3))) for i in range(n)]
    hot = rows[5][1]
    rows += [(i, hot, i % 2) for i in range(5_000, 5_060)]          # many copies of one vector
    rows += [(100, rows[3][1], 1), (100, rows[3][1], 1), (100, rows[4][1], 2)]  # an id of several rows
    rows += [(None, rows[0][1], 0), (None, rows[0][1], 1), (-200, rows[1][1], 1)]
    rows += [(200, None, 1), (300, [], 1), (400, [0.5, None], 1), (500, [NAN] * dim, 0), (600, [INF] + [0.1] * (dim - 1), 0)]
    rows += [(700, [0.4, 0.2], 1), (800, rows[7][1], None), (7_000, [0.0] * dim, 2), (7_100, [-0.0] * dim, 2)]
    return rows


def scaled(rows, scale):
    """(vec_id, floored vector, label) of the rows that take part; vectors as long as the longest."""
    fine = [(i, [math.floor(scale * x) for x in e], c) for i, e, c in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    dim = max((len(v) for _, v, _ in fine), default=0)
    return [(i, v + [0] * (dim - len(v)), c) for i, v, c in fine]


def last(i):
    return (i is None, i or 0)


def ranked(rows, me, mine):
    """Scores of all rows but ``me``, best first."""
    found = [(sum(a * b for a, b in zip(rows[me][1], v)), i, c) for n, (i, v, c) in enumerate(rows) if n != me]
    return sorted(((s, i, c) for s, i, c in found if mine(c)), key=lambda r: (-r[0], last(r[1])))


def brute_top(rows, every, k, scale=1024):
    rows, out = scaled(rows, scale), []
    for me, (i, _, _) in enumerate(rows):
        if i is not None and i % every == 0:
            out += [(i, n + 1, j, s) for n, (s, j, _) in enumerate(ranked(rows, me, lambda c: True)[:k])]
    return out


def brute_hard(rows, every, scale=256):
    rows, out = [r for r in scaled(rows, scale) if r[2] is not None], []
    for me, (i, _, label) in enumerate(rows):
        if i is None or i % every:
            continue
        others = ranked(rows, me, lambda c: c != label)
        for p, j, _ in ranked(rows, me, lambda c: c == label)[:5]:
            fits = [(s, o) for s, o, _ in others if 50 * p <= 100 * s <= 95 * p][:3]
            out += [(i, j, n + 1, o, p, s) for n, (s, o) in enumerate(fits)]
    return out


def same(found, wanted):
    key = lambda r: [last(v) for v in r]
    assert sorted((tuple(r) for r in found), key=key) == sorted(wanted, key=key)


@pytest.mark.parametrize("dim, bits", [(2, 4), (3, 2), (4, 2), (6, 1), (1, 5)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(dim, bits):
    cells = np.array(list(product(range(1 << bits), repeat=dim)))
    keys = hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("largest", [9, 2 ** 27, 2 ** 40])
def test_bounds_hold_every_product_and_products_are_exact(largest):
    rng = np.random.default_rng(3)
    shape = Extent(8, np.full(4, -float(largest)), np.full(4, float(largest)))
    scorer = Scorer(shape)
    a, b = (rng.integers(-largest, largest, (5, 4)).astype(shape.dtype) for _ in range(2))
    exact = [[min(max(sum(int(x) * int(y) for x, y in zip(u, v)), 1 - 2 ** 63), 2 ** 63 - 1) for v in b] for u in a]
    ready = scorer.ready(a)
    assert scorer.dots(ready, scorer.ready(b)).tolist() == exact
    low, high = scorer.bounds(ready, scorer.ready(b.min(axis=0)[None]), scorer.ready(b.max(axis=0)[None]))
    assert (low <= np.array(exact)).all() and (np.array(exact) <= high).all()


def test_best_keeps_the_first_k_in_any_order_of_offers():
    rng = np.random.default_rng(4)
    for _ in range(50):
        scores = rng.integers(0, 6, (3, 40))
        scores[rng.random(scores.shape) < 0.2] = NONE
        ids, rows, best = rng.integers(0, 20, 40), np.arange(40), Best(3, 4)
        for at in np.split(rng.permutation(40), [7, 8, 30]):
            best.offer(np.array([0, 2]), scores[[0, 2]][:, at], ids[at], rows[at])
        q, s, i, r = best.found()
        for x in (0, 1, 2):
            want = sorted((-int(scores[x, n]), int(ids[n]), n) for n in range(40) if x != 1 and scores[x, n] != NONE)[:4]
            assert [(-int(a), int(b), int(c)) for a, b, c in zip(s[q == x], i[q == x], r[q == x])] == want


def test_windows_are_whole_scores_within_the_percentages():
    scores = np.array([-(2 ** 62), -7, -1, 0, 1, 3, 40, 99, 100, 12_345, 2 ** 62])
    low, high = hard.window_of(scores, 50, 95)
    for s, a, b in zip(scores.tolist(), low.tolist(), high.tolist()):
        assert a == math.ceil(Fraction(s, 2)) and b == math.floor(Fraction(19 * s, 20))


@pytest.mark.parametrize("seed", [1, 2])
def test_searches_on_odd_rows_equal_brute_force(spark, seed):
    rows = odd_rows(seed=seed)
    same(top.top_k(frame(spark, rows), 100, 10).select("query_id", "rank", "vec_id", "score").collect(), brute_top(rows, 100, 10))
    same(hard.hard_negatives(frame(spark, rows), 50).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect(), brute_hard(rows, 50))


def test_searches_on_huge_components(spark):
    rows = [(i * 50, [x * 2.0 ** (i % 3 * 11), 1.0, -float(i)], i % 2) for i, x in enumerate([0.25, 5.5, -3.0, 7.0, 1.0, 2.0, 9.0])]
    same(top.top_k(frame(spark, rows), 100, 3).select("query_id", "rank", "vec_id", "score").collect(), brute_top(rows, 100, 3))
    rows = [(i * 100, [2.0 ** 40 + i * 2.0 ** 20, 3.0], 0) for i in range(4)]  # scores beyond a long saturate
    assert {r.score for r in top.top_k(frame(spark, rows), 100, 3).collect()} == {2 ** 63 - 1}


@pytest.mark.parametrize("rows", [[], [(0, None, 1), (50, [NAN], 1)], [(0, [], 1), (50, [], 2), (100, [], 1)]])
def test_nothing_to_search(spark, rows):
    same(top.top_k(frame(spark, rows), 100).select("query_id", "rank", "vec_id", "score").collect(), brute_top(rows, 100, 10))
    same(hard.hard_negatives(frame(spark, rows), 50).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect(), brute_hard(rows, 50))
    white.whiten(frame(spark, rows)).collect()


def test_bounds_skip_blocks_of_clustered_rows(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (40, 8))
    rows = [(i, [float(v) for v in centres[i % 40] + rng.normal(0, 0.02, 8)], 0) for i in range(60_000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").where(takes_part("embedding", 64))
    folder = scratch(spark, "clustered")
    manifest, shape = write_blocks(df, "embedding", 64, folder)
    scorer, scored, blocks = Scorer(shape), 0, 0
    for f in manifest.collect():
        part = BlockFile(folder, f.file_no, shape, scorer)
        q = scorer.ready(np.floor(64 * centres))
        best, n = top.search_file(part, np.full(40, -1), q, np.full(40, NONE), 10)
        scored, blocks = scored + n, blocks + 40 * len(part)
        held = [part.block(b) for b in range(len(part))]
        if held:
            scores = scorer.dots(q, scorer.ready(np.vstack([h[3] for h in held])))
            assert (np.sort(scores, axis=1)[:, ::-1][:, :10] == best.scores).all()
    assert scored < blocks / 3


# Whitening

def matrix_of(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    v = (q * np.array(values)) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [1, 1 + 1e-9, 1 + 2e-9, 0.5, 0.25], [1, 1, 1, 0.5], [2, 2, 2], [1e6, 1, 1e-6, 1e-6 + 1e-13], [0, 0, 0], [7],
    [1 + k * 1e-8 for k in range(20)] + [3.0, 3.0 + 1e-12], list(range(1, 65))])
def test_refined_eigenvectors_are_double_precision(values):
    a = matrix_of(values)
    _, start = np.linalg.eigh(a.astype(np.float32))
    found, x = white.refine(a, start)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(a.astype(np.longdouble) @ x - x * found).max() <= 1e-17 * len(a) * size
    assert np.abs(x.T @ x - np.eye(len(a))).max() <= 1e-17 * len(a)
    assert np.allclose(np.sort(found.astype(float)), np.sort(np.linalg.eigvalsh(a)), rtol=0, atol=1e-14 * len(a) * size)


def brute_white(rows, components=16):
    x = [(i, [v + 1_000_000 for v in z]) for i, z, _ in scaled(rows, 64)]
    fit = sorted({tuple(v) for _, v in x})
    n, dim = len(fit), len(fit[0])
    total = [sum(v[d] for v in fit) for d in range(dim)]
    cov = np.array([[float(Fraction(sum((n * v[a] - total[a]) * (n * v[b] - total[b]) for v in fit), n ** 3))
                     for b in range(dim)] for a in range(dim)])
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:components], vec[:, ::-1][:, :components]
    out = []
    for i, v in x:
        far = np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, total)])
        out.append((i, n, sum((n * a - s) ** 2 for a, s in zip(v, total)), far @ vec / np.sqrt(np.abs(e)), e / np.trace(cov)))
    return out, e


def check_white(spark, rows):
    want, e = brute_white(rows)
    found = white.whiten(frame(spark, rows)).collect()
    assert len(found) == len(want) * len(e)
    assert all(r.identity_error <= 1e-9 for r in found)
    sign = np.ones(len(e))
    key = lambda r: (last(r[0]), r[1], [round(abs(float(v)), 5) for v in r[2]])
    mine = {}
    rows_of = sorted(((r.vec_id, r.component, r) for r in found), key=lambda r: (last(r[0]), r[1]))
    for i, c, r in rows_of:
        mine.setdefault((last(i), int(r.deviation)), {}).setdefault(c, []).append(r)
    theirs = {}
    for i, n, dev, y, share in want:
        theirs.setdefault((last(i), dev), []).append((y, share, n))
    assert {k: len(v) for k, v in theirs.items()} == {k: len(v[1]) for k, v in mine.items()}
    for k, group in theirs.items():
        for c in range(len(e)):
            got = sorted(abs(r.whitened) for r in mine[k][c + 1])
            assert np.allclose(got, sorted(abs(y[c]) for y, _, _ in group), atol=1e-8)
            assert all(abs(r.explained - group[0][1][c]) < 1e-12 and r.n == group[0][2] for r in mine[k][c + 1])
    return found


def test_whitening_odd_rows_equals_brute_force(spark):
    check_white(spark, odd_rows())
    check_white(spark, odd_rows(dim=20, n=300, seed=6))


def test_whitening_huge_offsets_and_copies(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [20_000 + float(v) for v in rng.normal(0, 0.5, 3)], 0) for i in range(50)]
    rows += [(i, rows[0][1], 0) for i in range(100, 160)]
    found = check_white(spark, rows)
    assert found[0].n == 50


def test_components_without_variance_are_null(spark):
    rows = [(i, [float(i), 2.0 * i, 0.5], 0) for i in range(6)]
    found = white.whiten(frame(spark, rows)).collect()
    assert {r.component: r.whitened is None for r in found} == {1: False, 2: True, 3: True}
    assert {round(r.explained, 9) for r in found} == {1.0, 0.0} and found[0].identity_error < 1e-9
    alone = white.whiten(frame(spark, [(1, [0.5, 0.25], 0), (1, [0.5, 0.25], 0)])).collect()
    assert len(alone) == 4 and all(r.whitened is None and r.deviation == 0 and r.identity_error is None for r in alone)


def test_whitening_values_that_need_doubles(spark):
    rows = [(i, [2.0 ** 50 * i, float(i * i % 7)], 0) for i in range(9)]
    found = white.whiten(frame(spark, rows)).collect()
    assert len(found) == 18 and all(r.identity_error < 1e-6 for r in found)


def test_extent_counts_short_vectors_as_padded(spark):
    found = extent(frame(spark, [(1, [0.5, 0.25], 0), (2, [0.5], 0), (3, [], 0)]), "embedding", 4)
    assert found.rows == 3 and found.low.tolist() == [0, 0] and found.high.tolist() == [2, 1]
