"""Hard negatives and whitening against plain Python, on small tables with odd rows."""

import math
import random
import struct

import numpy as np
import pytest
from candlestream.llm import hard_negatives, whitening
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, embedding array<float>, label int"
CLASHES = ("id", "x", "v", "anchor", "group", "chunk", "n", "rank", "place", "score", "component")


def single(values):
    """Doubles as they are after storing them in single precision."""
    return [None if v is None else struct.unpack("f", struct.pack("f", v))[0] for v in values]


def vectors(seed=5, n=260, dims=6):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        centre = [math.cos(k % 5 + d) for d in range(dims)]
        rows.append((k, single([c + rng.gauss(0, 0.4) for c in centre]), k % 3))
    copies = rows[7][1]
    rows += [(n + k, copies, k % 2) for k in range(90)]  # a third of the rows, and many ties
    rows += [
        (1000, None, 1), (1001, single([0.5] * dims), None), (1002, single([0.1] * (dims - 1)) + [None], 0),
        (1003, single([float("nan")] * dims), 0), (1004, single([float("inf")] * dims), 2),
        (None, single([0.5] * dims), 1), (1005, [0.0] * dims, 1), (1100, single([-1.0] * dims), 0),
        (1006, [], None), (14, rows[14][1], 2), (1200, rows[3][1], 77),
    ]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in CLASHES:
        df = df.withColumn(name, F.lit("x"))
    return df


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_negatives(rows, every, positives=5, negatives=10):
    rows = [(i, [math.floor(256 * x) for x in v], (l + 1) % 10 if i % 7 == 0 else l)
            for i, v, l in rows if i is not None and l is not None and usable(v)]
    out = []
    for a, v, label in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, l == label) for i, w, l in rows if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            inside = [(-t, i) for t, i, same in scored if not same and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, k, i, -s, t) for k, (t, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every, **sizes):
    source = hard_negatives.prepared(frame(spark, rows))
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(source.withColumn("label", label), F.col("id") % every == 0, **sizes)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("sizes", [{}, {"row_group": 37, "anchor_chunk": 4}])
def test_negatives_against_brute_force(spark, sizes):
    rows = vectors()
    expected = brute_negatives(rows, 10)
    assert len(expected) > 500
    assert mined(spark, rows, 10, **sizes) == expected


def test_scores_beyond_doubles_stay_exact(spark):
    rng = random.Random(2)
    rows = [(k, single([rng.uniform(0.5, 1) * 1e6 for _ in range(6)]), k % 2) for k in range(60)]
    assert mined(spark, rows, 5) == brute_negatives(rows, 5)
    wide = [(k, single([rng.uniform(0.5, 1) * 4e6 for _ in range(6)]), k % 2) for k in range(40)]
    assert mined(spark, wide, 5) == brute_negatives(wide, 5)


def test_a_score_beyond_a_bigint_is_an_error(spark):
    with pytest.raises(Exception, match="bigint"):
        mined(spark, [(k, [1e9] * 4, 0) for k in range(20)], 5)


def test_negatives_of_nothing(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(100, [1.0], 0)], 10) == []
    assert mined(spark, [(100, None, 0), (None, [1.0], 0)], 10) == []


def test_tree_bounds_hold():
    rng = np.random.default_rng(1)
    anchors, x = rng.integers(-50, 50, (30, 8)), rng.integers(-50, 50, (200, 8))
    tree = hard_negatives.spanning_tree(anchors)
    assert sorted(at for at, _, _ in tree) == list(range(30)) and tree[0][:2] == (0, 0)
    block = hard_negatives.Block(np.arange(200), np.zeros(200, int), x, 50)
    rescored = 0

    def sought(at, low, high):
        exact = x @ anchors[at]
        assert (low <= exact).all() and (exact <= high).all()
        return np.flatnonzero(high >= hard_negatives._largest(low, 3))

    for at, rows, scores in hard_negatives.walk(block, anchors, sought):
        exact = x @ anchors[at]
        assert (exact[rows] == scores).all()
        assert set(np.sort(exact)[-3:]) <= set(scores.tolist())
        rescored += len(rows)
    assert rescored < 30 * 200


def test_least_tree_is_least():
    points = np.array([[0, 0], [10, 0], [1, 0], [9, 0], [5, 0]])
    assert sum(length for _, _, length in hard_negatives.spanning_tree(points)) == pytest.approx(10)


def brute_whitening(rows, dims):
    kept = [(i, [math.floor(64 * x) + 1_000_000 for x in v]) for i, v, _ in rows if usable(v) and v and len(v) == dims]
    fit = {tuple(x) for _, x in kept}
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    v = np.array([[(n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j]) / n**2 for j in range(dims)] for i in range(dims)])
    return kept, fit, n, sums, v


def test_whitening_against_plain_python(spark):
    rows = vectors()
    kept, fit, n, sums, v = brute_whitening(rows, 6)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 6 * len(kept)
    values = np.linalg.eigvalsh(v)[::-1]
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    assert sorted(by) == [1, 2, 3, 4, 5, 6]
    expected = sorted((-1 if i is None else i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept)
    for k in by:
        assert sorted((-1 if r.vec_id is None else r.vec_id, r.deviation) for r in by[k]) == expected
    # Over the fit list, whitened values have mean 0 and covariance 1.
    place = {i: x for i, x in kept if i is not None and i != 14}
    seen, table = set(), []
    for i, x in place.items():
        if tuple(x) not in seen:
            seen.add(tuple(x))
            table.append([next(r.whitened for r in by[k] if r.vec_id == i) for k in sorted(by)])
    missing = fit - seen
    assert len(missing) == 1  # only the row without an id
    last = -np.array(table).sum(0)
    table = np.array([*table, last])
    assert np.abs(table.T @ table / n - np.eye(6)).max() < 1e-9


def test_components_without_variance(spark):
    rows = [(1, [1.0, 2.0, 5.0], 0), (2, [3.0, 2.0, 5.0], 0), (3, [3.0, 2.0, 5.0], 0), (4, [1.0, 2.0], 0), (5, [], 0)]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame(spark, rows)).collect()}
    assert sorted(got) == [(i, c) for i in (1, 2, 3) for c in (1, 2, 3)]
    assert abs(got[1, 1].whitened) == pytest.approx(1) and got[1, 1].whitened == -got[3, 1].whitened
    assert got[1, 1].explained == 1 and got[1, 2].explained == 0 and got[1, 2].whitened is None
    assert got[1, 1].identity_error < 1e-12
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0)] * 3)).collect()
    assert len(one) == 6 and {(r.whitened, r.identity_error, r.deviation) for r in one} == {(None, None, 0)}


def test_wide_ranges_are_exact(spark):
    rng = random.Random(4)
    rows = [(k, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 6, 9]), rng.uniform(-1, 1) * 1e7], 0) for k in range(80)]
    rows = [(i, single(v), l) for i, v, l in rows]
    kept, _, n, sums, v = brute_whitening(rows, 2)
    got = [r for r in whitening.whiten(frame(spark, rows)).collect() if r.component == 1]
    expected = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in kept}
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 2**63 else None for i, d in expected.items()}
    values = np.linalg.eigvalsh(v)
    assert got[0].explained == pytest.approx(values[-1] / values.sum(), rel=1e-9)


def test_cross_products_of_planes():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 1 << 20, (150, 5))
    sums = np.zeros((3, 5, 5), np.int64)
    whitening.add_products(sums, whitening.planes(y, 20))
    total = sum(sums[s].astype(object) << (16 * s) for s in range(3))
    assert (np.triu(total) == np.triu(y.T.astype(object) @ y.astype(object))).all()


def test_whitening_of_nothing(spark):
    empty = whitening.whiten(frame(spark, []))
    assert empty.collect() == [] and empty.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(frame(spark, [(1, None, 0), (2, [], 0), (3, [float("nan")], 0)])).collect() == []
