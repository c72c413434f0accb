import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from squall.llm import hardneg


def plain(rows, is_anchor):
    """Brute force over (id, label, ints) rows."""
    out = []
    for a, (aid, alabel, avec) in enumerate(rows):
        if not is_anchor(aid):
            continue
        scored = [(-sum(x * y for x, y in zip(avec, v)), i, label) for b, (i, label, v) in enumerate(rows) if a != b]
        near = sorted((s, i) for s, i, label in scored if label == alabel)[:5]
        for place, (ps, pid) in enumerate(near, 1):
            hard = sorted((s, i) for s, i, label in scored if label != alabel and 30 * -ps <= 100 * -s <= 90 * -ps)[:10]
            out += [(aid, pid, r, i, -ps, -s, place) for r, (s, i) in enumerate(hard, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 9, "k", 1.0) for i, label, v in rows],
                                 "vec_id long, embedding array<float>, label int, row int, cell string, bound double")


def mined(df, **how):
    got = hardneg.mine(hardneg.participants(df), F.col("id") % 10 == 0, **how)
    return sorted(tuple(r) for r in got.collect())


def vectors(g, n, dims=12, centres=6):
    """Some directions are crowded, many rows are equal, lengths differ."""
    middle = [[g.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    rows = []
    for i in range(n):
        c = g.randrange(centres)
        v = [float(np.float32(x + g.gauss(0, 0.2))) for x in middle[c]]
        if i % 5 == 0:
            v = [float(np.float32(x)) for x in middle[0]]
        rows.append((i, c % 3 if g.random() < 0.7 else g.randrange(3), [x * g.choice([0.5, 1, 2]) for x in v]))
    return rows


def ints(rows):
    return [(i, label, [int(np.floor(256 * float(x))) for x in v]) for i, label, v in rows]


@pytest.mark.parametrize("how", [{"cluster": 8, "group": 5, "block": 16, "head": 2, "list_rows": 64}, {}])
def test_equals_brute_force(spark, how):
    rows = vectors(random.Random(1), 400)
    assert mined(table(spark, rows), **how) == plain(ints(rows), lambda i: i % 10 == 0)


def test_odd_rows(spark):
    g = random.Random(2)
    rows = vectors(g, 60, dims=4)
    nan, inf = float("nan"), float("inf")
    rows += [(70, 1, [1.0, 2.0]), (80, 1, []), (90, 2, [0.0] * 4), (91, 1, [9.0]), (10, 1, rows[3][2]), (10, 1, rows[3][2])]
    out = [(100, None, [1.0]), (110, 1, None), (120, 1, [1.0, None]), (130, 1, [nan, 1.0]), (140, 1, [inf]), (150, 1, [-inf, 0.0]), (160, 2, [1e30]), (None, 1, [5.0])]
    df = table(spark, rows + out)
    assert mined(df, cluster=4, group=3, block=8, head=1, list_rows=16) == plain(ints(rows), lambda i: i % 10 == 0)
    assert mined(df.where("false")) == []
    assert mined(df.where("vec_id = 91")) == []


def test_bounds_hold_for_every_member():
    g = np.random.Generator(np.random.PCG64(3))
    anchors, rows = (g.integers(-300, 300, (n, 8)) for n in (200, 300))
    centres = hardneg.centroids(anchors, 7)
    points, size = hardneg.unit(anchors)
    own = (points @ centres.T).argmax(axis=1)
    angle = np.arccos(np.clip((points @ centres.T).max(axis=1), -1, 1))
    widths = np.array([angle[own == c].max(initial=0) for c in range(7)])
    bound = hardneg.bounds(rows, centres, widths)
    got = hardneg.scores(anchors, rows)
    assert (got == anchors @ rows.T).all() and (got <= bound[:, own].T * size[:, None]).all()
    large = anchors * (1 << 24)
    assert (hardneg.scores(large, large) == large @ large.T).all()


def test_a_walk_ends_before_the_list_does():
    """Rows near the anchors' direction come first; those far from it need no score."""
    import pyarrow as pa

    g = np.random.Generator(np.random.PCG64(4))
    centre = np.zeros((1, 8))
    centre[0, 0] = 1
    near, far = np.zeros((50, 8), np.int64), np.zeros((50, 8), np.int64)
    near[:, 0], far[:, 1] = 1000 + np.arange(50), 1000
    asks = pa.array([{"row": 500 + i, "ask": 0, "label": 1, "low": hardneg.LEAST, "high": hardneg.MOST, "floor": hardneg.LEAST, "vec": [256, *g.integers(-5, 5, 7).tolist()]}
                     for i in range(3)], pa.struct([("row", pa.int64()), ("ask", pa.int32()), ("label", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
                                                    ("floor", pa.int64()), ("vec", pa.list_(pa.int32()))]))
    walk = hardneg.Walk(asks, 0, True, 5, centre, np.array([0.1]))
    walk.block(np.arange(50), np.arange(50), np.ones(50, np.int64), near)
    assert walk.least_bound() > hardneg.bounds(far, centre, np.array([0.1])).max()
    assert [i for k, i in zip(walk.best.held[0], walk.best.held[2]) if k == 0] == [49, 48, 47, 46, 45]
