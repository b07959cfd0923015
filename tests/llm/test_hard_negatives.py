"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import hard_negatives as hn

_MOST = 2**63 - 1
_SCHEMA = "vec_id long, embedding array<double>, label int, row long, positives string"


def _whole(v):
    return [math.floor(x * 256) if abs(x) < 2.0**900 else int(x) * 256 for x in v]


def _brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    usable = [
        (i, k, _whole(v))
        for i, v, k in rows
        if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def score(a, b):
        return max(-_MOST, min(_MOST, sum(x * y for x, y in zip(a, b))))

    out = []
    for at, (anchor, label, v) in enumerate(usable):
        if not is_anchor(anchor):
            continue
        scored = [(-score(v, w), i, k) for n, (i, k, w) in enumerate(usable) if n != at]
        scored.sort(key=lambda x: x[:2])
        for s, pos, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(anchor, pos, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(fits)]
    return sorted(out)


def _mined(spark, rows, every, **options):
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], _SCHEMA)
    got = hn.mine_hard_negatives(df, F.col("vec_id") % every == 0, **options)
    assert got.dtypes[2] == ("rank", "int")
    return sorted(map(tuple, got.collect()))


def _random_rows(n, width, labels, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(labels, width))
    rows = []
    for i in range(n):
        v = centres[draw.integers(labels)] * draw.uniform(0.2, 1) + draw.normal(size=width) * 0.7
        v[draw.random(width) < 0.3] = 0
        rows.append((i, v.tolist(), int(draw.integers(labels))))
    return rows


@pytest.mark.parametrize("blocks", [(4096, 1024), (37, 5)])
def test_equals_brute_force(spark, blocks):
    rows = _random_rows(300, 20, 4, 3)
    # A third of all rows are copies of one vector with one label, and a few with another.
    rows += [(1000 + i, [0.5] * 20, 1) for i in range(150)] + [(2000 + i, [0.5] * 20, 2) for i in range(9)]
    rows += [(i, rows[i][1], rows[i][2]) for i in (0, 9, 10, 11)]  # repeated rows, anchors among them
    rows += [(5, [0.1] * 7, 3), (3000, [], 0), (3010, [], 0), (3020, [0.0] * 20, 1)]
    rows += [(None, [1.0] * 20, 1), (3030, None, 1), (3031, [None, 1.0], 1), (3032, [math.nan] * 20, 1)]
    rows += [(3033, [math.inf] * 20, 1), (3034, [1.0] * 20, None), (3040, [-3.0] * 20, 7), (3050, [1.0] * 20, 8)]
    got = _mined(spark, rows, 10, candidate_rows=blocks[0], anchor_rows=blocks[1])
    assert got == _brute(rows, lambda i: i % 10 == 0)
    assert got


def test_large_components_end_well(spark):
    rows = _random_rows(60, 4, 2, 5)
    rows += [(100, [1e18, 0.0, 0.0, 1.0], 0), (101, [1e300, 1.0, 0.0, 0.0], 1), (102, [2.0**40, 1.0, 1.0, 0.0], 0)]
    rows += [(103, [-1e308, 3.0, 0.0, 0.0], 1), (110, [2.0**31, 2.0, 0.0, 1.0], 1), (111, [0.0, 2.0**33, 0.0, 1.0], 0)]
    assert _mined(spark, rows, 10) == _brute(rows, lambda i: i % 10 == 0)


def test_windows_of_other_sizes(spark):
    rows = _random_rows(200, 8, 3, 8)
    got = _mined(spark, rows, 7, positives=2, negatives=9, low=20, high=60)
    assert got == _brute(rows, lambda i: i % 7 == 0, 2, 9, 20, 60)


def test_empty_tables_and_no_anchors(spark):
    assert _mined(spark, [], 10) == []
    assert _mined(spark, [(1, [1.0], 1), (2, [1.0], 2)], 10) == []
    assert _mined(spark, [(10, [1.0], 1)], 10) == []


def test_index_leaves_dimensions_out_and_loses_nothing():
    draw = np.random.default_rng(1)
    vectors = draw.integers(-60, 60, (500, 24)) * (draw.random((500, 24)) < 0.6)
    anchors = draw.integers(-60, 60, (17, 24))
    index = hn.ThresholdIndex(vectors)
    norms = np.sqrt((anchors**2).sum(axis=1))
    full = vectors @ anchors.T
    for share in (0.9, 0.5, 0.2, 0.0):
        bars = share * norms * index.longest
        index.cut(float((bars / norms).min()))
        held = sum(len(rows) for rows, _ in index.postings)
        assert held < np.count_nonzero(vectors) if share else held == np.count_nonzero(vectors)
        rows, which, products = index.search(anchors, bars)
        want = {(x, a, full[x, a]) for x, a in zip(*np.nonzero(full >= bars))}
        assert {*zip(rows.tolist(), which.tolist(), products.tolist())} == want
