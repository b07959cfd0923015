"""Near-duplicates of texts and vectors, and exact search, against brute force."""

import math
import random

import numpy as np
import pytest
import xxhash

from citeloom.llm import embedding_dedup, simhash, topk
from citeloom.llm.components import connected_components, merge_links


def _components(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    draw = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)]
    pairs += [(300, 301), (301, 302), (302, 300), (400, 400)]
    pairs += [(draw.randrange(500, 700), draw.randrange(500, 700)) for _ in range(150)]
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.id: r.component for r in connected_components(df).collect()}
    assert got == {n: c for n, c in _components(nodes | {400}, pairs).items() if n in nodes}
    assert connected_components(df.where("false")).count() == 0


def test_merge_links():
    labels = merge_links(np.arange(6), np.array([5, 3, 1]), np.array([3, 1, 4]))
    assert labels.tolist() == [0, 1, 2, 1, 1, 1]


def _print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    texts = ["", "  ", "One", "one TWO", "a b c", "Ä b c d e f", "x y z " * 400, "Ünïcode stays as IT is"]
    want = [_print(t) for t in texts]
    assert [simhash.fingerprint(t.encode()) for t in texts] == want
    real = simhash.word_segments
    monkeypatch.setattr(simhash, "word_segments", lambda d: real(d, 5))
    assert [simhash.fingerprint(t.encode()) for t in texts] == want


@pytest.mark.parametrize("spread", [2, 64])
def test_tree_finds_every_pair(spread):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = np.unique(
        np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, spread, 40, dtype=np.uint64)) for _ in range(30))])
    )
    want = {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(prints[:, None] ^ prints) <= 2), strict=True)}
    tree, shards = simhash.grow_tree(prints, 12)
    assert shards > 1
    home = dict(zip(*simhash.route(tree, prints, 0), strict=True))
    asked = set(zip(*simhash.route(tree, prints, 2), strict=True))
    assert all((j, home[i]) in asked for i, j in want)
    found = [(i, j) for s, q in simhash.near_pairs(prints, prints) for i, j in zip(s, q, strict=True)]
    assert len(found) == len(set(found)) and set(found) == want


def test_near_texts(spark):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(60):
        text = [draw.choice(words) for _ in range(200)]
        for _ in range(draw.randrange(1, 4)):
            copy = list(text)
            copy[draw.randrange(200)] = "changed"
            rows.append((len(rows) + 10, " ".join(copy), g))
    rows += [(1, None, 0), (2, "", 0), (3, " \n", 0), (500, rows[0][1], 0), (500, rows[0][1], 0), (None, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, print long")
    got = simhash.near_duplicates(df).collect()
    prints = [_print(t) for _, t, _ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    least = {}
    label = _components(range(len(rows)), pairs)
    for n, c in label.items():
        if rows[n][0] is not None:
            least[c] = min(least.get(c, math.inf), rows[n][0])
    want = [(rows[n][0], f"{prints[n]:016x}", least[c]) for n, c in label.items()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(df.where("false")).count() == 0


_VECTORS = "vec_id long, embedding array<float>, copies int"


def test_near_vectors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((120, 24)).astype(np.float32)
    rows = [b.tolist() for b in base]
    rows += [(b + 0.12 * rng.standard_normal(24)).astype(np.float32).tolist() for b in base[:50] for _ in range(2)]
    rows += [base[0].tolist()] * 40 + [(2 * base[1]).tolist()]
    odd = [None, [], [0.0] * 24, [math.nan] + [1.0] * 23, [math.inf] + [0.0] * 23, [None] + [1.0] * 23, base[5, :20].tolist()]
    order = rng.permutation(len(rows) + len(odd))
    table = [(int(i), v, 1) for i, v in zip(order, rows + odd, strict=True)]
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(spark.createDataFrame(table, _VECTORS)).collect()}
    good = {
        i: np.pad(np.array(v, float), (0, 24 - len(v)))
        for i, v, _ in table
        if v and None not in v and np.isfinite(v).all() and np.any(v)
    }
    ids = sorted(good)
    unit = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    linked = unit @ unit.T >= 0.9
    pairs = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(linked), strict=True) if i != j]
    want = _components(got, pairs)
    links = {i: 0 for i in got}
    for a, _ in pairs:
        links[a] += 1
    assert len(got) == len(table)
    # The tables may miss pairs, but never add any.
    assert all(got[i].n_links <= links[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(links.values())
    assert sum(got[i].component_id == want[i] for i in got) >= 0.97 * len(got)
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert embedding_dedup.near_vectors(spark.createDataFrame([], _VECTORS)).count() == 0


def test_large_bucket_is_cut_and_counted_once(spark):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.01 * rng.standard_normal(16)).tolist(), 0) for i in range(1300)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, _VECTORS)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(1299, 0)}


def test_rotations_keep_length():
    index = embedding_dedup.CrossPolytope(20, 2, 3)
    unit = np.eye(32)[:5]
    turned = index.rotate(unit, index.signs[0, 0])
    assert np.allclose(np.linalg.norm(turned, axis=1), 1)
    own, probes = index.keys(unit)
    assert own.shape == (5, 3) and probes.shape == (5, 3, 2) and (probes != own[..., None]).all()


def test_top_k(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(9).round(1).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(30)]  # ties beyond k
    rows += [(500, None), (501, [math.nan] * 9), (502, [None] * 9), (520, [math.inf] * 9), (540, []), (560, [1.0, -2.0]), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    from pyspark.sql import functions as F

    got = topk.exact_top_k(df, F.col("vec_id") % 20 == 0, k=5, candidate_rows=90, query_rows=4).collect()
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for q, (i, v) in enumerate(good):
        if i % 20 == 0:
            scores = [
                (-sum(a * b for a, b in zip(v, w, strict=False)), j)
                for c, (j, w) in enumerate(good)
                if c != q
            ]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:5])]
    assert sorted(map(tuple, got)) == sorted(want)
    few = topk.exact_top_k(df.where("vec_id < 3"), F.col("vec_id") == 1).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(1, 1), (1, 2), (1, 3)]
    assert topk.exact_top_k(df.where("false"), F.col("vec_id") == 1).count() == 0


def test_large_components_end_well(spark):
    draw = np.random.default_rng(12)
    rows = [(i, draw.standard_normal(5).round(2).tolist()) for i in range(60)]
    rows += [(60, [1e18] * 5), (61, [-1e18, 0.0, 0.0, 0.0, 0.0]), (62, [2.0**40, -(2.0**40), 0.5, 0.0, 1e9]), (63, [1e300] * 5)]
    rows += [(64, [1e308, 0.0]), (80, [1e18, 1.0]), (81, [3e9, 0.0]), (100, [0.0, -3e9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    got = topk.exact_top_k(df, F.col("vec_id") % 20 == 0, k=70, candidate_rows=17, query_rows=2).collect()
    top = (1 << 63) - 1
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i != 64]
    want = []
    for i, v in good:
        if i % 20 == 0:
            scores = [
                (-max(-top, min(top, sum(a * b for a, b in zip(v, w, strict=False)))), j)
                for j, w in good
                if j != i
            ]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores))]
    assert sorted(map(tuple, got)) == sorted(want)
    assert {r.score for r in got} >= {top, -top}


def test_one_id_with_several_vectors_and_extreme_lengths(spark):
    axis = lambda k, x=1.0: [x if i == k else 0.0 for i in range(8)]
    near = [1.0, 0.1] + [0.0] * 6
    rows = [(1, axis(0)), (1, axis(1)), (2, near), (3, axis(5)), (4, axis(4, 1e200)), (5, axis(4, 2e-200)), (5, axis(4, -1.0))]
    rows += [(6, [0.0] * 4 + [1e200, 1e190, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(
        ((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(df).collect())
    )
    assert got == [
        (1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True),
        (4, 2, 4, True), (5, 0, 5, True), (5, 2, 4, False), (6, 2, 4, False),
    ]
