"""Hard negatives: rows of other labels that come close to an anchor's positives, but not too close."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.topk import finite_vector, padded_matrix
from citeloom.sources.staged import new_stage_path, write_stage

#: Rows of one cell of the (candidates x anchors) grid, and anchors searched at once.
CANDIDATE_ROWS, ANCHOR_ROWS, TILE = 4096, 1024, 64
#: Thresholds tried, as shares of the largest product the norms allow; below the last, all is compared.
STEPS = (0.9, 0.75, 0.6, 0.45, 0.3, 0.15)
#: Dimensions between two prunings.
STRIDE = 8
_MOST = 2**63 - 1


class ThresholdIndex:
    """Integer vectors, searched for inner products of at least a threshold.

    Dimensions run from those of least energy to those of most. For a threshold
    relative to the anchor's norm, each vector's leading dimensions whose norm
    stays below it are left out of the postings: they alone cannot reach it.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        squares = np.square(vectors.astype(float))
        self.order = np.argsort(squares.sum(axis=0), kind="stable")
        self.vectors = np.ascontiguousarray(vectors[:, self.order])
        self.norms = self._prefix_norms(self.vectors)  # of the dimensions before each
        self.longest = float(self.norms[:, -1].max(initial=0))

    @staticmethod
    def _prefix_norms(vectors: np.ndarray) -> np.ndarray:
        sums = np.cumsum(np.square(vectors.astype(float)), axis=1)
        return np.sqrt(np.hstack((np.zeros((len(vectors), 1)), sums)))

    def cut(self, least: float) -> None:
        """Index for thresholds of at least ``least`` times the anchor's norm."""
        n, d = self.vectors.shape
        # Norms only grow along the dimensions, so the count is the place of the cut.
        self.first = np.maximum((self.norms < least * (1 - 1e-9)).sum(axis=1) - 1, 0)
        self.left_out = np.where(np.arange(d) < self.first[:, None], self.vectors, 0)
        self.postings = []
        for j in range(d):
            rows = np.flatnonzero((self.first <= j) & (self.vectors[:, j] != 0))
            self.postings.append((rows, self.vectors[rows, j]))

    def search(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, product) of all products that reach the anchor's threshold.

        Partial products are accumulated from the last dimension on; a row goes
        when with the norms that remain no anchor's threshold can be reached.
        """
        asked = anchors[:, self.order]
        own = np.ascontiguousarray(self._prefix_norms(asked).T)
        weights = np.ascontiguousarray(asked.T)
        n, d = self.vectors.shape
        scores = np.zeros((n, len(anchors)), np.int64)
        live = np.ones(n, bool)
        # Sums of rounded squares may fall short of the norms by parts in 10^13.
        bars = thresholds - 1e-9 * np.abs(thresholds) - 1.0

        def reachable(rows: np.ndarray, place: int) -> np.ndarray:
            open_until = np.maximum(self.first[rows], place)
            rest = self.norms[rows, open_until][:, None] * own[open_until] * (1 + 1e-9)
            return scores[rows] + rest >= bars

        for j in range(d - 1, -1, -1):
            rows, values = self.postings[j]
            if not live.all():
                still = live[rows]
                rows, values = rows[still], values[still]
            if len(rows):
                scores[rows] += values[:, None] * weights[j]
            if j and j % STRIDE == 0:
                rows = np.flatnonzero(live)
                live[rows] = reachable(rows, j).any(axis=1)
                if not live.any():
                    break
        rows = np.flatnonzero(live)
        at, anchor = np.nonzero(reachable(rows, 0))
        found = rows[at]
        products = scores[found, anchor] + np.einsum("ij,ij->i", self.left_out[found], asked[anchor])
        enough = products >= thresholds[anchor]
        return found[enough], anchor[enough], products[enough]


def whole_terms(vectors: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Components as ``floor(scale * x)``, and which rows are too large for 64-bit products.

    The terms of such rows are 0 here; ``wide_product`` has their products.
    """
    with np.errstate(over="ignore"):
        terms = np.floor(vectors * scale)
    wide = np.abs(terms).max(axis=1, initial=0) > math.isqrt(2**62 // max(vectors.shape[1], 1))
    return np.where(wide[:, None], 0, terms).astype(np.int64), wide


def wide_product(a: np.ndarray, b: np.ndarray, scale: int) -> int:
    """Exact inner product of the terms, or the nearest 64-bit integer."""
    whole = lambda x: math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale
    exact = sum(whole(x) * whole(y) for x, y in zip(a.tolist(), b.tolist()))
    return max(-_MOST, min(_MOST, exact))


def fill_windows(
    vectors: np.ndarray,
    ids: np.ndarray,
    anchors: np.ndarray,
    allowed: np.ndarray,
    windows: list[list[tuple[int, int]]],
    need: int,
    scale: int,
) -> list[list[list[tuple[int, int]]]]:
    """Per anchor and window ``(low, high)`` the first ``need`` rows with a product in it.

    Rows are ``(row, product)`` by falling product, then by id; ``allowed``
    tells for each row and anchor if the row may count. Thresholds are lowered
    until every window is full or lies wholly above its threshold.
    """
    result: list[list[list[tuple[int, int]]]] = [[[] for _ in w] for w in windows]
    terms, wide = whole_terms(vectors, scale)
    asked, wide_asked = whole_terms(anchors, scale)
    narrow = np.flatnonzero(~wide)
    index = ThresholdIndex(terms[narrow])
    norms = np.sqrt(np.square(asked.astype(float)).sum(axis=1))
    extra = {
        a: [(int(x), wide_product(vectors[x], anchors[a], scale)) for x in (range(len(vectors)) if wide_asked[a] else np.flatnonzero(wide)) if allowed[x, a]]
        for a in range(len(anchors))
        if wide_asked[a] or wide.any()
    }

    def settle(a: int, rows: np.ndarray, products: np.ndarray, threshold: float) -> bool:
        """Fill the windows from all products of at least the threshold; True if they are final."""
        more = extra.get(a, [])
        rows = np.concatenate((rows, np.array([x for x, _ in more], np.int64)))
        products = np.concatenate((products, np.array([s for _, s in more], np.int64)))
        order = np.lexsort((ids[rows], -products))
        rows, products = rows[order], products[order]
        final = True
        for k, (low, high) in enumerate(windows[a]):
            inside = (products <= high) & (products >= max(low, threshold) if threshold > -math.inf else products >= low)
            place = np.flatnonzero(inside)[:need]
            result[a][k] = list(zip(rows[place].tolist(), products[place].tolist()))
            final &= len(place) == need or threshold <= low or low > high
        return final

    none = np.zeros(0, np.int64)
    open_ = []
    for a in range(len(anchors)):
        if wide_asked[a]:
            settle(a, none, none, -math.inf)
        elif any(low <= high for low, high in windows[a]):
            open_.append(a)
    for step in (*STEPS, None):
        if not open_:
            break
        bars = {}
        for a in open_:
            low = min(w[0] for w in windows[a] if w[0] <= w[1])
            high = max(w[1] for w in windows[a] if w[0] <= w[1])
            bar = math.nextafter(low, -math.inf)  # at most low, whatever a float can hold
            if step is not None:
                bar = max(bar, step * norms[a] * index.longest)
            if step is None and low <= -_MOST:
                bar = -math.inf
            if bar <= high or step is None:
                bars[a] = bar
        if not bars:
            continue
        positive = [b / norms[a] for a, b in bars.items() if norms[a] > 0]
        index.cut(max(min(positive, default=0.0), 0.0))
        todo = list(bars)
        for start in range(0, len(todo), TILE):
            part = todo[start : start + TILE]
            marks = np.array([bars[a] for a in part])
            found, which, products = index.search(asked[part], np.maximum(marks, -float(_MOST)))
            fits = allowed[narrow[found], np.array(part)[which]]
            found, which, products = narrow[found[fits]], which[fits], products[fits]
            order = np.argsort(which, kind="stable")
            ends = np.searchsorted(which[order], np.arange(len(part) + 1))
            for k, a in enumerate(part):
                mine = order[ends[k] : ends[k + 1]]
                if settle(a, found[mine], products[mine], bars[a]):
                    open_.remove(a)
    return result


def _split(cell: pa.Table) -> tuple[pa.Table, pa.Table, np.ndarray, np.ndarray]:
    asks = cell["is_anchor"].to_numpy().astype(bool)
    vectors = padded_matrix(cell["vector"]).astype(float)
    return cell.filter(pa.array(~asks)), cell.filter(pa.array(asks)), vectors[~asks], vectors[asks]


def _positives(need: int, scale: int):
    def search(cell: pa.Table) -> pa.Table:
        rows, anchors, vectors, asked = _split(cell)
        own = rows["row"].to_numpy()[:, None] != anchors["row"].to_numpy()[None, :]
        ids = rows["vec_id"].to_numpy()
        everything = [[(-_MOST, _MOST)]] * len(asked)
        best = fill_windows(vectors, ids, asked, own, everything, need, scale)
        out = [(int(r), int(ids[x]), s) for r, (found,) in zip(anchors["row"].to_pylist(), best) for x, s in found]
        columns = list(zip(*out)) or [()] * 3
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("row", "id", "score"), columns)})

    return search


def _negatives(need: int, low: int, high: int, scale: int):
    def search(cell: pa.Table) -> pa.Table:
        rows, anchors, vectors, asked = _split(cell)
        _, kinds = np.unique(np.array(rows["label"].to_pylist() + anchors["label"].to_pylist(), object).astype(str), return_inverse=True)
        other = kinds[: len(rows), None] != kinds[None, len(rows) :]
        ids = rows["vec_id"].to_numpy()
        goals = anchors["positives"].to_pylist()
        windows = [[(-(-low * g["score"] // 100), high * g["score"] // 100) for g in mine] for mine in goals]
        best = fill_windows(vectors, ids, asked, other, windows, need, scale)
        out = [
            (row, anchor, place, goal["id"], goal["score"], int(ids[x]), s)
            for row, anchor, mine, filled in zip(anchors["row"].to_pylist(), anchors["vec_id"].to_pylist(), goals, best)
            for place, (goal, found) in enumerate(zip(mine, filled))
            for x, s in found
        ]
        columns = list(zip(*out)) or [()] * 7
        names = ("row", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return search


def _cells(df: DataFrame, down: Column, across: Column, anchor_only: Column) -> DataFrame:
    """Every block of candidates meets every block of anchors in a cell of its own.

    ``anchor_only`` is true for the rows that are dealt as anchors.
    """
    place = F.xxhash64("row")
    cell = lambda k, a: F.struct(k.cast("long").alias("cell"), F.lit(a).alias("is_anchor"))
    as_candidate = F.transform(F.sequence(F.lit(0), across - 1), lambda q: cell(F.pmod(place, down) * across + q, False))
    as_anchor = F.transform(F.sequence(F.lit(0), down - 1), lambda c: cell(c * across + F.pmod(place, across), True))
    none = F.array().cast("array<struct<cell:bigint,is_anchor:boolean>>")
    wanted = F.concat(F.when(across > 0, as_candidate).otherwise(none), F.when(anchor_only, as_anchor).otherwise(none))
    return df.withColumn("at", F.explode(wanted)).select("*", "at.cell", "at.is_anchor").drop("at")


def mine_hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    candidate_rows: int = CANDIDATE_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """For each anchor and each of its positives the best rows of other labels within a window.

    Components become ``floor(scale * x)`` in double precision and scores are
    integer inner products. An anchor's positives are its ``positives`` best
    other rows of the same label; a positive's negatives the ``negatives`` best
    rows of other labels whose score is between ``low`` and ``high`` percent of
    the positive's. Ties go to the smaller id.

    Rows are dealt into blocks of bounded size, for the positives per label, and
    each block of candidates meets each block of anchors in a cell. In a cell
    the windows are filled from an index of postings at falling thresholds
    (``ThresholdIndex``); the cells' best are merged per window. All pairs of
    blocks meet, as every row is a candidate for every anchor.

    Rows with a null id, a null label, a null vector or null or non-finite
    components take no part. Shorter vectors count as padded with zeros.
    Repeated rows are rows of their own: a repeated anchor is answered once per
    row and its copies may be its positives. A negative positive score has no
    window; one of 0 has the scores of 0. Scores beyond 64 bits count as the
    nearest 64-bit number. An empty table, or one without anchors, gives no
    rows; other columns are ignored.
    """
    spark = rows.sparkSession
    usable = rows.where(
        finite_vector(vector_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    ).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("asks"),
    )
    # Numbered in a written table, so that a lost executor cannot change the numbers.
    staged = write_stage(usable.withColumn("row", F.monotonically_increasing_id()), new_stage_path(spark, "vectors"))
    blocks = lambda n, size: F.ceil(n / F.lit(size)).cast("long")
    sizes = staged.groupBy("label").agg(
        F.greatest(blocks(F.count("*"), candidate_rows), F.lit(1)).alias("down"),
        blocks(F.count_if("asks"), anchor_rows).alias("across"),
    )
    alike = _cells(staged.join(sizes.where("across > 0"), "label"), F.col("down"), F.col("across"), F.col("asks"))
    near = alike.groupBy("label", "cell").applyInArrow(_positives(positives, scale), "row long, id long, score long")
    by_score = Window.partitionBy("row").orderBy(F.col("score").desc(), "id")
    goals = (
        near.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= positives)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    )
    goals = write_stage(goals, new_stage_path(spark, "positives"))
    count, asked = staged.agg(F.count("*"), F.count_if("asks")).first()
    down, across = max(1, math.ceil(count / candidate_rows)), math.ceil(asked / anchor_rows)
    known = _cells(staged, F.lit(down), F.lit(across), F.lit(False)).withColumn("positives", F.lit(None).cast(goals.schema["positives"].dataType))
    asking = _cells(staged.where("asks").join(goals, "row"), F.lit(down), F.lit(across), F.lit(True)).where("is_anchor")
    found = known.unionByName(asking).groupBy("cell").applyInArrow(
        _negatives(negatives, low, high, scale),
        "row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    by_score = Window.partitionBy("row", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
