"""Exact top-k by inner product, term at a time over blocks of postings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one cell of the (candidates x queries) grid.
CANDIDATE_ROWS, QUERY_ROWS = 4096, 1024
#: Score arrays are filled in tiles that fit a core's cache.
TILE = 256
#: Scores are 64-bit; the least number marks a query's own row.
LARGEST, OWN = (1 << 63) - 1, -(1 << 63)


def finite_vector(column: str) -> Column:
    """True where the vector is not null and every component is a finite number."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return F.col(column).isNotNull() & ~bad


def scatter_scores(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Scores of every candidate row (first axis) for every query row.

    For each term the query weights are scattered along the term's postings,
    the candidates that hold it, into dense score arrays.
    """
    terms = candidates.shape[1]
    peak = max(int(np.abs(candidates).max(initial=0)), 1) * max(int(np.abs(queries).max(initial=0)), 1)
    kind = np.int32 if peak * max(terms, 1) < 2**31 else np.int64
    c, q = candidates.astype(kind), queries.astype(kind)
    scores = np.zeros((len(c), len(q)), kind)
    for top in range(0, len(c), TILE):
        rows = c[top : top + TILE]
        postings = [np.flatnonzero(rows[:, t]) for t in range(terms)]
        for left in range(0, len(q), TILE):
            part = q[left : left + TILE]
            tile = np.zeros((len(rows), len(part)), kind)
            for t, hold in enumerate(postings):
                asked = part[:, t]
                if not len(hold) or not asked.any():
                    continue
                if len(hold) == len(rows):
                    tile += rows[:, t, None] * asked
                else:
                    tile[hold] += rows[hold, t, None] * asked
            scores[top : top + TILE, left : left + TILE] = tile
    return scores


def wide_scores(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """As ``scatter_scores``, in integers of any size, held to 64 bits in the end."""
    scores = np.zeros((len(candidates), len(queries)), np.int64)
    whole = np.frompyfunc(int, 1, 1)
    c, q = whole(candidates).astype(object), whole(queries).astype(object)
    for top in range(0, len(c), TILE):
        exact = np.zeros((len(c[top : top + TILE]), len(q)), object)
        for t in range(c.shape[1]):
            exact += c[top : top + TILE, t, None] * q[:, t]
        scores[top : top + TILE] = np.clip(exact, -LARGEST, LARGEST).astype(np.int64)
    return scores


def cell_scores(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Scores of rows of whole doubles; only rows whose products may pass 64 bits leave the fast way."""
    bar = math.isqrt((1 << 61) // max(candidates.shape[1], 1))
    wide_c, wide_q = (np.abs(x).max(axis=1, initial=0) > bar for x in (candidates, queries))
    scores = np.zeros((len(candidates), len(queries)), np.int64)
    narrow = candidates[~wide_c].astype(np.int64), queries[~wide_q].astype(np.int64)
    scores[np.ix_(~wide_c, ~wide_q)] = scatter_scores(*narrow)
    if wide_c.any():
        scores[wide_c] = wide_scores(candidates[wide_c], queries)
    if wide_q.any():
        scores[np.ix_(~wide_c, wide_q)] = wide_scores(candidates[~wide_c], queries[wide_q])
    return scores


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query row, candidate row) of each query's k best scores, ties to smaller ids.

    ``scores`` has a row per query. Everything at least as good as the k-th
    score is selected first, so that ties are settled by id and not by place.
    """
    n = scores.shape[1]
    if n > k:
        bar = np.partition(scores, n - k, axis=1)[:, n - k, None]
        q, c = np.nonzero(scores >= bar)
    else:
        q, c = np.nonzero(np.ones_like(scores, bool))
    order = np.lexsort((ids[c], -scores[q, c].astype(np.int64), q))
    q, c = q[order], c[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], c[rank < k]


def padded_matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """A column of lists as rows of one width, the widest if none is given, padded with zeros."""
    lists = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _cell(k: int):
    def score(cell: pa.Table) -> pa.Table:
        asks = cell["is_query"].to_numpy().astype(bool)
        ids, rows = cell["vec_id"].to_numpy(), cell["row"].to_numpy()
        vectors = padded_matrix(cell["terms"])
        scores = cell_scores(vectors[~asks], vectors[asks]).T
        own = {r: i for i, r in enumerate(rows[~asks])}
        for i, r in enumerate(rows[asks]):
            if r in own:
                scores[i, own[r]] = OWN
        q, c = best_rows(scores, ids[~asks], k)
        found = scores[q, c]
        real = found > OWN
        return pa.table(
            {
                "query_row": pa.array(rows[asks][q][real], pa.int64()),
                "query_id": pa.array(ids[asks][q][real], pa.int64()),
                "vec_id": pa.array(ids[~asks][c][real], pa.int64()),
                "score": pa.array(found[real], pa.int64()),
            }
        )

    return score


def exact_top_k(
    vectors: DataFrame,
    query: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidate_rows: int = CANDIDATE_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Each query's k rows of highest inner product, over all rows but its own.

    Components become ``floor(scale * x)`` in double precision. Queries and
    candidates are dealt into blocks of bounded size, every block of queries
    meets every block of candidates in a cell of its own, and the cells' best k
    are merged per query. Vectors that are null, or hold null or non-finite
    components, take no part; a shorter vector counts as padded with zeros; an
    empty vector scores 0. Rows with a null id take no part. Repeated rows are
    rows of their own: a repeated query is answered once per row, and only its
    own row is left out. Fewer than k candidates are all returned; other
    columns are ignored. Scores beyond 64 bits are given as the nearest of
    +-(2^63 - 1), and tie there; a vector with a component whose scaled value is
    beyond doubles takes no part.
    """
    scaled = F.transform(vector_col, lambda x: x.cast("double") * scale)
    # Doubles that do not fit a long are whole already; whole ones shuffle smaller.
    whole = lambda x: F.when(F.abs(x) < 2.0**62, F.floor(x).cast("double")).otherwise(x)
    usable = vectors.where(
        finite_vector(vector_col)
        & ~F.exists(scaled, lambda x: F.abs(x) == F.lit(math.inf))
        & F.col(id_col).isNotNull()
    ).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(scaled, whole).alias("terms"),
        F.coalesce(query, F.lit(False)).alias("asks"),
        # Only tells rows apart and deals them out; the result does not depend on it.
        F.monotonically_increasing_id().alias("row"),
    )
    rows, asked = usable.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    down = max(1, math.ceil(rows / candidate_rows))
    across = max(1, math.ceil(asked / query_rows))
    place = F.xxhash64("row")
    mine = F.pmod(place, F.lit(down)) * across
    mine_asked = F.pmod(place, F.lit(across))
    cell = lambda number, is_query: F.struct(
        number.cast("long").alias("cell"), F.lit(is_query).alias("is_query")
    )
    cells = F.concat(
        F.transform(F.sequence(F.lit(0), F.lit(across - 1)), lambda q: cell(mine + q, False)),
        F.when(
            F.col("asks"),
            F.transform(
                F.sequence(F.lit(0), F.lit(down - 1)), lambda c: cell(c * across + mine_asked, True)
            ),
        ).otherwise(F.array().cast("array<struct<cell:bigint,is_query:boolean>>")),
    )
    dealt = usable.withColumn("at", F.explode(cells)).select(
        "at.cell", "at.is_query", "vec_id", "row", "terms"
    )
    best = dealt.groupBy("cell").applyInArrow(
        _cell(k), "query_row long, query_id long, vec_id long, score long"
    )
    merged = Window.partitionBy("query_row", "query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(merged))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
