"""Near-duplicate vectors by cross-polytope hashing, with every candidate verified."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.components import connected_components, merge_links
from citeloom.llm.topk import finite_vector, padded_matrix
from citeloom.sources.staged import new_stage_path, write_stage

COSINE = 0.9
SEED = 20_231
#: Share of pairs at exactly the threshold that the tables are to find; closer pairs are found more often.
RECALL = 0.995
#: Rows of a bucket compared in one cell; larger buckets are cut into blocks that all meet.
BLOCK = 512
#: Rows of small buckets that one task call handles together.
TOGETHER = 2_048


class CrossPolytope:
    """Tables of ``turns`` pseudo-random rotations each, followed by the nearest signed axis.

    A rotation is three rounds of random signs and a fast Hadamard transform.
    Besides its own bucket a vector probes, for each rotation, the bucket in
    which that rotation's runner-up axis takes the place of the nearest one.
    """

    def __init__(self, width: int, turns: int, tables: int, seed: int = SEED) -> None:
        self.width = max(2, 1 << (max(width, 1) - 1).bit_length())
        self.turns, self.tables = turns, tables
        rng = np.random.default_rng(seed)
        self.signs = rng.choice((-1.0, 1.0), (tables, turns, 3, self.width))

    def rotate(self, unit: np.ndarray, signs: np.ndarray) -> np.ndarray:
        y = unit
        for flip in signs:
            y = y * flip
            step = 1
            while step < self.width:
                y = y.reshape(len(unit), -1, 2, step)
                y = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2)
                step *= 2
            y = y.reshape(len(unit), self.width) / math.sqrt(self.width)
        return y

    def keys(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own keys (row, table) and probed keys (row, table, rotation)."""
        wide = np.zeros((len(unit), self.width))
        wide[:, : unit.shape[1]] = unit
        base = 2 * self.width
        own = np.zeros((len(unit), self.tables), np.int64)
        probes = np.zeros((len(unit), self.tables, self.turns), np.int64)
        every = np.arange(len(unit))
        for t in range(self.tables):
            shift = []
            for k in range(self.turns):
                y = self.rotate(wide, self.signs[t, k])
                size = np.abs(y)
                first = size.argmax(axis=1)
                size[every, first] = -1
                second = size.argmax(axis=1)
                code = 2 * first + (y[every, first] < 0)
                other = 2 * second + (y[every, second] < 0)
                own[:, t] = own[:, t] * base + code
                shift = [s * base for s in shift] + [other - code]
            for k in range(self.turns):
                probes[:, t, k] = own[:, t] + shift[k]
        return own, probes


def met_in(own_a, probes_a, own_b, probes_b) -> np.ndarray:
    """Tables (last axis) in which one vector's bucket is the other's own or probed one."""
    return (
        (own_a == own_b)
        | (own_a[..., None] == probes_b).any(axis=-1)
        | (own_b[..., None] == probes_a).any(axis=-1)
    )


def fit_tables(rows: int, width: int, cosine: float = COSINE, recall: float = RECALL) -> CrossPolytope:
    """Rotations per table from the number of rows, tables from the wanted recall.

    The chance of meeting in a table is measured on random pairs at exactly the
    threshold, not taken from the data.
    """
    wide = max(2, 1 << (max(width, 1) - 1).bit_length())
    turns = max(1, min(round(math.log(max(rows, 2)) / math.log(2 * wide)), 60 // (wide.bit_length() + 1)))
    rng = np.random.default_rng(SEED)
    a = rng.standard_normal((2_000, wide))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2_000, wide))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = cosine * a + math.sqrt(1 - cosine * cosine) * b
    trial = CrossPolytope(wide, turns, 4)
    met = float(met_in(*trial.keys(a), *trial.keys(b)).mean())
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(max(1e-9, 1 - met)))) if met < 1 else 1
    return CrossPolytope(wide, turns, tables)


def _unit(vectors: pa.Array, width: int) -> np.ndarray:
    raw = padded_matrix(vectors, width).astype(np.float64)
    # By a power of two, which is exact, so that no square over- or underflows.
    raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, initial=0))[1][:, None])
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _compare(width: int, tables: int, turns: int, cosine: float):
    def compare(cell: pa.Table) -> pa.Table:
        ids, copies = cell["id"].to_numpy(), cell["copies"].to_numpy()
        table, key = cell["table"].to_numpy(), cell["key"].to_numpy()
        main, block = cell["main"].to_numpy().astype(bool), cell["block"].to_numpy()
        left, right = cell["left"].to_numpy(), cell["right"].to_numpy()
        unit = _unit(cell["vector"], width)
        own = padded_matrix(cell["own"])
        probes = padded_matrix(cell["probes"]).reshape(len(own), tables, turns)
        order = np.lexsort((right, left, key, table))
        new = np.flatnonzero(
            (np.diff(table[order]) != 0)
            | (np.diff(key[order]) != 0)
            | (np.diff(left[order]) != 0)
            | (np.diff(right[order]) != 0)
        )
        nodes, node = np.unique(ids, return_inverse=True)
        labels = np.arange(len(nodes))
        links = np.zeros(len(nodes), np.int64)
        for rows in np.split(order, new + 1):
            # Pairs across two blocks, or within one; one of the two lies in its own bucket.
            one, two = rows[block[rows] == left[rows]], rows[block[rows] == right[rows]]
            if not len(one) or not len(two):
                continue
            for k in range(0, len(one), BLOCK):
                part = one[k : k + BLOCK]
                i, j = np.nonzero(unit[part] @ unit[two].T >= cosine - 1e-12)
                i, j = part[i], two[j]
                fit = (main[i] | main[j]) & (ids[i] != ids[j])
                if left[rows[0]] == right[rows[0]]:
                    fit &= ids[i] < ids[j]
                i, j = i[fit], j[fit]
                if not len(i):
                    continue
                fit = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
                i, j = i[fit], j[fit]
                # A pair counts once: in its first table, in the bucket both own or else
                # in the bucket owned by the smaller id if that is one of the common ones.
                t = table[i[0]] if len(i) else 0
                if t:
                    earlier = met_in(own[i, :t], probes[i, :t], own[j, :t], probes[j, :t]).any(axis=1)
                    i, j = i[~earlier], j[~earlier]
                mixed = main[i] != main[j]
                owner, guest = np.where(main[i], i, j), np.where(main[i], j, i)
                other = mixed & (own[guest, t][:, None] == probes[owner, t]).any(axis=1)
                once = ~other | (ids[owner] < ids[guest])
                i, j = i[once], j[once]
                np.add.at(links, node[i], copies[j])
                np.add.at(links, node[j], copies[i])
                labels = merge_links(labels, node[i], node[j])
        child = np.flatnonzero(labels != np.arange(len(nodes)))
        some = np.flatnonzero(links)
        return pa.table(
            {
                "a": np.concatenate((nodes[child], nodes[some])),
                "b": pa.array(
                    np.concatenate((nodes[labels[child]], nodes[some])), pa.int64()
                ),
                "links": np.concatenate((np.zeros(len(child), np.int64), links[some])),
            }
        )

    return compare


def _with_keys(classes: DataFrame, index: CrossPolytope, width: int) -> DataFrame:
    """Every class with its own and its probed keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                own, probes = index.keys(_unit(batch["vector"], width))
                lists = [
                    pa.array(list(keys.reshape(len(own), -1)), pa.list_(pa.int64())) for keys in (own, probes)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"], batch["copies"], batch["vector"], *lists],
                    ["id", "copies", "vector", "own", "probes"],
                )

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(
        run, f"id long, copies long, vector {kind}, own array<long>, probes array<long>"
    )


def _bucket_rows(keyed: DataFrame, turns: int) -> DataFrame:
    """``id, table, key, main``: one row per class and bucket that it owns or probes."""
    place = "named_struct('table', {t}, 'key', k, 'main', {m})"
    every = (
        f"concat(transform(own, (k, i) -> {place.format(t='i', m='true')}), "
        f"transform(probes, (k, i) -> {place.format(t=f'int(i div {turns})', m='false')}))"
    )
    return keyed.select("id", F.explode(F.expr(every)).alias("b")).select("id", "b.*")


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Links, component and whether it stays, for every row.

    Equal vectors form a class before hashing, so a class of copies is hashed
    once and its links follow from its size. Buckets are compared inside tasks:
    each verified pair is counted in one of the buckets that hold it, and a cell
    returns sums and a spanning forest, never its pairs. A bucket beyond
    ``BLOCK`` rows is cut into blocks of which every two meet in a cell.

    Result: id, ``n_links``, ``component_id``, ``kept``. Vectors that are null,
    empty or zero, hold null or non-finite components, or have no id, link with
    nothing and are components of their own. Shorter vectors count as padded
    with zeros. Repeated rows are rows of their own, also where one id has
    several vectors; a component is named by the smallest id in it; an empty table gives no
    rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.when(
            finite_vector(vector_col)
            & F.exists(vector_col, lambda x: x != 0)
            & F.col(id_col).isNotNull(),
            F.col(vector_col),
        ).alias("vector"),
    )
    classes = write_stage(
        rows.where(F.col("vector").isNotNull())
        .groupBy("vector")
        .agg(F.min("id").alias("least"), F.count("*").alias("copies"))
        # Ids may stand for several vectors; a class has a number, fixed by the written table.
        .withColumn("id", F.monotonically_increasing_id()),
        new_stage_path(spark, "vector-classes"),
    )
    n, width = classes.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    index = fit_tables(n, width, cosine)
    keyed = write_stage(
        _with_keys(classes.select("id", "copies", "vector"), index, width),
        new_stage_path(spark, "vector-keys"),
    )
    hashed = _bucket_rows(keyed, index.turns)
    large = (
        hashed.groupBy("table", "key")
        .agg(F.count("*").alias("bucket_rows"))
        .where(F.col("bucket_rows") > BLOCK)
    )
    parts = max(1, math.ceil(n * index.tables * (index.turns + 1) / TOGETHER))
    blocks = F.ceil(F.coalesce("bucket_rows", F.lit(1)) / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    cells = (
        hashed.join(large, ["table", "key"], "left")
        .withColumns({"block": block, "blocks": blocks})
        .withColumn("against", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns(
            {
                "left": F.least("block", "against"),
                "right": F.greatest("block", "against"),
                # Cells of a large bucket stand alone, small buckets share a call.
                "part": F.when(F.col("blocks") > 1, F.xxhash64("table", "key")).otherwise(
                    F.pmod(F.xxhash64("table", "key"), F.lit(parts))
                ),
            }
        )
        .withColumns(
            {
                "cell_left": F.when(F.col("blocks") > 1, F.col("left")).otherwise(-1),
                "cell_right": F.when(F.col("blocks") > 1, F.col("right")).otherwise(-1),
            }
        )
    )
    found = write_stage(
        # Places are thin; each class's vector joins them once.
        cells.drop("bucket_rows", "blocks", "against")
        .join(keyed, "id")
        .groupBy("part", "cell_left", "cell_right")
        .applyInArrow(
            _compare(width, index.tables, index.turns, cosine), "a long, b long, links long"
        ),
        new_stage_path(spark, "vector-links"),
    )
    labels = connected_components(found.where("a <> b").select("a", "b"))
    sums = found.groupBy("a").agg(F.sum("links").alias("links"))
    grouped = classes.join(labels, "id", "left").withColumn("group", F.coalesce("component", "id"))
    names = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = (
        grouped.join(names, "group")
        .join(sums, F.col("id") == F.col("a"), "left")
        .select(
            "vector",
            "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return rows.join(named, "vector", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        (F.coalesce("component_id", "id") == F.col("id")).alias("kept"),
    )
