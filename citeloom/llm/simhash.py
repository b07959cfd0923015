"""SimHash near-duplicates, found exactly with a vantage-point tree over Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.components import connected_components, merge_links
from citeloom.llm.vocabulary import word_segments
from citeloom.sources.staged import new_stage_path, write_stage

SEED = 42
#: Fingerprints that link differ in this many bits at most.
RADIUS = 2
#: Fingerprints from which the tree's vantage points and radii are fitted.
SAMPLE = 16_384
#: Fingerprints that a shard (a leaf of the tree) holds about; larger shards are cut into cells.
SHARD, CELL_QUERIES = 2_048, 32_768


# Fingerprints


def fingerprint(data: bytes, words: int = 3) -> int:
    """64 majority bits over the XXH64 digests of all word shingles of a lower-cased text."""
    ones, total = np.zeros(64, np.int64), 0
    tail: list[bytes] = []
    seen = 0
    for part in word_segments(data):
        found = part.lower().split()
        seen += len(found)
        run = tail + found
        if len(run) >= words:
            joined = b" ".join(run)
            ends = np.cumsum([len(w) + 1 for w in run])
            starts = (ends - [len(w) + 1 for w in run]).tolist()
            stops = (ends - 1).tolist()
            digest = xxhash.xxh64_intdigest
            hashes = np.array(
                [digest(joined[a:b], SEED) for a, b in zip(starts, stops[words - 1 :], strict=False)],
                np.uint64,
            )
            total += len(hashes)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        tail = run[max(0, len(run) - words + 1) :] if words > 1 else []
    if not seen:
        return 0
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ()
) -> DataFrame:
    """``(id, print)`` and ``columns`` of every row; a null or wordless text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [_signed(fingerprint(cell.as_py() or b"")) for cell in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64()), *batch.columns[2:]], ["id", "print", *columns]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    kept = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("data"), *columns
    ).mapInArrow(run, f"id {kind}, print long{kept}")


# The tree


@dataclass
class Branch:
    """Prints within ``radius`` of the vantage point lie inside, the others outside."""

    point: np.uint64
    radius: int
    inside: Branch | int
    outside: Branch | int


def distance(prints: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(prints ^ point).astype(np.int16)


def best_split(prints: np.ndarray, reach: int, rng: np.random.Generator) -> tuple | None:
    """Vantage point and radius that leave the fewest prints near the boundary."""
    best = None
    n = len(prints)
    for point in rng.choice(prints, min(12, n), replace=False):
        counts = np.bincount(distance(prints, point), minlength=65)
        within = np.cumsum(counts)
        for radius in range(64):
            small = min(within[radius], n - within[radius])
            if 5 * small < n:
                continue
            low, high = max(radius - reach, -1), min(radius + reach, 64)
            both = within[high] - (within[low] if low >= 0 else 0)
            if best is None or both < best[0]:
                best = (both, point, radius)
    return best


def grow_tree(prints: np.ndarray, leaves: int, reach: int = RADIUS) -> tuple[Branch | int, int]:
    """A tree of at most ``leaves`` shards fitted to a sample; returns it and their number."""
    rng = np.random.default_rng(SEED)
    numbers = iter(range(1 << 30))

    def grow(part: np.ndarray, share: int) -> Branch | int:
        split = best_split(part, reach, rng) if share > 1 and len(part) >= 16 else None
        if split is None or split[0] > 0.9 * len(part):
            return next(numbers)
        _, point, radius = split
        near = distance(part, point) <= radius
        inner = min(share - 1, max(1, round(share * near.mean())))
        return Branch(point, radius, grow(part[near], inner), grow(part[~near], share - inner))

    tree = grow(np.unique(prints), leaves)
    return tree, next(numbers)


def route(tree: Branch | int, prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) pairs: the shard a print lies in (reach 0), or all that its ball may touch."""
    rows, shards = [], []

    def go(node: Branch | int, at: np.ndarray) -> None:
        if not len(at):
            return
        if not isinstance(node, Branch):
            rows.append(at)
            shards.append(np.full(len(at), node, np.int32))
            return
        d = distance(prints[at], node.point)
        go(node.inside, at[d - reach <= node.radius])
        go(node.outside, at[d + reach > node.radius])

    go(tree, np.arange(len(prints)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(rows), np.concatenate(shards)


def near_pairs(stored: np.ndarray, queries: np.ndarray, reach: int = RADIUS) -> Iterator[tuple]:
    """Row pairs (stored, query) within ``reach``, down a tree grown over the shard itself."""
    rng = np.random.default_rng(SEED)

    def search(s: np.ndarray, q: np.ndarray, split: bool) -> Iterator[tuple]:
        if not len(s) or not len(q):
            return
        best = best_split(stored[s], reach, rng) if split and len(s) > 256 and len(q) > 256 else None
        if best is None or best[0] > 0.6 * len(s):
            step = max(1, (1 << 20) // len(s))
            for k in range(0, len(q), step):
                part = q[k : k + step]
                i, j = np.nonzero(np.bitwise_count(stored[s][:, None] ^ queries[part]) <= reach)
                yield s[i], part[j]
            return
        _, point, radius = best
        ds, dq = distance(stored[s], point), distance(queries[q], point)
        yield from search(s[ds <= radius], q[dq - reach <= radius], True)
        yield from search(s[ds > radius], q[dq + reach > radius], True)

    yield from search(np.arange(len(stored)), np.arange(len(queries)), True)


def _cell_links(cell: pa.Table) -> pa.Table:
    """A forest that joins what the cell's links join, never more rows than prints."""
    prints = cell["print"].to_numpy().view(np.uint64)
    asks = cell["is_query"].to_numpy().astype(bool)
    nodes, index = np.unique(prints, return_inverse=True)
    stored, queries = index[~asks], index[asks]
    labels = np.arange(len(nodes))
    for s, q in near_pairs(nodes[stored], nodes[queries]):
        labels = merge_links(labels, stored[s], queries[q])
    child = np.flatnonzero(labels != np.arange(len(nodes)))
    return pa.table(
        {"a": nodes[child].view(np.int64), "b": nodes[labels[child]].view(np.int64)},
        schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]),
    )


def print_links(prints: DataFrame, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints, enough to join what is within reach.

    A tree fitted to a bounded sample cuts the space into shards. Each print is
    stored in the shard in which it lies and asked of all shards that its ball
    touches, which the triangle inequality bounds; so no pair is lost wherever a
    boundary runs. Large shards are cut into cells of bounded size.
    """
    spark = prints.sparkSession
    total = prints.count()
    if not total:
        return spark.createDataFrame([], "a long, b long")
    few = prints.orderBy(F.xxhash64("print")).limit(sample).toPandas()["print"].to_numpy(np.int64)
    tree, shards = grow_tree(few.view(np.uint64), min(len(few) // 16 + 1, total // shard + 1))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for reach, asks in ((0, False), (RADIUS, True)):
                rows, at = route(tree, own, reach)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(at, pa.int32()),
                        pa.array(own[rows].view(np.int64)),
                        pa.array(np.full(len(rows), asks)),
                    ],
                    ["shard", "print", "is_query"],
                )

    dealt = write_stage(
        prints.select("print").mapInArrow(deal, "shard int, print long, is_query boolean"),
        new_stage_path(spark, "shards"),
    )
    # One row per shard of the tree, whose number the sample bounds.
    cuts = dealt.groupBy("shard").agg(
        F.ceil(F.sum((~F.col("is_query")).cast("long")) / (2 * shard)).alias("down"),
        F.ceil(F.sum(F.col("is_query").cast("long")) / CELL_QUERIES).alias("across"),
    )
    down, across = F.greatest("down", F.lit(1)), F.greatest("across", F.lit(1))
    placed = dealt.join(F.broadcast(cuts), "shard").withColumn(
        "cell",
        F.explode(
            F.when(
                F.col("is_query"),
                F.transform(
                    F.sequence(F.lit(0).cast("long"), down - 1),
                    lambda i: i * across + F.pmod(F.xxhash64("print"), across),
                ),
            ).otherwise(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), across - 1),
                    lambda j: F.pmod(F.xxhash64("print"), down) * across + j,
                )
            )
        ),
    )
    return (
        placed.select("shard", "cell", "print", "is_query")
        .groupBy("shard", "cell")
        .applyInArrow(_cell_links, "a long, b long")
    )


def row_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ()
) -> DataFrame:
    """``id``, ``columns``, ``print``, ``component`` and ``component_id`` of every row.

    ``component`` is a fingerprint and tells components apart even where an id
    lies in several of them.
    """
    spark = docs.sparkSession
    rows = write_stage(
        with_fingerprints(docs, id_col, text_col, columns), new_stage_path(spark, "fingerprints")
    )
    classes = rows.groupBy("print").agg(F.min("id").alias("least"))
    labels = connected_components(print_links(classes.select("print")))
    grouped = classes.join(labels, classes["print"] == labels["id"], "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")
    )
    named = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    members = grouped.join(named, "component").select("print", "component", "component_id")
    return rows.join(members, "print")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and component of every row.

    Rows of equal fingerprint form a class before anything is compared, so
    groups of copies cost one print. Result: id, ``fingerprint`` (16 hex
    digits), ``component_id``, the smallest id reachable over links of at most
    ``RADIUS`` differing bits. Null and wordless texts have fingerprint zero and
    link like others; a null id never names a component unless it has no other;
    repeated rows appear as often as given; an empty table gives no rows; other
    columns are ignored.
    """
    return row_components(docs, id_col, text_col).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
