"""Mix sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share of a source by its place in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source, hence no document, is repeated more often than this.
MAX_PASSES = 3
#: Relative emphasis of each weight class over training time: (time, emphasis) knots, linear between them.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one block of a source's stream has on average.
BLOCK_ROWS = 1024


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def demand_time(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """Training time at which ``share`` of a source's tokens has been asked for.

    The schedule is integrated between its knots, and the quadratic of the
    segment in which the share falls is inverted.
    """
    areas = [
        (t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)
    ]
    whole = sum(areas)
    found: Column | None = None
    done = whole
    for ((t0, w0), (t1, w1)), area in reversed(
        list(zip(zip(knots, knots[1:], strict=False), areas, strict=True))
    ):
        done -= area
        y = F.greatest(share * whole - F.lit(done), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        if slope:
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * y, F.lit(0.0)))
            time = F.lit(t0) + (root - w0) / slope
        else:
            time = F.lit(t0) + y / w0
        found = time if found is None else F.when(share * whole < done + area, time).otherwise(found)
    return F.least(found, F.lit(1.0))


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES
) -> DataFrame:
    """One row per source: size, target and weight class.

    Targets share all words by weight; what exceeds ``max_passes`` times a
    source's size is shared again among the others. With the sources ordered by
    size per weight that has one level at which the sharing ends, found with
    prefix sums. The windows run over one row per source.
    """
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = totals.withColumn("class", (place % len(weights)).cast("int")).withColumns(
        {
            "weight": F.element_at(F.array(*map(F.lit, weights)), F.col("class") + 1).cast("long"),
            "ceiling": F.col("source_size") * max_passes,
        }
    )
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(
        F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levelled = ranked.withColumn("level", level)
    # Levels only rise while sources reach their ceiling, so the first free source has the largest.
    free = F.when(F.col("ceiling") / F.col("weight") >= F.col("level"), F.col("level"))
    return levelled.withColumn("level", F.max(free).over(everything)).select(
        "source",
        "source_size",
        "source_rows",
        "class",
        F.least(
            F.col("ceiling").cast("double"),
            F.coalesce(F.col("weight") * F.col("level"), F.col("ceiling").cast("double")),
        ).alias("target"),
    )


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    schedules: tuple[tuple[tuple[float, float], ...], ...] = SCHEDULES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """What the mix takes of every document, and when.

    Each source's documents form a stream in the order of ``md5(id)``; the mix
    reads the stream, again from its start where needed, until the target is
    reached. ``taken`` counts the words read, ``full_passes`` the whole readings
    and ``last_words`` the words of the unfinished one. ``first_position`` is
    the training time in [0, 1] of the first reading, from the inverse of the
    source's cumulative demand (null if nothing is taken).

    A hot source is cut into blocks by leading hash bits, as many as its rows
    ask for, whose totals give the offsets; no text is shuffled unless it is
    among ``keep``. A null text has no words; a null source is a source of its
    own, last in order; a null id sorts first; repeated rows are documents of
    their own, ordered by size; an empty table gives no rows; other columns
    are ignored.
    """
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(text_col).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"),
        *(F.col(c).alias(f"kept_{c}") for c in keep),
    )
    # Sources are few and AQE picks the join by what they really measure.
    targets = source_targets(sized, weights, max_passes)
    bits = F.greatest(
        F.lit(0), F.least(F.lit(28), F.ceil(F.log2(F.col("source_rows") / BLOCK_ROWS)))
    ).cast("int")
    head = F.conv(F.substring("key", 1, 7), 16, 10).cast("long")
    same = sized["source"].eqNullSafe(targets["source"])
    joined = (
        sized.join(targets, same)
        .drop(targets["source"])
        .withColumns(
            {
                "block": F.floor(head / F.pow(F.lit(2.0), F.lit(28) - bits)).cast("long"),
                "quota": F.round("target").cast("long"),
            }
        )
    )
    blocks = joined.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    before = (
        Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        F.col("source").alias("block_source"),
        F.col("block").alias("block_no"),
        F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("offset"),
    )
    inside = (
        Window.partitionBy("source", "block")
        .orderBy("key", F.col("id").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    run = joined.withColumn("run", F.sum("size").over(inside) - F.col("size"))
    placed = run.join(
        offsets,
        F.col("source").eqNullSafe(F.col("block_source")) & (F.col("block") == F.col("block_no")),
    ).withColumn("start", F.col("run") + F.col("offset"))
    size = F.col("source_size")
    full = F.when(size > 0, F.floor(F.col("quota") / size)).otherwise(0).cast("long")
    planned = placed.withColumn("full_passes", full).withColumn(
        "last_words",
        F.greatest(
            F.lit(0),
            F.least(
                F.col("size"), F.col("quota") - F.col("full_passes") * size - F.col("start")
            ),
        ).cast("long"),
    )
    taken = F.col("full_passes") * F.col("size") + F.col("last_words")
    return (
        planned.withColumn("taken", taken)
        .withColumn(
            "first_position",
            F.when(F.col("taken") > 0, _position(F.col("start"), len(weights), schedules)),
        )
        .select(
            F.col("id").alias(id_col),
            F.col("source").alias(source_col),
            "size",
            "source_size",
            "target",
            "quota",
            "class",
            "start",
            "full_passes",
            "last_words",
            "taken",
            "first_position",
            *(F.col(f"kept_{c}").alias(c) for c in keep),
        )
    )


def _position(asked: Column, classes: int, schedules) -> Column:
    share = asked / F.greatest(F.col("quota"), F.lit(1))
    found = demand_time(share, schedules[0])
    for k in range(1, classes):
        found = F.when(F.col("class") == k, demand_time(share, schedules[k % len(schedules)])).otherwise(found)
    return found


def by_first_position(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of a plan, range-sorted by the training position of their first reading.

    Documents of which nothing is taken come last, in the order of their stream,
    so that no range has all of them.
    """
    order = [
        F.col("first_position").asc_nulls_last(),
        F.col("start").asc(),
        F.col("source").asc_nulls_last(),
        F.col(id_col).asc_nulls_first(),
    ]
    return plan.repartitionByRange(*order).sortWithinPartitions(*order)


def training_order(
    plan: DataFrame,
    text_col: str | None = None,
    schedules: tuple[tuple[tuple[float, float], ...], ...] = SCHEDULES,
    classes: int = len(WEIGHTS),
) -> DataFrame:
    """One row per reading of a document, range-sorted by training position.

    Documents of which nothing is taken have no row. With ``text_col`` (kept by
    the plan) the text of an unfinished reading ends after its last taken word.
    """
    passes = F.col("full_passes") + (F.col("last_words") > 0).cast("long")
    reads = plan.where("taken > 0").withColumn(
        "pass", F.explode(F.sequence(F.lit(0), passes.cast("int") - 1))
    )
    reads = reads.withColumns(
        {
            "words": F.when(F.col("pass") < F.col("full_passes"), F.col("size")).otherwise(
                F.col("last_words")
            ),
            "position": _position(
                F.col("pass") * F.col("source_size") + F.col("start"), classes, schedules
            ),
        }
    )
    if text_col:
        pieces = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
        cut = F.array_join(F.slice(pieces, 1, F.col("words").cast("int")), "")
        reads = reads.withColumn(
            text_col, F.when(F.col("words") < F.col("size"), cut).otherwise(F.col(text_col))
        )
    order = ["position", "start", "pass"]
    return reads.repartitionByRange(*order).sortWithinPartitions(*order)
