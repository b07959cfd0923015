"""How the wording of each source differs from its language's and from the other sources'."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.vocabulary import word_segments
from citeloom.sources.staged import new_stage_path, write_stage

#: Documents of a language that hold a term, at least, for the term to be kept.
MIN_DOCS = 10
#: Whole share of a group's distribution; shares are integers of this unit.
UNIT = 1_000_000_000
#: A task hands its counts on when it holds so many, or has read so many bytes since.
COUNTS_HELD, BYTES_HELD = 400_000, 64 << 20
#: Every byte that is no part of a term becomes a space; ASCII capitals become small.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_bytes(data: bytes) -> bytes:
    """The text with its terms lower-cased and separated by spaces."""
    return data.translate(_TERM_BYTES)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), summed within the task as far as they fit."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    read = 0

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (seen, docs) in held.items():
            terms = list(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()),
                    pa.array(seen.values(), pa.int64()),
                    pa.array([docs[t] for t in terms], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    for batch in batches:
        for lang, source, cell in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["data"]):
            data = cell.as_py()
            if not data:
                continue
            seen, docs = held.setdefault((lang, source), (Counter(), Counter()))
            own: set[bytes] = set()
            for part in word_segments(term_bytes(data)):
                terms = part.split()
                seen.update(terms)
                own.update(terms)
            docs.update(own)
            read += len(data)
            if read >= BYTES_HELD or sum(len(s) for s, _ in held.values()) >= COUNTS_HELD:
                yield from hand_on()
                read = 0
    yield from hand_on()


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """``lang, source, term, n, docs``: partial counts, several rows per key."""
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.col(text_col).cast("binary").alias("data"),
    )
    counted = rows.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    return counted.withColumn("term", F.col("term").cast("string"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """Smoothed share of a term in units: exact, as the product may exceed 64 bits."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    below = F.greatest(total + 2 * kept, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", above, below).cast("long") + 1


def divergence(p: Column, q: Column) -> Column:
    """Whole part of the squared difference over the sum; shares are at most ``UNIT`` + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q).cast("long")


def _pair_values(per: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for both orders of every two sources of a language.

    The terms of a pair are grouped by their two counts and the function is
    evaluated once per cell. Only terms that both sources hold are paired; what
    one of them or neither holds follows from each source's own cells, for
    which the other's share is that of no occurrence.
    """
    one = F.col("per")
    combined = F.flatten(
        F.transform(
            one,
            lambda x, i: F.transform(
                F.slice(one, i + 2, F.size(one)),
                lambda y: F.struct(
                    x["source"].alias("a"), y["source"].alias("b"), x["n"].alias("n_a"), y["n"].alias("n_b")
                ),
            ),
        )
    )
    shared = (
        per.select("lang", F.explode(combined).alias("x"))
        .groupBy("lang", "x.a", "x.b", "x.n_a", "x.n_b")
        .agg(F.count("*").alias("terms"))
    )
    own = (
        per.select("lang", F.explode("per").alias("x"))
        .groupBy("lang", "x.source", "x.n")
        .agg(F.count("*").alias("terms"))
    )
    none = share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))
    known = groups.withColumn("zero", none)
    side = lambda k: known.select(
        F.col("lang").alias("of_lang"),
        F.col("source").alias(k),
        F.col("total").alias(f"total_{k}"),
        F.col("zero").alias(f"zero_{k}"),
        F.col("held").alias(f"held_{k}"),
        *([F.col("kept")] if k == "a" else []),
    )
    pairs = (
        side("a")
        .join(side("b").withColumnRenamed("of_lang", "its_lang"), F.expr("of_lang = its_lang AND a < b"))
        .drop("its_lang")
    )
    p = share(F.col("n_a"), F.col("total_a"), F.col("kept"))
    q = share(F.col("n_b"), F.col("total_b"), F.col("kept"))
    za, zb = F.col("zero_a"), F.col("zero_b")
    both = (
        shared.join(pairs.withColumnsRenamed({"of_lang": "lang"}), ["lang", "a", "b"])
        .withColumns({"p": p, "q": q})
        .select(
            "lang", "a", "b",
            (
                F.col("terms")
                * (
                    divergence(F.col("p"), F.col("q")) - divergence(F.col("p"), zb)
                    - divergence(za, F.col("q")) + divergence(za, zb)
                )
            ).alias("value"),
        )
    )

    def alone(k: str, zero: Column) -> DataFrame:
        mine = own.select(F.col("lang").alias("of_lang"), F.col("source").alias(k), "n", "terms")
        held = share(F.col("n"), F.col(f"total_{k}"), F.col("kept"))
        return (
            mine.join(pairs, ["of_lang", k])
            .withColumn("p", held)
            .select(F.col("of_lang").alias("lang"), "a", "b", (F.col("terms") * divergence(F.col("p"), zero)).alias("value"))
        )

    neither = pairs.select(
        F.col("of_lang").alias("lang"), "a", "b",
        ((F.col("kept") - F.col("held_a") - F.col("held_b")) * divergence(za, zb)).alias("value"),
    )
    sums = (
        both.unionByName(alone("a", zb)).unionByName(alone("b", za)).unionByName(neither)
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    ends = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return sums.select("lang", F.explode(ends).alias("x"), "value").select("lang", "x.source", "x.item", "value")


def _term_values(per: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value, rank`` of the ``top`` terms that a source has above its language.

    Terms are grouped by (group count, language count); cells of equal value
    are merged and ranked by the terms before them. Only cells that begin
    within the ranks asked for are expanded to terms.
    """
    held = per.select("lang", "term", "lang_n", F.explode("per").alias("x")).select(
        "lang", "x.source", "term", "x.n", "lang_n"
    )
    cells = held.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("terms"))
    valued = (
        cells.join(groups.select("lang", "source", "kept", "total", "lang_total"), ["lang", "source"])
        .withColumns(
            {
                "p": share(F.col("n"), F.col("total"), F.col("kept")),
                "q": share(F.col("lang_n"), F.col("lang_total"), F.col("kept")),
            }
        )
        .where("p > q")
        .withColumn("value", divergence(F.col("p"), F.col("q")))
        .select("lang", "source", "n", "lang_n", "terms", "value")
    )
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    down = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    first = F.coalesce(F.sum("terms").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begun = merged.withColumn("before", first).where(F.col("before") < top).select("lang", "source", "value")
    chosen = valued.join(begun, ["lang", "source", "value"]).drop("terms")
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    return (
        held.join(chosen, ["lang", "source", "n", "lang_n"])
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.col("term").alias("item"), "value", "rank")
    )


def audit_sources(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = 10,
) -> DataFrame:
    """Divergence of every (language, source) group from the other sources and from its language.

    Terms are runs of letters and of code points from 128 on, with ASCII
    capitals lower-cased; a language keeps the terms that ``min_docs`` of its
    documents hold. Result: ``lang, source, part, item, value, rank``. Part
    ``pair`` has a row per other source of the language (value summed over all
    kept terms), part ``term`` the ``top`` kept terms that the group uses more
    than its language; ranks run by falling value, then by item in UTF-8 order.

    Texts are counted where they are read and only sums are shuffled; the
    shares and the function are evaluated per cell of equal counts. A row per
    kept term holds the counts of its sources, so sources are taken to be far
    fewer than terms; the result itself grows with the square of the sources
    of a language.

    Null and empty texts hold no terms, null languages and sources count as the
    empty string; a group without terms is compared like any other. A language
    without kept terms has values of 0; one with a single source has no pairs.
    Repeated rows are documents of their own; an empty table gives no rows;
    other columns are ignored. Very long texts are cut between words.
    """
    spark = docs.sparkSession
    counted = (
        term_counts(docs, lang_col, source_col, text_col)
        .repartition("lang", "term")  # serves both aggregations
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    per = write_stage(
        counted.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("lang_n"),
            F.sum("docs").alias("docs"),
            F.array_sort(F.collect_list(F.struct("source", "n"))).alias("per"),
        )
        .where(F.col("docs") >= min_docs)
        .drop("docs"),
        new_stage_path(spark, "kept-terms"),
    )
    known = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
    ).distinct()
    langs = per.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    sums = (
        per.select("lang", F.explode("per").alias("x"))
        .groupBy("lang", "x.source")
        .agg(F.sum("x.n").alias("total"), F.count("*").alias("held"))
    )
    groups = write_stage(
        known.join(langs, "lang", "left")
        .join(sums, ["lang", "source"], "left")
        .na.fill(0, ["kept", "lang_total", "total", "held"]),
        new_stage_path(spark, "source-groups"),
    )
    pairs = _pair_values(per, groups)
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(place))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        ranked.withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(_term_values(per, groups, top).withColumn("part", F.lit("term")).select(*columns))
    )
