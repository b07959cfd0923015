"""Country and institution mentions in affiliation text, from dictionaries.

Mentions come from the text itself: word runs for countries, comma separated
segments for institutions. The result is deterministic; a statistical tagger
would miss or reject some of these mentions and find others.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.columns import once
from citeloom.functions.fixed import INSTITUTION_KEYWORDS, WORLD_COUNTRIES
from citeloom.functions.text import (
    first_institution,
    institution_mentions,
    last_mention,
    title_case,
)
from citeloom.operators.sizing import left_lookup, measured

_TOKEN = r"[\p{L}\p{N}_-]+|[^\p{L}\p{N}_-]"


def _tagged(df: DataFrame, tag: Column, output: str) -> DataFrame:
    # Tags are filtered, hashed and joined on later; each is computed once.
    return df.select(*(c for c in df.columns if c != output), once(tag, output))


def tag_countries(
    df: DataFrame,
    countries: DataFrame | Iterable[str] = tuple(WORLD_COUNTRIES),
    column: str = "affiliation",
    output: str = "country",
    include_unmatchable: bool = False,
) -> DataFrame:
    """Add the last country mention as it stands in the text, or null.

    The kind of ``countries`` decides how: given names become one pattern that
    is searched row by row without a shuffle; a DataFrame with a ``name`` column
    is joined and may have any length. Both follow the same rule.
    """
    if isinstance(countries, DataFrame):
        return tag_from_dictionary(df, countries, column, output, include_unmatchable)
    return _tagged(df, last_mention(F.col(column), countries, include_unmatchable), output)


def dictionary_runs(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """``_text, stop, n, run``: the runs of words of each distinct text that may be a known name.

    The names are indexed by their first word, with the most words that a name
    beginning with it has. Only at such words a run begins, and none is longer;
    ``known`` has the column ``_known``, in lower case.
    """
    words = F.regexp_extract_all("_known", F.lit(_TOKEN), F.lit(0))
    index = known.groupBy(words[0].alias("_first")).agg(F.max(F.size(words)).alias("_longest"))
    texts = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_text")).distinct()
    tokens = texts.withColumn("_tokens", F.regexp_extract_all("_text", F.lit(_TOKEN), F.lit(0)))
    begun = (
        tokens.select("_text", "_tokens", F.posexplode("_tokens").alias("_at", "_token"))
        .join(measured(index), F.lower("_token") == F.col("_first"))
        .withColumn("n", F.explode(F.expr("sequence(1, least(_longest, size(_tokens) - _at))")))
        .withColumn("stop", F.col("_at") + F.col("n"))
        .where(F.get("_tokens", F.col("stop") - 1) != " ")
    )
    return begun.select("_text", "stop", "n", F.concat_ws("", F.slice("_tokens", F.col("_at") + 1, F.col("n"))).alias("run"))


def tag_from_dictionary(
    df: DataFrame,
    names: DataFrame,
    column: str = "affiliation",
    output: str = "country",
    include_unmatchable: bool = False,
) -> DataFrame:
    """The same tag for a dictionary of any length, by an equi-join.

    Distinct texts are cut into the runs of words that begin like a name; runs
    that are in the dictionary stay, the one that ends last wins.
    """
    known = names.where(r"name <> '' AND NOT name RLIKE '^\\s|\\s$'")
    if not include_unmatchable:
        known = known.where(F.col("name") == title_case(F.col("name")))
    known = known.select(F.lower("name").alias("_known")).distinct()
    runs = dictionary_runs(df, known, column)
    # Broadcast only if it measures small; the runs of all texts are many.
    hits = runs.join(measured(known), F.lower("run") == F.col("_known"), "left_semi")
    last = hits.groupBy("_text").agg(F.max_by("run", F.struct("stop", "n")).alias(output))
    return left_lookup(df, column, last, "_text", limit=None)


def tag_first_institution(
    df: DataFrame,
    column: str = "affiliation",
    output: str = "institutions",
    keywords: tuple[str, ...] = INSTITUTION_KEYWORDS,
) -> DataFrame:
    """Add the first segment that holds an institution keyword, or null."""
    return _tagged(df, first_institution(F.col(column), keywords), output)


def tag_all_institutions(
    df: DataFrame,
    column: str = "affiliation",
    output: str = "institutions",
    keywords: tuple[str, ...] = INSTITUTION_KEYWORDS,
) -> DataFrame:
    """Add all segments that hold an institution keyword, null when none."""
    return _tagged(df, institution_mentions(F.col(column), keywords), output)
