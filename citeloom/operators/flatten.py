"""One row per article, author and affiliation, and text-derived columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.fixed import ZIPCODE_PATTERN
from citeloom.functions.text import email, zipcode

_ARTICLE = ("title", "pmid", "year", "keyword_list", "mesh_list")


def full_name(forename: Column, lastname: Column) -> Column:
    """``forename lastname``; null when either part is missing."""
    return F.concat(forename, F.lit(" "), lastname)


def flatten(
    articles_df: DataFrame,
    with_full_name: bool = True,
    with_affiliation_name: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Articles to flat rows; an author without affiliation gives no row."""
    columns = ["forename", "lastname"]
    columns += ["full_name"] if with_full_name else []
    columns += ["initials", "identity"]
    columns += ["affiliation_name"] if with_affiliation_name else []
    per_author = articles_df.select(*keep, *_ARTICLE, F.explode("authors_info").alias("author"))
    per_affiliation = per_author.select(
        *keep, *_ARTICLE, "author", F.explode("author.affiliation").alias("affiliation")
    )
    sources = {
        "full_name": full_name(F.col("author.forename"), F.col("author.lastname")),
    }
    return per_affiliation.select(
        *keep,
        *_ARTICLE,
        *(sources.get(c, F.col(f"author.{c}")).alias(c) for c in columns),
        "affiliation",
    )


def with_contact_columns(
    df: DataFrame, column: str = "affiliation", postal_pattern: str = ZIPCODE_PATTERN
) -> DataFrame:
    """Add ``author_email`` and ``zipcode`` taken from the text column."""
    return df.withColumns(
        {
            "author_email": email(F.col(column)),
            "zipcode": zipcode(F.col(column), postal_pattern),
        }
    )


def with_computed_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection; persist once, later."""
    return df.withColumns(dict(columns))
