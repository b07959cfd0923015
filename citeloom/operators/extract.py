"""Nested article, author and affiliation records from record text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("title", "pmid", "year", "keyword_list", "mesh_list", "authors_info")
#: An article without its authors.
METADATA = FIELDS[:-1]
MISSING_POLICIES = ("null", "empty", "strict")
YEAR_SOURCES = ("revised", "published", "mixed")

# Narrow on purpose: the XML parser builds every declared element, so only those
# are declared that a wanted field reads. Leaf elements are text; an attribute is
# declared only where a rule reads it.
_REVISED = "DateRevised struct<Year array<string>>"
_PUBLISHED = "Journal struct<JournalIssue struct<PubDate struct<Year array<string>>>>"
_AUTHORS = """AuthorList array<struct<Author array<struct<
  LastName array<string>, ForeName array<string>, Initials array<string>,
  AffiliationInfo array<struct<
    Affiliation array<string>,
    DirectAffiliation array<string>,
    Identifier array<struct<_VALUE string, _Source string>>>>>>>>"""
_MESH = """MeshHeadingList array<struct<MeshHeading array<struct<
  DescriptorName array<struct<_VALUE string, _UI string>>>>>>"""
_KEYWORDS = "KeywordList array<struct<Keyword array<string>>>"


def record_schema(fields: tuple[str, ...] = FIELDS, year_source: str = "revised") -> str:
    """The part of a record that the given fields are read from."""
    in_article, in_citation = [], []
    if "pmid" in fields:
        in_citation.append("PMID array<string>")
    if "year" in fields and year_source != "published":
        in_citation.append(_REVISED)
    if "year" in fields and year_source != "revised":
        in_article.append(_PUBLISHED)
    if "title" in fields:
        in_article.append("ArticleTitle array<string>")
    if "authors_info" in fields:
        in_article.append(_AUTHORS)
    if in_article:
        in_citation.append(f"Article struct<{', '.join(in_article)}>")
    if "mesh_list" in fields:
        in_citation.append(_MESH)
    if "keyword_list" in fields:
        in_citation.append(_KEYWORDS)
    return f"MedlineCitation struct<{', '.join(in_citation)}>"


_LEAVES = (
    "PMID|Year|ArticleTitle|LastName|ForeName|Initials|Affiliation|Identifier"
    "|DescriptorName|Keyword"
)
# A leaf with child markup: keep only the text (with comments and CDATA
# sections) before the first child. Possessive, so it never backtracks.
_MIXED = (
    rf"(?s)<({_LEAVES})((?:\s[^>]*+(?<!/))?+)>"
    r"((?:[^<]++|<!--.*?-->|<!\[CDATA\[.*?\]\]>)*+)<(?![/!]).*?</\1\s*>"
)
# An affiliation whose tag does not follow the opening of a listed one may stand
# directly below its author. Each direct one gets an element of its own among
# the listed, under another name, so that all of them parse into one list.
_MAYBE_DIRECT = r"<Affiliation(?<!<AffiliationInfo>\s{0,64}<Affiliation)[\s/>]"
_LISTED_OR_DIRECT = (
    r"(?s)(<AffiliationInfo(?:\s[^>]*+(?<!/))?+>.*?</AffiliationInfo\s*>)"
    r"|<(Affiliation)(?:\s[^>/]*+)?+(?:/>|>(.*?)</Affiliation\s*>)"
)
_AS_LISTED = "$1<AffiliationInfo><Direct$2>$3</Direct$2></AffiliationInfo>"


def parse_records(
    records: DataFrame,
    column: str = "record",
    fail_fast: bool = False,
    fields: tuple[str, ...] = FIELDS,
    year_source: str = "revised",
) -> DataFrame:
    """Parse the record text once; adds ``MedlineCitation`` and ``_malformed``.

    Only the elements that ``fields`` need are built. A record that is no
    well-formed XML keeps its text in ``_malformed`` and yields null fields, or
    fails the job with ``fail_fast``.
    """
    text = F.regexp_replace(column, _MIXED, "<$1$2>$3</$1>")
    if "authors_info" in fields:
        text = F.when(
            F.col(column).rlike(_MAYBE_DIRECT), F.regexp_replace(text, _LISTED_OR_DIRECT, _AS_LISTED)
        ).otherwise(text)
    options = {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "_malformed"}
    if fail_fast:
        options["mode"] = "FAILFAST"
    schema = record_schema(fields, year_source)
    if not fail_fast:
        schema += ", _malformed string"
    others = [c for c in records.columns if c != column]
    # inline() keeps the parse below a generator, so it runs once per record
    # however many of its fields are used above.
    parsed = records.select(*others, F.inline(F.array(F.from_xml(text, schema, options))))
    return parsed.withColumn("_malformed", F.lit(None).cast("string")) if fail_fast else parsed


def _blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def _present(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def _texts(values: Column) -> Column:
    """Element texts in order; an empty element gives a null entry."""
    return F.coalesce(F.transform(_present(values), _blank_to_null), F.array().cast("array<string>"))


def _first_text(values: Column) -> Column:
    return _blank_to_null(F.get(_present(values), F.lit(0)))


def _joined(lists: Column) -> Column:
    """Flatten without losing everything to one null sub-list."""
    return F.flatten(_present(lists))


def _first(values: Column) -> Column:
    """The first of several elements of one name."""
    return F.get(values, F.lit(0))


def _scalar(value: Column, missing: str, what: str) -> Column:
    """Text of one element under the missing-value policy.

    ``null`` gives null for an absent or empty element, ``empty`` gives an empty
    string, ``strict`` fails the job when the element is absent.
    """
    if missing == "empty":
        return F.coalesce(value, F.lit(""))
    if missing == "strict":
        return F.when(value.isNull(), F.raise_error(F.lit(f"{what} is missing"))).otherwise(
            _blank_to_null(value)
        )
    return _blank_to_null(value)


def _author(a: Column, missing: str) -> Column:
    info = _present(a["AffiliationInfo"])
    none = F.array().cast("array<string>")
    listed = _joined(F.transform(info, lambda i: i["Affiliation"]))
    everywhere = F.transform(
        info,
        lambda i: F.concat(F.coalesce(i["DirectAffiliation"], none), F.coalesce(i["Affiliation"], none)),
    )
    grid = F.filter(
        _joined(F.transform(info, lambda i: i["Identifier"])), lambda i: i["_Source"] == "GRID"
    )
    # An empty identifier and an absent one differ only under "strict".
    identity = F.get(grid, F.lit(0))["_VALUE"]
    return F.struct(
        _scalar(_first(a["ForeName"]), missing, "ForeName").alias("forename"),
        _scalar(_first(a["LastName"]), missing, "LastName").alias("lastname"),
        _scalar(_first(a["Initials"]), missing, "Initials").alias("initials"),
        _scalar(identity, missing, "GRID identifier").alias("identity"),
        _first_text(listed).alias("affiliation_name"),
        _texts(_joined(everywhere)).alias("affiliation"),
    )


def _year(source: str, missing: str) -> Column:
    revised = _first(F.col("MedlineCitation.DateRevised.Year"))
    published = _first(F.col("MedlineCitation.Article.Journal.JournalIssue.PubDate.Year"))
    if source == "mixed":
        # The value of one date, tested for presence on the other.
        return F.when(_blank_to_null(revised).isNotNull(), _blank_to_null(published)).otherwise(
            F.lit("")
        )
    return _scalar(revised if source == "revised" else published, missing, "Year")


def _check(value: str, allowed: tuple[str, ...], what: str) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}: {value!r}")


def articles(
    records: DataFrame,
    year_source: str = "revised",
    missing: str = "null",
    missing_author: str | None = None,
    fail_fast: bool = False,
    fields: tuple[str, ...] = FIELDS,
) -> DataFrame:
    """Nested articles: title, pmid, year, keyword_list, mesh_list, authors_info.

    Other columns of ``records`` (file, block, ordinal) are kept in front.
    ``missing`` governs title, pmid and year, ``missing_author`` the author
    scalars (the same policy when not given). Only the given ``fields`` are
    parsed and returned, in the order above; a strict policy looks at no other.
    """
    _check(year_source, YEAR_SOURCES, "year_source")
    _check(missing, MISSING_POLICIES, "missing")
    author_policy = missing if missing_author is None else missing_author
    _check(author_policy, MISSING_POLICIES, "missing_author")
    if not fields:
        raise ValueError(f"fields must name some of {', '.join(FIELDS)}")
    for field in fields:
        _check(field, FIELDS, "fields")
    kept = [c for c in records.columns if c != "record"]
    rules = {
        "title": lambda: _scalar(
            _first(F.col("MedlineCitation.Article.ArticleTitle")), missing, "ArticleTitle"
        ),
        "pmid": lambda: _scalar(_first(F.col("MedlineCitation.PMID")), missing, "PMID"),
        "year": lambda: _year(year_source, missing),
        "keyword_list": lambda: _texts(_joined(F.col("MedlineCitation.KeywordList.Keyword"))),
        "mesh_list": _mesh_texts,
        "authors_info": lambda: _people(author_policy),
    }
    parsed = parse_records(records, fail_fast=fail_fast, fields=fields, year_source=year_source)
    return parsed.select(
        *kept,
        *(rule().alias(name) for name, rule in rules.items() if name in fields),
        F.col("_malformed").alias("malformed"),
    )


def _mesh_texts() -> Column:
    headings = _joined(F.col("MedlineCitation.MeshHeadingList.MeshHeading"))
    names = _joined(F.transform(headings, lambda h: h["DescriptorName"]))
    coded = F.filter(names, lambda d: d["_UI"].isNotNull())
    return F.coalesce(
        F.transform(coded, lambda d: _blank_to_null(d["_VALUE"])), F.array().cast("array<string>")
    )


def _people(missing: str) -> Column:
    found = _joined(F.col("MedlineCitation.Article.AuthorList.Author"))
    return F.coalesce(F.transform(found, lambda a: _author(a, missing)), F.array())


def metadata(articles_df: DataFrame) -> DataFrame:
    """Articles without their authors."""
    return articles_df.drop("authors_info")


def authors(articles_df: DataFrame) -> DataFrame:
    """One row per author of every article, in author order (``author_pos``)."""
    kept = [
        c
        for c in articles_df.columns
        if c not in ("title", "year", "keyword_list", "mesh_list", "authors_info", "malformed")
    ]
    return articles_df.select(
        *kept, F.posexplode("authors_info").alias("author_pos", "author")
    ).select(*kept, "author_pos", "author.*")
