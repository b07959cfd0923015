"""Article view over the supplied tables: one article per line item.

Nothing here is an operator. The supplied tables hold no article records, so
articles, authors, affiliations and dictionaries are derived from them, row by
row, and grow with them. The expressions are plain SQL text that Spark and the
checking database both accept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators.sizing import measured

FIRST_WORDS = ("Northern", "Southern", "Eastern", "Western", "Saint", "Royal", "Central", "Coastal")
SECOND_WORDS = ("Harbor", "Albans", "Valley", "River", "Lake", "Forest", "Summit", "Prairie")
KINDS = ("University", "Hospital", "Medical Centre", "Laboratory")
COUNTRIES = (
    "Guinea", "Papua New Guinea", "Guinea-Bissau", "Bosnia Herzegovina", "Niger", "Nigeria",
    "Sudan", "South Sudan", "Netherlands", "The Netherlands", "Ireland {Republic}", "Korea South",
    "South Africa", "United States", "United Kingdom", "Dominica", "Dominican Republic", "Congo",
    "New Zealand", "Japan", "Kenya", "Peru", "Oman", "Chad", "Brazil",
)


def _pick(index: str, words: tuple[str, ...]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words))
    return f"(CASE {index} {whens} END)"


def _text(column: str) -> str:
    return f"cast({column} AS string)"


def _name(kind: str, s: str) -> str:
    second = _pick(f"cast(floor({s} / 8) AS bigint) % 8", SECOND_WORDS)
    return f"{_pick(f'{s} % 8', FIRST_WORDS)} || ' ' || {second} || ' ' || {kind} || ' ' || {_text(s)}"


# Keys of one line item: k order, n line, p part, s supplier, c customer.
def _step_0(order_year: str, ship_year: str) -> dict[str, str]:
    return {
        "pmid": f"{_text('k')} || '-' || {_text('n')} || '-' || {_text('p')} || '-' || {_text('s')}",
        "revised": f"CASE WHEN n % 5 = 0 THEN NULL ELSE {_text(order_year)} END",
        "published": _text(ship_year),
    }


_STEP_0 = _step_0("year(o_orderdate)", "year(l_shipdate)")
_STEP_1 = {
    "forename": f"CASE WHEN s % 7 = 0 THEN NULL ELSE 'F' || {_text('s')} END",
    "identity": f"CASE WHEN s % 3 = 0 THEN 'grid.' || {_text('s')} ELSE NULL END",
    "country": _pick("s_nationkey", COUNTRIES),
    "postcode": (
        f"lpad({_text('s')}, 5, '0') || "
        f"CASE WHEN s % 2 = 0 THEN '-' || lpad({_text('p % 10000')}, 4, '0') ELSE '' END"
    ),
    "true_name": _name(_pick("p % 5", KINDS + ("Works",)), "s"),
}
_STEP_2 = {
    "mention": (
        "CASE cast(floor(p / 5) AS bigint) % 6 WHEN 0 THEN true_name "
        "WHEN 1 THEN substr(true_name, 1, 2) || substr(true_name, 4) "
        "WHEN 2 THEN substr(true_name, 1, 1) || 'x' || substr(true_name, 3) "
        "WHEN 3 THEN substr(true_name, 1, 2) || substr(true_name, 4, 3) || 'q' || substr(true_name, 8) "
        f"WHEN 4 THEN upper(true_name) ELSE 'Alias Hospital ' || {_text('s')} END"
    ),
}
_STEP_3 = {
    "aff1": (
        "'Dept of ' || p_name || ', ' || mention || ', ' || country || ' ' || postcode || '. s' "
        f"|| {_text('s')} || '@mail.example.com'"
    ),
    "aff2": (
        f"'Visiting from France; Guest of ' || {_pick('s % 8', FIRST_WORDS)} || ' Laboratory ; ' "
        "|| mention || ', ' || upper(country)"
    ),
    "aff3": f"'Customer ' || {_text('c')} || ', UK'",
}

_LATER_STEPS = (_STEP_1, _STEP_2, _STEP_3)

_COLUMNS = (
    "l.l_orderkey AS k, l.l_linenumber AS n, l.l_partkey AS p, l.l_suppkey AS s, o.o_custkey AS c, "
    "o.o_orderdate, o.o_orderpriority, l.l_shipdate, l.l_returnflag, p.p_name, p.p_type, p.p_brand, "
    "p.p_size, s.s_name, s.s_nationkey, c.c_name"
)


def _with(step: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {name}" for name, e in step.items())


def table(spark: SparkSession, sf_dir: str, name: str, *spread_by: str) -> DataFrame:
    """A supplied table; one that is read by too few tasks is spread by its keys.

    The supplied files hold one row group each and would otherwise keep a whole
    query in one task. A table with a task per core is left as it is.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread_by and df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores, *spread_by)
    return df


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the columns that an article's texts are made of.

    Of the dates only the years are shuffled, and no line meets its supplier in
    a shuffle while the suppliers are few enough for a broadcast, whatever the
    sizes of their files.
    """
    t = {n: table(spark, sf_dir, n).alias(n[0]) for n in ("orders", "part", "supplier", "customer")}
    # Spread by the key that they meet their orders on, the lines are not shuffled again for that.
    lines = table(spark, sf_dir, "lineitem", "l_orderkey").withColumn("ship_year", F.year("l_shipdate"))
    suppliers = measured(t["supplier"].select("s_suppkey", "s_name", "s_nationkey")).alias("s")
    # Orders meet their customers first: they are fewer than the lines, which are then shuffled twice, not three times.
    orders = t["orders"].withColumn("order_year", F.year("o_orderdate")).alias("o")
    orders = orders.join(t["customer"], F.expr("o.o_custkey = c.c_custkey"))
    joined = (
        lines.alias("l")
        .join(orders, F.expr("l.l_orderkey = o.o_orderkey"))
        .join(t["part"], F.expr("l.l_partkey = p.p_partkey"))
        .join(suppliers, F.expr("l.l_suppkey = s.s_suppkey"))
    )
    # The first step is used once or twice, so it may be inlined, and its dates go where they are not used.
    columns = _COLUMNS.replace("o.o_orderdate", "order_year").replace("l.l_shipdate", "ship_year")
    first = _step_0("order_year", "ship_year")
    return joined.selectExpr(*columns.split(", ")).select("*", *(F.expr(e).alias(name) for name, e in first.items()))


def base(spark: SparkSession, sf_dir: str, order: tuple[str, ...] = ()) -> DataFrame:
    """One row per line item with everything an article is made of, if wanted in an order within its task."""
    out = _keyed(spark, sf_dir)
    if order:
        out = out.sortWithinPartitions(*order)
    for step in _LATER_STEPS:
        # A one-row generator keeps each step's texts from being inlined, many
        # times over, into the expressions that use them.
        made = F.struct(*(F.expr(e).alias(name) for name, e in step.items()))
        out = out.select("*", F.inline(F.array(made)))
    return out


BASE_SQL = f"""
base0 AS (
  SELECT {_COLUMNS}
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
base1 AS (SELECT *, {_with(_STEP_0)}, {_with(_STEP_1)} FROM base0),
base2 AS (SELECT *, {_with(_STEP_2)} FROM base1),
base AS (SELECT *, {_with(_STEP_3)} FROM base2)"""


def _escape(column: str) -> str:
    return f"replace(replace({column}, '&', '&amp;'), '<', '&lt;')"


def _element(tag: str, value: str) -> str:
    return f"'<{tag}>' || {_escape(value)} || '</{tag}>'"


def _optional(tag: str, value: str) -> str:
    return f"coalesce({_element(tag, value)}, '')"


_TITLE = (
    f"CASE WHEN n % 7 = 0 THEN '<b>Urgent</b> order ' || {_text('k')} "
    f"WHEN n % 3 = 0 THEN 'Order ' || {_text('k')} || ' <i>' || o_orderpriority || '</i> tail' "
    f"WHEN n % 3 = 1 THEN 'R&amp;D order ' || {_text('k')} "
    f"ELSE 'Order ' || {_text('k')} || ' ' || o_orderpriority END"
)
_GRID = "coalesce('<Identifier Source=\"GRID\">' || identity || '</Identifier>', '')"
_RECORD = " || ".join(
    (
        "'<PubmedArticle><MedlineCitation Status=\"MEDLINE\"><PMID Version=\"1\">' || pmid || '</PMID>'",
        "coalesce('<DateRevised><Year>' || revised || '</Year><Month>01</Month></DateRevised>', '')",
        "'<Article><Journal><JournalIssue><PubDate><Year>' || published || '</Year></PubDate>'",
        "'</JournalIssue></Journal>\n<ArticleTitle>' || (" + _TITLE + ") || '</ArticleTitle>'",
        "'<Abstract><AbstractText>About ' || p_name || '</AbstractText></Abstract><AuthorList>'",
        "'<Author>' || " + _element("LastName", "s_name") + " || " + _optional("ForeName", "forename"),
        "'<Initials>F</Initials><AffiliationInfo>' || " + _element("Affiliation", "aff1"),
        f"'<Identifier Source=\"ROR\">ror.' || {_text('s')} || '</Identifier>' || " + _GRID,
        # Some second affiliations stand directly below the author, behind a listed one.
        "'</AffiliationInfo>' || CASE WHEN p % 10 = 0 THEN " + _element("Affiliation", "aff2")
        + " WHEN p % 5 = 0 THEN '<AffiliationInfo>' || " + _element("Affiliation", "aff2")
        + " || '</AffiliationInfo>' ELSE '' END || '</Author>\n'",
        "'<Author>' || " + _element("LastName", "c_name"),
        f"'<ForeName>C' || {_text('c')} || '</ForeName><Initials/>'",
        "CASE WHEN c % 4 = 0 THEN '' ELSE '<AffiliationInfo>' || " + _element("Affiliation", "aff3")
        + " || '</AffiliationInfo>' END || '</Author></AuthorList></Article><MeshHeadingList>'",
        "'<MeshHeading><DescriptorName UI=\"B\">' || p_brand || '</DescriptorName></MeshHeading>'",
        f"'<MeshHeading><DescriptorName>' || {_text('p_size')} || '</DescriptorName></MeshHeading>'",
        "CASE WHEN n % 2 = 0 THEN '<MeshHeading><DescriptorName UI=\"T\">Type ' || p_type || "
        "'</DescriptorName></MeshHeading>' ELSE '' END || '</MeshHeadingList>'",
        "'<KeywordList><Keyword>' || p_type || '</Keyword>' || "
        "CASE WHEN n % 4 = 0 THEN '<Keyword/>' ELSE '' END || '</KeywordList>'",
        "'<KeywordList><Keyword>' || l_returnflag || '</Keyword></KeywordList>'",
        "'</MedlineCitation></PubmedArticle>'",
    )
)


def records(spark: SparkSession, sf_dir: str, order: tuple[str, ...] = ()) -> DataFrame:
    """The articles rendered as record text."""
    return base(spark, sf_dir, order).selectExpr(f"{_RECORD} AS record")


#: Names of record files, packed or not.
RECORD_FILES = "*.txt{,.gz}"
#: Records of a packed file, which one task reads.
_PACKED_RECORDS = 250_000


def record_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the rendered records as packed XML text files and return the folder.

    The text is some ninety times the tables it is rendered from; packed it is
    a small multiple of them, smaller where records of a supplier, which share
    most text, are neighbours. A file ends after so many records that all cores
    have files to read.
    """
    rendered = records(spark, sf_dir, ("s", "p"))
    rendered.write.option("maxRecordsPerFile", _PACKED_RECORDS).text(path, compression="gzip")
    return path


def record_files_by_nation(spark: SparkSession, sf_dir: str, path: str) -> str:
    """One packed file of records per supplier nation, ordered by number.

    The keys are shuffled and sorted; the records, some twenty times as long,
    are rendered behind that. Projections keep the order, so the writer does
    not sort the records once more.
    """
    order = ["s_nationkey", "pmid"]
    ordered = _keyed(spark, sf_dir).repartition("s_nationkey").sortWithinPartitions(*order)
    for step in _LATER_STEPS:
        ordered = ordered.select("*", *(F.expr(e).alias(name) for name, e in step.items()))
    rendered = ordered.selectExpr(f"{_RECORD} AS record", "s_nationkey")
    rendered.write.partitionBy("s_nationkey").text(path, compression="gzip")
    return path


#: Order year of which the newest drop has all records.
LATE_YEAR = 1996


def late_file(spark: SparkSession, sf_dir: str, path: str) -> str:
    """One file with the records of a whole order year, not packed, so that it is read in splits."""
    year = base(spark, sf_dir).where(f"order_year = {LATE_YEAR}").selectExpr(f"{_RECORD} AS record")
    year.coalesce(1).write.text(path, compression="none")
    return path


# The same articles in columns, for queries that do not start from text.
_TITLE_SHOWN = (
    "CASE WHEN n % 7 = 0 THEN NULL "
    f"WHEN n % 3 = 0 THEN 'Order ' || {_text('k')} || ' ' "
    f"WHEN n % 3 = 1 THEN 'R&D order ' || {_text('k')} "
    f"ELSE 'Order ' || {_text('k')} || ' ' || o_orderpriority END"
)
_SUPPLIER = (
    "named_struct('forename', forename, 'lastname', s_name, 'initials', 'F', 'identity', identity, "
    "'affiliation_name', aff1, 'affiliation', CASE WHEN p % 5 = 0 THEN array(aff1, aff2) ELSE array(aff1) END)"
)
_CUSTOMER = (
    f"named_struct('forename', 'C' || {_text('c')}, 'lastname', c_name, "
    "'initials', cast(NULL AS string), 'identity', cast(NULL AS string), "
    "'affiliation_name', CASE WHEN c % 4 = 0 THEN NULL ELSE aff3 END, "
    "'affiliation', CASE WHEN c % 4 = 0 THEN cast(array() AS array<string>) ELSE array(aff3) END)"
)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested articles, shaped like the output of the extraction."""
    return base(spark, sf_dir).selectExpr(
        f"{_TITLE_SHOWN} AS title",
        "pmid",
        "revised AS year",
        "concat(array(p_type), CASE WHEN n % 4 = 0 THEN array(cast(NULL AS string)) "
        "ELSE cast(array() AS array<string>) END, array(l_returnflag)) AS keyword_list",
        "CASE WHEN n % 2 = 0 THEN array(p_brand, 'Type ' || p_type) ELSE array(p_brand) END AS mesh_list",
        f"array({_SUPPLIER}, {_CUSTOMER}) AS authors_info",
    )


FLAT_SQL = f"""{BASE_SQL},
article AS (
  SELECT *, {_TITLE_SHOWN} AS title, revised AS year,
    p_type || CASE WHEN n % 4 = 0 THEN '|~' ELSE '' END || '|' || l_returnflag AS keywords,
    p_brand || CASE WHEN n % 2 = 0 THEN '|Type ' || p_type ELSE '' END AS mesh
  FROM base),
flat AS (
  SELECT title, pmid, year, published, keywords, mesh, forename, s_name AS lastname,
    'F' AS initials, identity, aff1 AS affiliation_name, aff1 AS affiliation FROM article
  UNION ALL
  SELECT title, pmid, year, published, keywords, mesh, forename, s_name,
    'F', identity, aff1, aff2 FROM article WHERE p % 5 = 0
  UNION ALL
  SELECT title, pmid, year, published, keywords, mesh, 'C' || {_text('c')}, c_name,
    NULL, NULL, aff3, aff3 FROM article WHERE c % 4 <> 0)"""


def institutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """grid_id, name, ordinal: four names per supplier, some of them twice."""
    supplier = table(spark, sf_dir, "supplier")
    named = supplier.selectExpr("s_suppkey AS s", "explode(array(0, 1, 2, 3)) AS kind").selectExpr(
        "s", "kind", f"{_name(_pick('kind', KINDS), 's')} AS name",
        "explode(CASE WHEN s % 10 = 0 THEN array(0, 1) ELSE array(0) END) AS again",
    )
    return named.selectExpr(
        f"CASE again WHEN 0 THEN 'grid.' ELSE 'grid.again.' END || {_text('s * 4 + kind')} AS grid_id",
        "name",
        "s * 4 + kind + again * 1000000000000 AS ordinal",
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """grid_id, alias, ordinal: an alias for every fifth supplier, given twice."""
    supplier = table(spark, sf_dir, "supplier").where("s_suppkey % 5 = 0")
    return supplier.selectExpr("s_suppkey AS s", "explode(array(0, 1)) AS again").selectExpr(
        f"CASE again WHEN 0 THEN 'grid.a' ELSE 'grid.b' END || {_text('s')} AS grid_id",
        f"'Alias Hospital ' || {_text('s')} AS alias",
        "s + again * 1000000000000 AS ordinal",
    )


DICTIONARY_SQL = f"""
kinds AS (SELECT unnest([0, 1, 2, 3]) AS kind),
copies AS (SELECT unnest([0, 1]) AS again),
institutes AS (
  SELECT CASE again WHEN 0 THEN 'grid.' ELSE 'grid.again.' END || {_text('s_suppkey * 4 + kind')} AS grid_id,
    {_name(_pick('kind', KINDS), 's_suppkey')} AS name,
    s_suppkey * 4 + kind + again * 1000000000000 AS ordinal
  FROM supplier, kinds, copies WHERE again = 0 OR s_suppkey % 10 = 0),
aliases AS (
  SELECT CASE again WHEN 0 THEN 'grid.a' ELSE 'grid.b' END || {_text('s_suppkey')} AS grid_id,
    'Alias Hospital ' || {_text('s_suppkey')} AS alias,
    s_suppkey + again * 1000000000000 AS ordinal
  FROM supplier, copies WHERE s_suppkey % 5 = 0)"""
