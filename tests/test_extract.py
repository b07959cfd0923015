"""Extraction against literal rows."""

import pytest
from pyspark.sql import functions as F

from citeloom.operators import extract, lookup
from citeloom.operators.flatten import flatten
from citeloom.sources import records
from citeloom.sources.records import first_records, record_at, scan_records, with_ordinal

RECORDS = [
    """<PubmedArticle><MedlineCitation Status="MEDLINE"><PMID Version="1">11</PMID>
<DateRevised><Year>2020</Year></DateRevised><Article>
<Journal><JournalIssue><PubDate><Year>2019</Year></PubDate></JournalIssue></Journal>
<ArticleTitle>Plain &lt;b&gt; &amp; <i>x</i> tail <sub>2</sub></ArticleTitle><AuthorList CompleteYN="Y">
<Author><LastName>O'Neil</LastName><ForeName> Ann </ForeName><Initials></Initials>
<AffiliationInfo><Affiliation>Dept, <sup>1</sup>Univ</Affiliation>
<Identifier Source="ROR">r.1</Identifier><Identifier Source="GRID">g.1</Identifier></AffiliationInfo>
<AffiliationInfo><Affiliation>B &amp; C</Affiliation></AffiliationInfo>
<AffiliationInfo><Affiliation/><Identifier Source="GRID">g.2</Identifier></AffiliationInfo></Author>
<Author><CollectiveName>Group</CollectiveName></Author>
<Author><LastName>Old</LastName><Affiliation>direct place</Affiliation></Author>
</AuthorList></Article><MeshHeadingList>
<MeshHeading><DescriptorName UI="D1">Mesh one</DescriptorName></MeshHeading>
<MeshHeading><DescriptorName>No id</DescriptorName></MeshHeading>
<MeshHeading><DescriptorName UI="D2"/></MeshHeading></MeshHeadingList>
<KeywordList><Keyword MajorTopicYN="N">k1</Keyword><Keyword/><Keyword> </Keyword>
<Keyword><i>x</i>y</Keyword></KeywordList>
<KeywordList><Keyword>k<!-- note -->3</Keyword><Keyword><![CDATA[c<d]]> e</Keyword></KeywordList>
</MedlineCitation></PubmedArticle>""",
    '<PubmedArticle><MedlineCitation><PMID>12</PMID><DateRevised><Year/></DateRevised>'
    "<Article><ArticleTitle><b>Bold</b> first</ArticleTitle></Article></MedlineCitation></PubmedArticle>",
    "<PubmedArticle ><MedlineCitation><PMID>13</PMID><Article><ArticleTitle></ArticleTitle>"
    "<AuthorList><Author><ForeName>Bo</ForeName><LastName>Li</LastName><AffiliationInfo>"
    "<Affiliation>Höpital élan, 12345</Affiliation></AffiliationInfo></Author></AuthorList>"
    "</Article></MedlineCitation></PubmedArticle>",
    "<PubmedArticle><MedlineCitation><PMID>14</PMID><DateRevised><Year>1999</Year></DateRevised>"
    '<Article><ArticleTitle book="x">Line\nbreak</ArticleTitle><AuthorList><Author>'
    "<LastName>A<sup>b</sup></LastName><ForeName/><AffiliationInfo><Identifier Source='GRID'>g.9"
    "</Identifier></AffiliationInfo></Author></AuthorList></Article></MedlineCitation></PubmedArticle>",
]
DOCUMENT = (
    '<?xml version="1.0"?>\n<!DOCTYPE PubmedArticleSet>\n<PubmedArticleSet>\n'
    + RECORDS[0]
    + "\n"
    + RECORDS[1]
    + RECORDS[2]
    + "\n"
    + RECORDS[3]
    + "\n</PubmedArticleSet>\n"
)


#: Title, number, year, keywords, headings and people of each record.
EXPECTED = [('Plain <b> & ',
  '11',
  '2020',
  ['k1', None, ' ', None, 'k3', 'c<d e'],
  ['Mesh one', None],
  [(' Ann ', "O'Neil", None, 'g.1', 'Dept, ', ['Dept, ', 'B & C', None]),
   (None, None, None, None, None, []),
   (None, 'Old', None, None, None, ['direct place'])]),
 (None, '12', None, [], [], []),
 (None, '13', None, [], [], [('Bo', 'Li', None, None, 'Höpital élan, 12345', ['Höpital élan, 12345'])]),
 ('Line\nbreak', '14', '1999', [], [], [(None, 'A', None, 'g.9', None, [])])]


@pytest.fixture(scope="module")
def document(tmp_path_factory):
    folder = tmp_path_factory.mktemp("xml")
    (folder / "set.xml").write_text(DOCUMENT, encoding="utf-8")
    return str(folder / "set.xml")


@pytest.fixture(scope="module")
def scanned(spark, document):
    return scan_records(spark, document)


def test_scan_finds_every_record(scanned):
    assert scanned.count() == 4


def test_scan_is_split(spark, tmp_path):
    body = RECORDS[0] + "\n"
    (tmp_path / "big.xml").write_text("<PubmedArticleSet>\n" + body * 900 + "</PubmedArticleSet>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        records = scan_records(spark, str(tmp_path / "big.xml"))
        assert records.rdd.getNumPartitions() > 8
        assert records.count() == 900
        numbered = with_ordinal(records)
        assert numbered.select("block").distinct().count() > 8
        found = sorted(r.ordinal for r in numbered.select("ordinal").collect())
        assert found == list(range(900))
        parsed = extract.articles(records)
        assert parsed.where(F.col("pmid") == "11").count() == 900
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_set(spark, tmp_path):
    (tmp_path / "empty.xml").write_text('<?xml version="1.0"?>\n<PubmedArticleSet>\n</PubmedArticleSet>')
    assert scan_records(spark, str(tmp_path / "empty.xml")).count() == 0


def test_articles(scanned):
    rows = extract.articles(with_ordinal(scanned)).orderBy("ordinal").collect()
    got = [
        (
            r.title,
            r.pmid,
            r.year,
            list(r.keyword_list),
            list(r.mesh_list),
            [
                (a.forename, a.lastname, a.initials, a.identity, a.affiliation_name, list(a.affiliation))
                for a in r.authors_info
            ],
        )
        for r in rows
    ]
    assert got == EXPECTED
    assert all(r.malformed is None for r in rows)


def test_record_is_parsed_once(scanned):
    plan = flatten(extract.articles(scanned))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") + plan.count("xmltostructs") == 1


def test_year_sources(scanned):
    def years(source, missing="null"):
        rows = extract.articles(scanned, year_source=source, missing=missing).collect()
        return {r.pmid: r.year for r in rows}

    assert years("revised") == {"11": "2020", "12": None, "13": None, "14": "1999"}
    assert years("published") == {"11": "2019", "12": None, "13": None, "14": None}
    assert years("mixed") == {"11": "2019", "12": "", "13": "", "14": None}
    assert years("revised", "empty") == {"11": "2020", "12": "", "13": "", "14": "1999"}
    with pytest.raises(ValueError):
        extract.articles(scanned, year_source="other")


def test_missing_author_fields(scanned):
    people = extract.authors(extract.articles(scanned, missing="empty"))
    got = {(r.pmid, r.author_pos): (r.forename, r.lastname, r.identity) for r in people.collect()}
    assert got[("11", 1)] == ("", "", "")
    assert got[("14", 0)] == ("", "A", "g.9")


def test_strict_fails_on_absent_tag(scanned):
    with pytest.raises(Exception, match="Year is missing"):
        extract.articles(scanned, missing="strict", missing_author="null").collect()
    with pytest.raises(Exception, match="is missing"):
        extract.articles(scanned, missing="null", missing_author="strict").collect()


def test_malformed_record(spark):
    bad = spark.createDataFrame([("<PubmedArticle><PMID>1</PubmedArticle>",)], "record string")
    row = extract.articles(bad).first()
    assert row.pmid is None and row.malformed.startswith("<PubmedArticle>")
    with pytest.raises(Exception):
        extract.articles(bad, fail_fast=True).collect()


def test_flatten_variants(scanned):
    nested = extract.articles(scanned)
    rows = flatten(nested).collect()
    wanted = []
    for title, pmid, year, keywords, mesh, people in EXPECTED:
        for forename, lastname, initials, identity, first, places in people:
            for place in places:
                name = None if forename is None or lastname is None else forename + " " + lastname
                wanted.append(
                    (title, pmid, year, keywords, mesh, forename, lastname, name, initials, identity, place)
                )
    key = lambda t: tuple(str(x) for x in t)
    assert sorted((tuple(r) for r in rows), key=key) == sorted(wanted, key=key)
    assert len(flatten(nested, with_affiliation_name=True).columns) == 12
    assert flatten(nested, with_full_name=False).columns == [
        "title", "pmid", "year", "keyword_list", "mesh_list", "forename", "lastname",
        "initials", "identity", "affiliation",
    ]


def test_lookups(scanned):
    nested = extract.articles(with_ordinal(scanned))
    assert lookup.article_count(nested).first().num_articles == 4
    assert lookup.article_at(nested, 0).first().pmid == "11"
    assert lookup.article_at(nested, -1).first().pmid == "14"
    assert lookup.article_at(nested, 9).count() == 0
    with pytest.raises(IndexError):
        lookup.article_at(nested, 9, strict=True)
    assert {r.pmid for r in lookup.first_articles(nested, 2).collect()} == {"11", "12"}
    assert lookup.first_articles(nested, 50).count() == 4
    assert lookup.first_articles(nested, None).count() == 4
    people = extract.authors(nested)
    assert lookup.authors_by_name(people, "Bo Q. Li").first().pmid == "13"
    assert lookup.authors_by_name(people, "bo Li").count() == 0
    assert lookup.authors_by_identity(people, "g.1").first().lastname == "O'Neil"
    with pytest.raises(ValueError):
        lookup.authors_by_name(people, "Li")
    assert extract.metadata(nested).columns.count("authors_info") == 0
    ordered = lookup.first_rows(nested.select("ordinal", "pmid"), 2, "ordinal").collect()
    assert [r.pmid for r in ordered] == ["11", "12"]


def test_first_of_several_elements(spark):
    record = (
        "<PubmedArticle><MedlineCitation><PMID>1</PMID><PMID>2</PMID>"
        "<DateRevised><Year>2001</Year><Year>2002</Year></DateRevised>"
        "<Article><ArticleTitle>t1</ArticleTitle><ArticleTitle>t2</ArticleTitle><AuthorList><Author>"
        "<LastName>a</LastName><LastName>b</LastName><ForeName/><ForeName>f</ForeName>"
        "<Initials>i</Initials></Author></AuthorList></Article></MedlineCitation></PubmedArticle>"
    )
    found = extract.articles(spark.createDataFrame([(record,)], "record string")).first()
    assert (found.pmid, found.title, found.year) == ("1", "t1", "2001")
    person = found.authors_info[0]
    assert (person.forename, person.lastname, person.initials) == (None, "a", "i")


def test_a_file_cut_inside_a_record_is_named(spark, tmp_path):
    record = "<PubmedArticle><MedlineCitation><PMID>{}</PMID></MedlineCitation></PubmedArticle>\n"
    many = "".join(record.format(i) for i in range(500))
    (tmp_path / "whole.xml").write_text(f"<PubmedArticleSet>{many}</PubmedArticleSet>")
    (tmp_path / "lines.xml").write_text(many)
    (tmp_path / "empty.xml").write_text("<PubmedArticleSet></PubmedArticleSet>")
    assert records.truncated_files(spark, str(tmp_path)).count() == 0
    records.require_complete(spark, str(tmp_path))
    cut = f"<PubmedArticleSet>{many}"
    (tmp_path / "cut.xml").write_text(cut[: len(cut) - 20])
    (tmp_path / "edge.xml").write_text(cut[: -len("</PubmedArticle>\n")])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4k", before):  # over several splits, and in one
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = records.truncated_files(spark, str(tmp_path)).collect()
            assert sorted(r.file.rsplit("/", 1)[-1] for r in found) == ["cut.xml", "edge.xml"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(ValueError, match="cut.xml"):
        records.require_complete(spark, str(tmp_path))


def test_affiliations_keep_document_order(spark):
    def record(inside):
        return (
            "<PubmedArticle><MedlineCitation><Article><AuthorList>"
            f"<Author>{inside}</Author></AuthorList></Article></MedlineCitation></PubmedArticle>"
        )

    listed = "<AffiliationInfo>\n <Affiliation>{}</Affiliation></AffiliationInfo>".format
    direct = "<Affiliation>{}</Affiliation>".format
    grid = '<AffiliationInfo><Identifier Source="GRID">g.1</Identifier><Affiliation>l3</Affiliation></AffiliationInfo>'
    wanted = {
        record(listed("l1") + direct("d1")): ("l1", None, ["l1", "d1"]),
        record(direct("d1") + listed("l1")): ("l1", None, ["d1", "l1"]),
        record(listed("l1") + direct("d1") + listed("l2") + direct("d2")): ("l1", None, ["l1", "d1", "l2", "d2"]),
        record(direct("d1") + direct("d2")): (None, None, ["d1", "d2"]),
        record("<Affiliation/>" + grid + '<Affiliation a="x" />'): ("l3", "g.1", [None, "l3", None]),
        record(direct("a <i>b</i> c") + "<AffiliationInfo/><AffiliationInfo />" + listed("e &lt;")): ("e <", None, ["a ", "e <"]),
        record(listed("$1 l") + direct("$2 d")): ("$1 l", None, ["$1 l", "$2 d"]),
        record('<AffiliationInfo n="1"><Affiliation>x</Affiliation><Affiliation>y</Affiliation></AffiliationInfo>'): ("x", None, ["x", "y"]),
        record("<LastName>a</LastName>"): (None, None, []),
    }
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(wanted)], "n int, record string")
    people = extract.authors(extract.articles(rows)).orderBy("n").collect()
    got = [(p.affiliation_name, p.identity, list(p.affiliation)) for p in people]
    assert got == list(wanted.values())


@pytest.mark.parametrize(
    "fields", [("pmid",), ("year", "title"), extract.METADATA, ("pmid", "authors_info"), ("mesh_list",), ("keyword_list",)]
)
@pytest.mark.parametrize("source", extract.YEAR_SOURCES)
def test_fields_asked_for_equal_those_of_a_whole_parse(spark, scanned, fields, source):
    bad = spark.createDataFrame([("<PubmedArticle><PMID>1</PubmedArticle>",)], "record string")
    rows = scanned.select("record").unionByName(bad)
    whole = extract.articles(rows, source)
    part = extract.articles(rows, source, fields=fields)
    assert part.columns == [f for f in extract.FIELDS if f in fields] + ["malformed"]
    key = lambda rows: sorted(map(repr, rows))
    assert key(part.collect()) == key(whole.select(part.columns).collect())


def test_only_elements_asked_for_are_in_the_schema(scanned):
    schema = extract.record_schema
    assert "Author" not in schema(extract.METADATA) and "Journal" not in schema(extract.METADATA)
    plan = extract.articles(scanned, fields=("pmid",))._jdf.queryExecution().optimizedPlan().toString()
    assert "PMID" in plan and "AuthorList" not in plan and "Keyword,array" not in plan
    people = schema(("pmid", "authors_info"))
    assert not any(name in people for name in ("Mesh", "Keyword", "Title", "Year"))
    assert "DateRevised" not in schema(("year",), "published")
    for wrong in ((), ("author",)):
        with pytest.raises(ValueError):
            extract.articles(scanned, fields=wrong)


def test_positions_are_found_without_numbering_all_records(spark, tmp_path):
    record = "<PubmedArticle><MedlineCitation><PMID>{}</PMID></MedlineCitation></PubmedArticle>\n"
    sizes = {"a.xml": 700, "b.xml": 3, "c.xml": 0, "d.xml": 41}
    for name, n in sizes.items():
        head = "<PubmedArticleSet>" + " " * (9000 if name == "d.xml" else 0)  # longer than a split
        body = "".join(record.format(f"{name}-{i}") for i in range(n))
        (tmp_path / name).write_text(f"{head}{body}</PubmedArticleSet>")
    path, before = str(tmp_path), spark.conf.get("spark.sql.files.maxPartitionBytes")

    def found(records):
        rows = extract.articles(records, fields=("pmid",)).collect()
        assert all(r.pmid.endswith(f"-{r.ordinal}") for r in rows)
        return sorted(r.pmid for r in rows)

    try:
        for size in ("4k", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for n in (0, 2, 40, 699, 700):
                assert found(record_at(spark, path, n)) == sorted(f"{f}-{n}" for f, k in sizes.items() if k > n)
            for n in (-1, -3, -4, -700, -701):
                assert found(record_at(spark, path, n)) == sorted(f"{f}-{k + n}" for f, k in sizes.items() if k >= -n)
            for cap in (0, 1, 42, 1000):
                assert found(first_records(spark, path, cap)) == sorted(
                    f"{f}-{i}" for f, k in sizes.items() for i in range(min(k, cap))
                )
        plan = record_at(spark, path, 5)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
        with pytest.raises(Exception, match="split otherwise"):
            plan.select("*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_that_cannot_hold_a_looked_up_author_are_not_parsed(spark):
    person = "<LastName>{}</LastName><ForeName>{}</ForeName><AffiliationInfo><Identifier Source='GRID'>{}</Identifier></AffiliationInfo>"
    written = [
        ("Lee", "Ann", "g.1"),
        ("L&#101;e", "Ann", "g.1"),
        ("L<![CDATA[ee]]>", "A<!-- x -->nn", "g<![CDATA[.1]]>"),
        ("Lee<?note?>", "Ann", "g&#x2E;1"),
        ("Lee<sup>1</sup>", "Ann", "g.1<i>2</i>"),
        ("R&amp;D", "Tom &lt;b&gt;", "g.2"),
        ("Roe", "Tom", "g.11"),
        ("Roe", "Tom", ""),
    ]
    texts = [
        f"<PubmedArticle><MedlineCitation><PMID>{i}</PMID><Article><AuthorList><Author>{person.format(*p)}</Author>"
        "</AuthorList></Article></MedlineCitation></PubmedArticle>"
        for i, p in enumerate(written)
    ] + ["<PubmedArticle>Lee Ann g.1", None]
    raw = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "record string, block int")

    def people(chosen):
        return extract.authors(extract.articles(chosen, fields=("pmid", "authors_info")))

    def pmids(found):
        return sorted(r.pmid for r in found.collect())

    by_id = lookup.may_hold(raw, "g.1")
    assert {r.block for r in by_id.collect()} == {0, 1, 2, 3, 4, 6, 8}
    assert pmids(lookup.authors_by_identity(people(by_id), "g.1")) == ["0", "1", "2", "3", "4"]
    assert pmids(lookup.authors_by_identity(people(raw), "g.1")) == ["0", "1", "2", "3", "4"]
    by_name = lookup.may_hold_name(raw, "Ann B Lee")
    assert {r.block for r in by_name.collect()} == {0, 1, 2, 3, 4, 8}
    assert pmids(lookup.authors_by_name(people(by_name), "Ann B Lee")) == ["0", "1", "2", "3", "4"]
    assert pmids(lookup.authors_by_name(people(raw), "Ann B Lee")) == ["0", "1", "2", "3", "4"]
    # Texts that may be written in several ways leave all records.
    assert lookup.may_hold(raw, "R&D").count() == len(texts)
