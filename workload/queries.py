"""The registered queries: every operator run over the supplied tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.columns import together
from citeloom.functions.fixed import WORLD_COUNTRIES
from citeloom.operators import extract, lookup, resolve, similarity, tagging
from citeloom.operators.flatten import flatten, with_contact_columns
from citeloom.operators.row_index import with_row_index
from citeloom.plans import pipeline
from citeloom.sinks.csv_sink import write_csv
from citeloom.sources.dictionaries import read_aliases, read_institutes, read_word_list
from citeloom.sources.drops import latest_path
from citeloom.sources.records import first_records, record_at, scan_records, with_ordinal
from citeloom.sources.staged import new_stage_path, read_staged_csv
from citeloom.streaming.ingest import ingest_new_files
from workload import view

_KEY = ("pmid", "lastname", "affiliation")
_PEOPLE = ("pmid", "authors_info")


def _listed(column: str) -> F.Column:
    return F.array_join(column, "|", "~")


def _lists_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"keywords": _listed("keyword_list"), "mesh": _listed("mesh_list")}
    ).drop("keyword_list", "mesh_list")


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(view.articles(spark, sf_dir), with_affiliation_name=True)


def _parsed(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return extract.articles(view.records(spark, sf_dir), **options)


def _files(spark: SparkSession, sf_dir: str) -> str:
    return view.record_files(spark, sf_dir, new_stage_path(spark, "record-files"))


# Text extraction


def email_extract(spark, sf_dir):
    documents = view.table(spark, sf_dir, "documents", "doc_id")
    return with_contact_columns(documents, "text").select(
        "doc_id", F.col("author_email").alias("email")
    )


def zipcode_extract(spark, sf_dir):
    return with_contact_columns(_flat(spark, sf_dir)).select(*_KEY, "zipcode")


def contact_columns(spark, sf_dir):
    return with_contact_columns(_flat(spark, sf_dir)).select(*_KEY, "author_email", "zipcode")


# Records from text


def xml_articles(spark, sf_dir):
    nested = _parsed(spark, sf_dir)
    return _lists_as_text(nested).select(
        "pmid",
        "title",
        "year",
        "keywords",
        "mesh",
        F.size("authors_info").cast("bigint").alias("num_authors"),
        F.col("malformed").isNotNull().alias("is_malformed"),
    )


def xml_file_scan(spark, sf_dir):
    nested = extract.articles(
        scan_records(spark, _files(spark, sf_dir)), year_source="published", fields=extract.METADATA
    )
    return _lists_as_text(nested).select("pmid", "title", "year", "keywords", "mesh")


def xml_mixed_year(spark, sf_dir):
    return _parsed(
        spark, sf_dir, year_source="mixed", missing="empty", fields=("pmid", "title", "year")
    ).select("pmid", "title", "year")


def author_records(spark, sf_dir):
    people = extract.authors(_parsed(spark, sf_dir, missing_author="empty", fields=_PEOPLE))
    return people.select(
        "pmid",
        F.col("author_pos").cast("bigint").alias("author_pos"),
        "forename",
        "lastname",
        "initials",
        "identity",
        "affiliation_name",
        F.array_join("affiliation", "|").alias("affiliations"),
    )


def record_ordinals(spark, sf_dir):
    numbered = with_ordinal(scan_records(spark, _files(spark, sf_dir)))
    per_file = numbered.groupBy("file").agg(
        F.count("*").alias("n"), F.max("ordinal").alias("last"), F.sum("ordinal").alias("total")
    )
    # In every file the positions are 0 .. n - 1.
    return per_file.agg(
        F.sum("n").alias("num_records"),
        F.sum(F.expr("last + 1")).alias("num_positions"),
        F.sum(F.expr("total - n * (n - 1) div 2")).alias("gap"),
    )


def _nation_files(spark, sf_dir):
    return view.record_files_by_nation(spark, sf_dir, new_stage_path(spark, "nation-files"))


def first_articles(spark, sf_dir):
    capped = first_records(spark, _nation_files(spark, sf_dir), 50)
    return extract.articles(capped, fields=("pmid", "title")).select("ordinal", "pmid", "title")


def article_at(spark, sf_dir):
    path = _nation_files(spark, sf_dir)

    def at(n):
        found = extract.articles(record_at(spark, path, n), fields=("pmid",))
        return found.select("pmid", F.lit(n).alias("n"))

    return at(3).unionByName(at(-2))


def article_count(spark, sf_dir):
    return lookup.article_count(view.records(spark, sf_dir))


def _drops(spark, sf_dir):
    prefix = new_stage_path(spark, "drops")
    view.record_files(spark, sf_dir, f"{prefix}/early")
    view.late_file(spark, sf_dir, f"{prefix}/late")
    return prefix


def latest_drop_articles(spark, sf_dir):
    newest = latest_path(spark, _drops(spark, sf_dir), view.RECORD_FILES)
    nested = extract.articles(scan_records(spark, newest), fields=("pmid", "title"))
    return nested.select("pmid", "title")


# Flat rows and lookups


def flatten_rows(spark, sf_dir):
    return _lists_as_text(flatten(_parsed(spark, sf_dir)))


def flatten_with_affiliation_name(spark, sf_dir):
    return _lists_as_text(_flat(spark, sf_dir))


def flatten_no_full_name(spark, sf_dir):
    return _lists_as_text(flatten(_parsed(spark, sf_dir, year_source="published"), False))


def first_n(spark, sf_dir):
    ordered = lookup.first_rows(_flat(spark, sf_dir), 50, *_KEY)
    return ordered.select(*_KEY, "full_name")


def row_index(spark, sf_dir):
    return with_row_index(_flat(spark, sf_dir).select(*_KEY), *_KEY)


def author_by_name(spark, sf_dir):
    name = "F8 Supplier#000000008"
    asked = lookup.may_hold_name(view.records(spark, sf_dir), name)
    people = extract.authors(extract.articles(asked, fields=_PEOPLE))
    return lookup.authors_by_name(people, name).select(
        "pmid", "forename", "lastname", "initials", "affiliation_name"
    )


def author_by_identity(spark, sf_dir):
    asked = lookup.may_hold(view.records(spark, sf_dir), "grid.9")
    people = extract.authors(extract.articles(asked, fields=_PEOPLE))
    return lookup.authors_by_identity(people, "grid.9").select("pmid", "lastname", "identity")


# Tagging


def country_last(spark, sf_dir):
    return tagging.tag_countries(_flat(spark, sf_dir)).select(*_KEY, "country")


def country_unmatchable(spark, sf_dir):
    tagged = tagging.tag_countries(_flat(spark, sf_dir), include_unmatchable=True)
    return tagged.select(*_KEY, "country")


def _to_tag(spark, sf_dir):
    """Only what the result has: the texts and the rows are read from the same shuffles."""
    return together(_flat(spark, sf_dir).select(*_KEY))


def country_word_list(spark, sf_dir):
    path = new_stage_path(spark, "countries")
    spark.createDataFrame([(c,) for c in WORLD_COUNTRIES], "name string").write.text(path)
    countries = read_word_list(spark, path)
    return tagging.tag_countries(_to_tag(spark, sf_dir), countries).select(*_KEY, "country")


def country_by_join(spark, sf_dir):
    countries = spark.createDataFrame([(c,) for c in WORLD_COUNTRIES], "name string")
    return tagging.tag_from_dictionary(_to_tag(spark, sf_dir), countries).select(*_KEY, "country")


def institution_first(spark, sf_dir):
    return tagging.tag_first_institution(_flat(spark, sf_dir)).select(*_KEY, "institutions")


def institution_all(spark, sf_dir):
    tagged = tagging.tag_all_institutions(_flat(spark, sf_dir))
    return tagged.select(*_KEY, F.array_join("institutions", "|").alias("institutions"))


# Similarity joins


def _first_tagged(spark, sf_dir):
    return tagging.tag_first_institution(_flat(spark, sf_dir)).select(*_KEY, "institutions")


def _all_tagged(spark, sf_dir):
    return tagging.tag_all_institutions(_flat(spark, sf_dir)).select(*_KEY, "institutions")


def fuzzy_best(spark, sf_dir):
    return similarity.match_column(
        _first_tagged(spark, sf_dir), "institutions", view.institutes(spark, sf_dir)
    )


def fuzzy_supplier_names(spark, sf_dir):
    supplier = view.table(spark, sf_dir, "supplier")
    spoiled = supplier.selectExpr(
        "s_suppkey",
        "substr(s_name, 1, 9 + int(s_suppkey % 9)) || 'x' || substr(s_name, 11 + int(s_suppkey % 9))"
        " AS mention",
    )
    names = supplier.select("s_name", "s_suppkey")
    table = similarity.best_match_table(
        spoiled.select("mention").distinct(), names, name="s_name", ordinal="s_suppkey"
    )
    return spoiled.join(table, "mention", "left").select("s_suppkey", "mention", "match")


def fuzzy_first_ratio(spark, sf_dir):
    return similarity.match_column(
        _first_tagged(spark, sf_dir), "institutions", view.institutes(spark, sf_dir),
        scorer="ratio",
    )


def fuzzy_ratio_low(spark, sf_dir):
    return similarity.match_column(
        _first_tagged(spark, sf_dir), "institutions", view.institutes(spark, sf_dir),
        scorer="ratio", threshold=0.8,
    )


def fuzzy_long_names(spark, sf_dir):
    supplier = view.table(spark, sf_dir, "supplier")
    long = supplier.selectExpr(
        "s_suppkey", "s_name || ', ' || repeat(s_name || '; ', 4) || s_name AS name"
    )
    spoiled = long.selectExpr("s_suppkey", "substr(name, 4, 20) || 'x' || substr(name, 26) AS mention")
    table = similarity.first_ratio_table(spoiled.select("mention").distinct(), long, ordinal="s_suppkey")
    return spoiled.join(table, "mention", "left").select("s_suppkey", "mention", "match")


def fuzzy_ratio_arrays(spark, sf_dir):
    matched = similarity.match_array(
        _all_tagged(spark, sf_dir), "institutions", view.institutes(spark, sf_dir)
    )
    return matched.select(*_KEY, _listed("grid_institutions").alias("grid_institutions"))


def partial_last(spark, sf_dir):
    matched = similarity.match_last(
        _all_tagged(spark, sf_dir), "institutions", view.institutes(spark, sf_dir)
    )
    return matched.select(*_KEY, "grid_institution_names")


# Resolution


def _to_resolve(spark, sf_dir):
    flat = tagging.tag_first_institution(_flat(spark, sf_dir))
    return flat.select(*_KEY, "identity", "institutions", F.col("institutions").alias("grid_institutions"))


def _resolve(spark, sf_dir, use_aliases=True, preserve_existing=True):
    aliases = view.aliases(spark, sf_dir) if use_aliases else None
    return resolve.resolve_identity(
        _to_resolve(spark, sf_dir), view.institutes(spark, sf_dir), aliases, preserve_existing
    ).select(*_KEY, "identity")


def dictionary_scan(spark, sf_dir):
    path = new_stage_path(spark, "institutes")
    view.institutes(spark, sf_dir).select("grid_id", "name").write.csv(path, header=True)
    return resolve.first_id(read_institutes(spark, path), "name")


def alias_scan(spark, sf_dir):
    path = new_stage_path(spark, "aliases")
    view.aliases(spark, sf_dir).select("grid_id", "alias").write.csv(path, header=True)
    return resolve.first_id(read_aliases(spark, path), "alias")


def latest_snapshot(spark, sf_dir):
    events = view.table(spark, sf_dir, "events")
    newest = F.struct(F.col("ts"), -F.col("event_id"))
    return events.groupBy("event_type").agg(
        F.max_by("event_id", newest).alias("event_id"), F.max_by("value", newest).alias("value")
    )


# Whole runs

_RUN_COLUMNS = (
    "title", "pmid", "year", "keywords", "mesh", "forename", "lastname", "full_name", "initials",
    "identity", "affiliation", "author_email", "zipcode", "country", "institutions",
    "grid_institutions",
)


def _run(spark, sf_dir, options=pipeline.LOCAL):
    rows = pipeline.run(
        spark,
        _files(spark, sf_dir),
        view.institutes(spark, sf_dir),
        view.aliases(spark, sf_dir),
        options=options,
    )
    return _lists_as_text(rows).select(*_RUN_COLUMNS)


def pipeline_staged(spark, sf_dir):
    rows = pipeline.run_staged(
        view.records(spark, sf_dir),
        view.institutes(spark, sf_dir),
        pipeline.StagePaths.under(new_stage_path(spark, "stages")),
    )
    return _lists_as_text(rows).withColumns(
        {
            "institutions": F.array_join("institutions", "|"),
            "grid_institutions": _listed("grid_institutions"),
        }
    )


def csv_round_trip(spark, sf_dir):
    rows = flatten(_parsed(spark, sf_dir))
    path = write_csv(rows, new_stage_path(spark, "csv"), line_breaks="escape", compression="gzip")
    back = read_staged_csv(spark, path, rows.columns, ("keyword_list", "mesh_list"), "escape")
    return _lists_as_text(back)


def latest_run(spark, sf_dir):
    """Newest drop to run-stamped CSV with row numbers, read back."""
    path = pipeline.run_latest(
        spark,
        _drops(spark, sf_dir),
        new_stage_path(spark, "results"),
        view.institutes(spark, sf_dir),
        view.aliases(spark, sf_dir),
        pattern=view.RECORD_FILES,
        index_order=_KEY,
        compression="gzip",
    )
    named = spark.read.csv(path, header=True).columns[1:]
    back = read_staged_csv(spark, path, ["row_index", *named], ("keyword_list", "mesh_list"))
    stamp = r"/processed_article_data_\d{4}-\d\d-\d\d_\d\d-\d\d-\d\d$"
    return _lists_as_text(back).select(
        F.col("row_index").cast("bigint").alias("row_index"),
        *_RUN_COLUMNS,
        F.lit(path).rlike(stamp).alias("is_stamped"),
    )


def incremental_ingest(spark, sf_dir):
    source, output = _files(spark, sf_dir), new_stage_path(spark, "ingested")
    query = ingest_new_files(
        spark,
        source,
        output,
        new_stage_path(spark, "ingest-progress"),
        view.institutes(spark, sf_dir),
        view.aliases(spark, sf_dir),
        output="parquet",
        pattern=view.RECORD_FILES,
    )
    query.awaitTermination()
    return _lists_as_text(spark.read.parquet(f"{output}/*")).select(*_RUN_COLUMNS)


QUERIES = {
    "email_extract": email_extract,
    "zipcode_extract": zipcode_extract,
    "contact_columns": contact_columns,
    "xml_articles": xml_articles,
    "xml_file_scan": xml_file_scan,
    "xml_mixed_year": xml_mixed_year,
    "author_records": author_records,
    "record_ordinals": record_ordinals,
    "first_articles": first_articles,
    "article_at": article_at,
    "article_count": article_count,
    "latest_drop_articles": latest_drop_articles,
    "flatten": flatten_rows,
    "flatten_with_affiliation_name": flatten_with_affiliation_name,
    "flatten_no_full_name": flatten_no_full_name,
    "first_n": first_n,
    "row_index": row_index,
    "author_by_name": author_by_name,
    "author_by_identity": author_by_identity,
    "country_last": country_last,
    "country_unmatchable": country_unmatchable,
    "country_word_list": country_word_list,
    "country_by_join": country_by_join,
    "institution_first": institution_first,
    "institution_all": institution_all,
    "fuzzy_best": fuzzy_best,
    "fuzzy_supplier_names": fuzzy_supplier_names,
    "fuzzy_first_ratio": fuzzy_first_ratio,
    "fuzzy_ratio_low": fuzzy_ratio_low,
    "fuzzy_long_names": fuzzy_long_names,
    "fuzzy_ratio_arrays": fuzzy_ratio_arrays,
    "partial_last": partial_last,
    "resolve_grid": _resolve,
    "resolve_grid_noalias": partial(_resolve, use_aliases=False),
    "resolve_grid_overwrite": partial(_resolve, preserve_existing=False),
    "dictionary_scan": dictionary_scan,
    "alias_scan": alias_scan,
    "latest_snapshot": latest_snapshot,
    "pipeline_local": _run,
    "pipeline_event": partial(_run, options=pipeline.EVENT_DRIVEN),
    "pipeline_staged": pipeline_staged,
    "csv_round_trip": csv_round_trip,
    "incremental_ingest": incremental_ingest,
    "latest_run": latest_run,
}
