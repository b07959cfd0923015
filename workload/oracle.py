"""The same queries as SQL for the checking database.

Written against the columns of the article view, without the library: all
pairs are compared, countries are found by position, nothing is parsed.
"""

from __future__ import annotations

from citeloom.functions.fixed import EMAIL_PATTERN, WORLD_COUNTRIES, ZIPCODE_PATTERN
from workload.view import BASE_SQL, DICTIONARY_SQL, FLAT_SQL, LATE_YEAR, _TITLE_SHOWN

_FULL_NAME = "forename || ' ' || lastname AS full_name"
_EMAIL = f"nullif(regexp_extract(affiliation, '{EMAIL_PATTERN}'), '') AS author_email"
_ZIPCODE = f"nullif(regexp_extract(affiliation, '(?i){ZIPCODE_PATTERN}'), '') AS zipcode"
_KEYWORDS = ("university", "center", "centre", "laboratory", "hospital")
_WORD = "[A-Za-z0-9_-]"


def _country_sql(unmatchable: bool = False) -> str:
    names = [c for c in WORLD_COUNTRIES if unmatchable or c == c.title()]
    values = ", ".join("('" + c.replace("'", "''") + "')" for c in names)
    return f"""
countries(name) AS (VALUES {values}),
lengths AS (SELECT DISTINCT length(name) AS len FROM countries),
texts AS (SELECT DISTINCT affiliation FROM flat),
starts AS (SELECT affiliation, unnest(range(1, length(affiliation) + 1)) AS start FROM texts),
word_starts AS (SELECT * FROM starts
  WHERE start = 1 OR NOT regexp_matches(substr(affiliation, start - 1, 1), '{_WORD}')),
spans AS (SELECT affiliation, start, len, substr(affiliation, start, len) AS span
  FROM word_starts, lengths
  WHERE start + len - 1 <= length(affiliation)
    AND NOT regexp_matches(substr(affiliation, start + len, 1), '{_WORD}')),
tagged AS (SELECT affiliation, arg_max(span, (start + len, len)) AS country
  FROM spans JOIN countries ON lower(span) = lower(name) GROUP BY affiliation)"""


_SEGMENTS = (
    "list_filter(list_transform(string_split_regex(affiliation, '[,;]'), lambda x: trim(x)), "
    "lambda x: " + " OR ".join(f"contains(lower(x), '{k}')" for k in _KEYWORDS) + ")"
)
_MENTIONS_SQL = f"""
segmented AS (SELECT *, {_SEGMENTS} AS segs FROM flat),
mentioned AS (SELECT *, segs[1] AS institutions FROM segmented),
mentions AS (SELECT DISTINCT institutions AS mention FROM mentioned WHERE institutions IS NOT NULL),
all_mentions AS (SELECT DISTINCT unnest(segs) AS mention FROM segmented)"""

_BEST_SQL = """
scored AS (SELECT mention, name, ordinal, levenshtein(mention, name) AS dist,
    greatest(length(mention), length(name)) AS longer FROM mentions, institutes),
best AS (SELECT mention, arg_min(name, (dist / longer, ordinal)) AS match
  FROM scored WHERE 10 * dist <= longer GROUP BY mention)"""

# Longest common subsequence, one row of the table at a time.
_LCS = """
list_reduce(
  list_transform(string_split({b}, ''), lambda ch: [cast(ord(ch) AS bigint)]),
  lambda prev, ch: list_reduce(
    list_transform(range(1, length({a}) + 1), lambda i: [i]),
    lambda cur, i: list_append(cur,
      CASE WHEN ord(substr({a}, i[1], 1)) = ch[1] THEN prev[i[1]] + 1
      ELSE greatest(prev[i[1] + 1], cur[i[1]]) END),
    [cast(0 AS bigint)]),
  list_transform(range(0, length({a}) + 1), lambda i: cast(0 AS bigint)))[-1]"""


def _ratio_sql(source: str, tenths: int = 1) -> str:
    lcs = _LCS.format(a="mention", b="name")
    return f"""
near AS (SELECT mention, name, ordinal FROM {source}, institutes
  WHERE levenshtein(mention, name) <= {tenths} * (length(mention) + length(name)) // 10),
rated AS (SELECT mention, name, ordinal, {lcs} AS common FROM near),
first_ratio AS (SELECT mention, arg_min(name, ordinal) AS match FROM rated
  WHERE 10 * (length(mention) + length(name) - 2 * common) <= {tenths} * (length(mention) + length(name))
  GROUP BY mention)"""


def _partial_sql(source: str) -> str:
    lcs = _LCS.format(a="needle", b="part")
    return f"""
sides AS (
  SELECT mention, name, ordinal, name AS needle, mention AS hay FROM {source}, institutes
  WHERE length(name) <= length(mention)
  UNION ALL
  SELECT mention, name, ordinal, mention, name FROM {source}, institutes
  WHERE length(mention) <= length(name)),
cuts AS (
  SELECT *, unnest(range(2 - length(needle), length(hay) + 1)) AS start FROM sides),
parts AS (
  SELECT mention, name, ordinal, needle, CASE WHEN start >= 1 THEN substr(hay, start, length(needle))
    ELSE substr(hay, 1, start + length(needle) - 1) END AS part
  FROM cuts WHERE length(needle) - least(length(hay) - greatest(start, 1) + 1, length(needle) + least(start, 1) - 1)
    <= length(needle) // 5),
close AS (
  SELECT DISTINCT needle, part FROM parts
  WHERE levenshtein(needle, part) <= (length(needle) + length(part)) // 10),
rated AS (SELECT needle, part, length(needle) + length(part) AS total, {lcs} AS common FROM close),
partial AS (
  SELECT mention, arg_min(name, ((total - 2 * common) / total, ordinal)) AS match
  FROM parts JOIN rated USING (needle, part)
  WHERE 10 * (total - 2 * common) <= total GROUP BY mention)"""


_IDS_SQL = """
by_name AS (SELECT name, arg_min(grid_id, ordinal) AS name_id FROM institutes GROUP BY name),
by_alias AS (SELECT alias, arg_min(grid_id, ordinal) AS alias_id FROM aliases GROUP BY alias)"""


def _flat(select: str, *more: str, tail: str = "FROM flat") -> str:
    return "WITH " + ",".join((FLAT_SQL, *more)) + f" SELECT {select} {tail}"


def _article(select: str, tail: str = "FROM article") -> str:
    return f"WITH {FLAT_SQL} SELECT {select} {tail}"


# Articles with their place in the file of their supplier's nation.
_NUMBERED = (
    "FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY pmid) - 1 AS ordinal, "
    "count(*) OVER (PARTITION BY s_nationkey) AS size FROM article)"
)
_KEY = "pmid, lastname, affiliation"
_COUNTRY_TAIL = "FROM flat LEFT JOIN tagged USING (affiliation)"
_RESOLVE_TAIL = (
    "FROM mentioned LEFT JOIN by_name ON institutions = name LEFT JOIN by_alias ON institutions = alias"
)


def _resolve(identity: str) -> str:
    return _flat(
        f"{_KEY}, {identity} AS identity", DICTIONARY_SQL, _MENTIONS_SQL, _IDS_SQL, tail=_RESOLVE_TAIL
    )


def _run(identity: str) -> str:
    return _flat(
        f"title, pmid, year, keywords, mesh, forename, lastname, {_FULL_NAME}, initials, "
        f"{identity} AS identity, affiliation, {_EMAIL}, {_ZIPCODE}, country, institutions, "
        "match AS grid_institutions",
        DICTIONARY_SQL, _country_sql(), _MENTIONS_SQL, _BEST_SQL, _IDS_SQL,
        tail=(
            "FROM mentioned LEFT JOIN tagged USING (affiliation) "
            "LEFT JOIN best ON institutions = mention "
            "LEFT JOIN by_name ON match = by_name.name LEFT JOIN by_alias ON institutions = alias"
        ),
    )


_AUTHORS_SQL = f"""WITH {BASE_SQL}
SELECT pmid, 0::bigint AS author_pos, coalesce(forename, '') AS forename, s_name AS lastname,
  'F' AS initials, coalesce(identity, '') AS identity, aff1 AS affiliation_name,
  aff1 || CASE WHEN p % 5 = 0 THEN '|' || aff2 ELSE '' END AS affiliations FROM base
UNION ALL
SELECT pmid, 1::bigint, 'C' || cast(c AS string), c_name, '', '',
  CASE WHEN c % 4 = 0 THEN NULL ELSE aff3 END, CASE WHEN c % 4 = 0 THEN '' ELSE aff3 END FROM base"""

_FLAT_COLUMNS = (
    f"title, pmid, year, forename, lastname, {_FULL_NAME}, initials, identity, affiliation, keywords, mesh"
)

ORACLE_SQL = {
    "email_extract": (
        f"SELECT doc_id, nullif(regexp_extract(text, '{EMAIL_PATTERN}'), '') AS email FROM documents"
    ),
    "zipcode_extract": _flat(f"{_KEY}, {_ZIPCODE}"),
    "contact_columns": _flat(f"{_KEY}, {_EMAIL}, {_ZIPCODE}"),
    "xml_articles": _article(
        "pmid, title, year, keywords, mesh, 2::bigint AS num_authors, false AS is_malformed"
    ),
    "xml_file_scan": _article("pmid, title, published AS year, keywords, mesh"),
    "xml_mixed_year": _article(
        "pmid, coalesce(title, '') AS title, "
        "CASE WHEN revised IS NULL THEN '' ELSE published END AS year"
    ),
    "author_records": _AUTHORS_SQL,
    "record_ordinals": (
        "SELECT count(*) AS num_records, count(*) AS num_positions, 0::bigint AS gap FROM lineitem"
    ),
    "first_articles": _article("ordinal, pmid, title", f"{_NUMBERED} WHERE ordinal < 50"),
    "article_at": _article("pmid, 3 AS n", f"{_NUMBERED} WHERE ordinal = 3")
    + f" UNION ALL SELECT pmid, -2 AS n {_NUMBERED} WHERE ordinal = size - 2",
    "latest_drop_articles": _article("pmid, title", f"FROM article WHERE year(o_orderdate) = {LATE_YEAR}"),
    "article_count": "SELECT count(*) AS num_articles FROM lineitem",
    "flatten": _flat(_FLAT_COLUMNS),
    "flatten_with_affiliation_name": _flat(f"{_FLAT_COLUMNS}, affiliation_name"),
    "flatten_no_full_name": _flat(
        "title, pmid, published AS year, forename, lastname, initials, identity, affiliation, "
        "keywords, mesh"
    ),
    "first_n": _flat(f"{_KEY}, {_FULL_NAME}", tail=f"FROM flat ORDER BY {_KEY} LIMIT 50"),
    "row_index": _flat(f"{_KEY}, row_number() OVER (ORDER BY {_KEY}) - 1 AS row_index"),
    "author_by_name": (
        f"WITH {BASE_SQL} SELECT pmid, forename, s_name AS lastname, 'F' AS initials, "
        "aff1 AS affiliation_name FROM base WHERE forename = 'F8' AND s_name = 'Supplier#000000008'"
    ),
    "author_by_identity": (
        f"WITH {BASE_SQL} SELECT pmid, s_name AS lastname, identity FROM base WHERE identity = 'grid.9'"
    ),
    "country_last": _flat(f"{_KEY}, country", _country_sql(), tail=_COUNTRY_TAIL),
    "country_unmatchable": _flat(f"{_KEY}, country", _country_sql(True), tail=_COUNTRY_TAIL),
    "country_word_list": _flat(f"{_KEY}, country", _country_sql(), tail=_COUNTRY_TAIL),
    "country_by_join": _flat(f"{_KEY}, country", _country_sql(), tail=_COUNTRY_TAIL),
    "institution_first": _flat(f"{_KEY}, institutions", _MENTIONS_SQL, tail="FROM mentioned"),
    "institution_all": _flat(
        f"{_KEY}, CASE WHEN len(segs) > 0 THEN array_to_string(segs, '|') END AS institutions",
        _MENTIONS_SQL, tail="FROM mentioned",
    ),
    "fuzzy_best": _flat(
        f"{_KEY}, institutions, match AS grid_institutions", DICTIONARY_SQL, _MENTIONS_SQL, _BEST_SQL,
        tail="FROM mentioned LEFT JOIN best ON institutions = mention",
    ),
    "fuzzy_supplier_names": """
WITH spoiled AS (SELECT s_suppkey, substr(s_name, 1, 9 + s_suppkey % 9) || 'x' ||
    substr(s_name, 11 + s_suppkey % 9) AS mention FROM supplier),
scored AS (SELECT mention, s.s_name, s.s_suppkey, levenshtein(mention, s_name) AS dist,
    greatest(length(mention), length(s_name)) AS longer
  FROM (SELECT DISTINCT mention FROM spoiled), supplier s),
best AS (SELECT mention, arg_min(s_name, (dist / longer, s_suppkey)) AS match
  FROM scored WHERE 10 * dist <= longer GROUP BY mention)
SELECT s_suppkey, mention, match FROM spoiled LEFT JOIN best USING (mention)""",
    "fuzzy_first_ratio": _flat(
        f"{_KEY}, institutions, match AS grid_institutions",
        DICTIONARY_SQL, _MENTIONS_SQL, _ratio_sql("mentions"),
        tail="FROM mentioned LEFT JOIN first_ratio ON institutions = mention",
    ),
    "fuzzy_ratio_low": _flat(
        f"{_KEY}, institutions, match AS grid_institutions",
        DICTIONARY_SQL, _MENTIONS_SQL, _ratio_sql("mentions", 2),
        tail="FROM mentioned LEFT JOIN first_ratio ON institutions = mention",
    ),
    "fuzzy_ratio_arrays": _flat(
        f"{_KEY}, grid_institutions",
        DICTIONARY_SQL, _MENTIONS_SQL, _ratio_sql("all_mentions"),
        """lists AS (SELECT DISTINCT segs FROM segmented WHERE len(segs) > 0),
placed AS (SELECT segs, unnest(segs) AS mention, unnest(range(1, len(segs) + 1)) AS pos FROM lists),
gathered AS (SELECT segs, string_agg(coalesce(match, '~'), '|' ORDER BY pos) AS grid_institutions
  FROM placed LEFT JOIN first_ratio USING (mention) GROUP BY segs)""",
        tail="FROM segmented LEFT JOIN gathered USING (segs)",
    ),
    "partial_last": _flat(
        f"{_KEY}, grid_institution_names",
        DICTIONARY_SQL, _MENTIONS_SQL, _partial_sql("all_mentions"),
        """lists AS (SELECT DISTINCT segs FROM segmented WHERE len(segs) > 0),
placed AS (SELECT segs, unnest(segs) AS mention, unnest(range(1, len(segs) + 1)) AS pos FROM lists),
gathered AS (SELECT segs, arg_max(match, pos) AS grid_institution_names
  FROM placed JOIN partial USING (mention) GROUP BY segs)""",
        tail="FROM segmented LEFT JOIN gathered USING (segs)",
    ),
    "resolve_grid": _resolve("coalesce(identity, name_id, alias_id)"),
    "resolve_grid_noalias": _resolve("coalesce(identity, name_id)"),
    "resolve_grid_overwrite": _resolve(
        "CASE WHEN identity IS NULL THEN coalesce(name_id, alias_id) END"
    ),
    "dictionary_scan": (
        f"WITH {DICTIONARY_SQL} SELECT name, arg_min(grid_id, ordinal) AS grid_id "
        "FROM institutes GROUP BY name"
    ),
    "alias_scan": (
        f"WITH {DICTIONARY_SQL} SELECT alias, arg_min(grid_id, ordinal) AS grid_id "
        "FROM aliases GROUP BY alias"
    ),
    "latest_snapshot": (
        "SELECT event_type, arg_max(event_id, (ts, -event_id)) AS event_id, "
        "arg_max(value, (ts, -event_id)) AS value FROM events GROUP BY event_type"
    ),
    "pipeline_local": _run("coalesce(identity, name_id, alias_id)"),
    "pipeline_event": _run("coalesce(identity, name_id)"),
    "pipeline_staged": _flat(
        f"title, pmid, year, keywords, mesh, forename, lastname, {_FULL_NAME}, initials, identity, "
        f"affiliation_name, affiliation, {_EMAIL}, {_ZIPCODE}, country, "
        "CASE WHEN len(segs) > 0 THEN array_to_string(segs, '|') END AS institutions, "
        "grid_institutions, grid_institution_names",
        DICTIONARY_SQL, _country_sql(), _MENTIONS_SQL,
        _ratio_sql("all_mentions").replace("rated", "ratio_rated"), _partial_sql("all_mentions"),
        """lists AS (SELECT DISTINCT segs FROM segmented WHERE len(segs) > 0),
placed AS (SELECT segs, unnest(segs) AS mention, unnest(range(1, len(segs) + 1)) AS pos FROM lists),
gathered AS (SELECT segs, string_agg(coalesce(first_ratio.match, '~'), '|' ORDER BY pos) AS grid_institutions,
    arg_max(partial.match, pos) AS grid_institution_names
  FROM placed LEFT JOIN first_ratio USING (mention) LEFT JOIN partial USING (mention) GROUP BY segs)""",
        tail=(
            "FROM segmented LEFT JOIN tagged USING (affiliation) LEFT JOIN gathered USING (segs)"
        ),
    ),
    "csv_round_trip": _flat(_FLAT_COLUMNS),
    "latest_run": (
        f"SELECT r.*, row_number() OVER (ORDER BY {_KEY}) - 1 AS row_index, true AS is_stamped "
        f"FROM ({_run('coalesce(identity, name_id, alias_id)')}) r WHERE pmid IN ("
        + _article("pmid", f"FROM article WHERE year(o_orderdate) = {LATE_YEAR}")
        + ")"
    ),
    "incremental_ingest": _run("coalesce(identity, name_id, alias_id)"),
}
