"""Dictionary scans and resolution rules."""

import pytest
from pyspark.sql import functions as F

from citeloom.operators import resolve
from citeloom.operators.similarity import best_match_table
from citeloom.operators.sizing import BroadcastLimit, left_lookup
from citeloom.sources.dictionaries import read_aliases, read_institutes, read_word_list

NO_BROADCAST = BroadcastLimit(rows=-1, text_bytes=-1)
INSTITUTES = (
    'grid_id,name,city\ngrid.1,Harbor University,x\ngrid.2,"Saint ""A"" Hospital, Main",y\n'
    'grid.3,Harbor University,z\ngrid.4,O\'Neil Centre,z\n'
)
ALIASES = "alias,grid_id\nHarbor Uni,grid.8\nHarbor University,grid.9\nHarbor Uni,grid.7\n"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("dictionaries")
    (folder / "institutes.csv").write_text(INSTITUTES)
    (folder / "aliases.csv").write_text(ALIASES)
    return (
        read_institutes(spark, str(folder / "institutes.csv")),
        read_aliases(spark, str(folder / "aliases.csv")),
    )


def test_scan_keeps_file_order(tables):
    institutes, aliases = tables
    names = [r.name for r in institutes.orderBy("ordinal").collect()]
    assert names == ["Harbor University", 'Saint "A" Hospital, Main', "Harbor University", "O'Neil Centre"]
    assert {r.name: r.grid_id for r in resolve.first_id(institutes, "name").collect()} == {
        "Harbor University": "grid.1",
        'Saint "A" Hospital, Main': "grid.2",
        "O'Neil Centre": "grid.4",
    }
    assert {r.alias: r.grid_id for r in resolve.first_id(aliases, "alias").collect()} == {
        "Harbor Uni": "grid.8",
        "Harbor University": "grid.9",
    }


def test_word_list_is_not_trimmed(spark, tmp_path):
    (tmp_path / "words.txt").write_text("Peru\n Japan\nCosta Rica")
    assert sorted(r.name for r in read_word_list(spark, str(tmp_path / "words.txt")).collect()) == [
        " Japan", "Costa Rica", "Peru",
    ]


ROWS = [
    # id, identity, institutions, grid_institutions
    (1, "grid.0", "Harbor Uni", "Harbor University"),
    (2, None, "Harbor Uni", "Harbor University"),
    (3, None, "Harbor Uni", None),
    (4, None, "O'Neil Centre", "O'Neil Centre"),
    (5, None, "nothing", None),
    (6, None, None, None),
]


@pytest.mark.parametrize("limit", [BroadcastLimit(), NO_BROADCAST])
def test_rules(spark, tables, limit):
    institutes, aliases = tables
    df = spark.createDataFrame(
        ROWS, "id int, identity string, institutions string, grid_institutions string"
    )

    def ids(aliases=aliases, **options):
        out = resolve.resolve_identity(df, institutes, aliases, limit=limit, **options)
        assert out.columns == df.columns
        return [r.identity for r in out.orderBy("id").collect()]

    assert ids() == ["grid.0", "grid.1", "grid.8", "grid.4", None, None]
    assert ids(preserve_existing=False) == [None, "grid.1", "grid.8", "grid.4", None, None]
    assert ids(None) == ["grid.0", "grid.1", None, "grid.4", None, None]


@pytest.mark.parametrize("limit", [BroadcastLimit(), NO_BROADCAST])
def test_link_equals_match_then_resolve(spark, tables, limit):
    institutes, aliases = tables
    df = spark.createDataFrame(
        [(1, None, "Harbor Univwrsity"), (2, None, "Harbor Uni"), (3, "grid.0", "Harbor University"),
         (4, None, None), (5, None, "zzz")],
        "id int, identity string, institutions string",
    )
    out = resolve.link_institutions(df, institutes, aliases, best_match_table, limit=limit)
    got = {r.id: (r.grid_institutions, r.identity) for r in out.collect()}
    assert got == {
        1: ("Harbor University", "grid.1"),
        2: (None, "grid.8"),
        3: ("Harbor University", "grid.0"),
        4: (None, None),
        5: (None, None),
    }


def test_null_keys_are_spread(spark):
    df = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, "a").alias("k")
    )
    table = spark.createDataFrame([("a", 1)], "key string, value int")
    out = left_lookup(df, "k", table, "key", NO_BROADCAST)
    assert out.columns == ["id", "k", "value"]
    assert out.count() == 2000 and out.where("value = 1").count() == 667


def test_broadcast_only_within_limit(spark):
    df = spark.createDataFrame([("a",)], "k string")
    table = spark.createDataFrame([("a", 1), ("b", 2)], "key string, value int")

    def hinted(limit):
        out = left_lookup(df, "k", table, "key", limit)
        return "broadcast" in out._jdf.queryExecution().logical().toString()

    assert hinted(BroadcastLimit(rows=2))
    assert not hinted(BroadcastLimit(rows=1))
    assert not hinted(BroadcastLimit(text_bytes=10))
