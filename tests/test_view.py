import datetime as dt
import pathlib
import re

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from citeloom.operators.row_index import with_row_index
from citeloom.sources.drops import latest_path
from citeloom.sources.records import first_records, record_at, scan_records, with_ordinal
from citeloom.sources.staged import write_stage
from workload import view

DAY = dt.datetime(1996, 2, 3)


@pytest.fixture
def tables(spark, tmp_path):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    put("supplier", [(s, f"Supplier{s}", s % 3) for s in range(4)], "s_suppkey long, s_name string, s_nationkey int")
    put("customer", [(c, f"Customer{c}") for c in range(5)], "c_custkey long, c_name string")
    put(
        "part",
        [(p, f"p{p} < & q", "Brand", "TYPE", p) for p in range(10)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
    )
    put(
        "orders",
        [(o, o % 5, DAY if o % 2 else dt.datetime(1994, 1, 1), "1-URGENT") for o in range(100)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
    )
    put(
        "lineitem",
        [(o, n, (o + n) % 10, (o + n) % 4, "R", DAY) for o in range(100) for n in range(1, 6)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_shipdate timestamp",
    )
    return str(tmp_path)


def _size(folder):
    return sum(f.stat().st_size for f in pathlib.Path(folder).rglob("part-*"))


def _texts(df):
    return sorted(r["record"] for r in df.select("record").collect())


def test_record_files_are_packed_and_hold_every_record(spark, tables, tmp_path):
    wanted = _texts(view.records(spark, tables))
    assert len(wanted) == 500
    size = sum(map(len, wanted))
    for write in (view.record_files, view.record_files_by_nation):
        path = write(spark, tables, str(tmp_path / write.__name__))
        assert _texts(scan_records(spark, path)) == wanted
        assert _size(path) < size / 3


def test_positions_of_packed_files_follow_the_number(spark, tables, tmp_path):
    path = view.record_files_by_nation(spark, tables, str(tmp_path / "nations"))
    last = record_at(spark, path, -1).collect()
    assert len(last) == 3
    by_nation = view.base(spark, tables).groupBy("s_nationkey").agg({"pmid": "max"}).collect()
    assert sorted(r["record"].split("<PMID Version=\"1\">")[1].split("<")[0] for r in last) == sorted(
        r["max(pmid)"] for r in by_nation
    )


def test_the_newest_drop_is_found_among_packed_files(spark, tables, tmp_path):
    late = view.late_file(spark, tables, str(tmp_path / "drops/late"))
    assert latest_path(spark, str(tmp_path / "drops"), view.RECORD_FILES).endswith(".txt")
    view.record_files(spark, tables, str(tmp_path / "drops/early"))
    assert latest_path(spark, str(tmp_path / "drops"), view.RECORD_FILES).endswith(".txt.gz")
    assert len(_texts(scan_records(spark, late))) == 250


def test_nation_files_shuffle_keys_and_render_behind_that(spark, tables, tmp_path, monkeypatch):
    plans, text = [], DataFrameWriter.text

    def noted(self, path, **options):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return text(self, path, **options)

    monkeypatch.setattr(DataFrameWriter, "text", noted)
    view.record_files_by_nation(spark, tables, str(tmp_path / "keys"))
    (plan,) = plans
    # Parents are printed first.
    assert plan.index("</PubmedArticle>") < plan.index("RepartitionByExpression")


def test_positions_are_numbered_without_the_text(spark, tables, tmp_path):
    path = view.record_files_by_nation(spark, tables, str(tmp_path / "narrow"))
    found = first_records(spark, path, 2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window [") :].split("Project [", 1)[1].split("\n")[0]
    assert "value#" not in below
    assert found.count() == 6 and {r["ordinal"] for r in found.collect()} == {0, 1}


def test_stages_are_packed_and_places_of_parts_are_broadcast(spark, tables, tmp_path):
    path = view.record_files(spark, tables, str(tmp_path / "records"))
    write_stage(spark.range(5).toDF("n"), str(tmp_path / "stage"))
    assert list((tmp_path / "stage").glob("*.zstd.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (with_ordinal(scan_records(spark, path)), with_row_index(spark.range(50).toDF("n"), "n")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
            assert df.count() in (50, 500)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["country_by_join", "country_word_list"])
def test_texts_and_rows_are_read_from_the_same_shuffles(spark, tables, name):
    from workload.queries import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tagged = QUERIES[name](spark, tables)
        rows = tagged.collect()
        plan = tagged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == 900 and {r["country"] for r in rows} > {"Guinea", None}
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    scans = [line for line in final.splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert not any(c in line for line in scans for c in ("l_shipdate", "p_brand", "p_type", "o_orderpriority"))


def test_lines_are_shuffled_for_their_orders_and_parts_only(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As where the suppliers' files are above the threshold.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = view.records(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"Exchange hashpartitioning\((l_\w+)#", plan)
    assert sorted(keys) == ["l_orderkey", "l_partkey"]


def test_records_of_a_supplier_are_neighbours_in_a_file(spark, tables, tmp_path):
    path = view.record_files(spark, tables, str(tmp_path / "files"))
    suppliers = r"ror\.(\d+)"
    for files in spark.read.text(path, wholetext=True).collect():
        found = [int(s) for s in re.findall(suppliers, files["value"])]
        assert found == sorted(found)
