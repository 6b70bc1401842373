"""What is written and shuffled on the way grows no faster than the input, and no step repeats another's work."""

import datetime as dt
import glob
import gzip
import os
import re

import pyarrow.parquet as pq

from obligato.operators import bitmaps, intervals
from obligato.operators.checks import unmatched
from obligato.plans import audit, ingest, marts, publish
from obligato.sources.files import writer
from obligato.sources.raw_store import DayStore
from obligato.sources.versioned import Versions
from testbed import adapter, queries
from tests.handmade import action, award, detail, frames

DAY = dt.date(2023, 1, 2)


def test_lines_are_landed_compressed_in_files_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(queries, "LANDED_LINES", 40)
    path = queries._land(spark, spark.range(100).repartition(1).selectExpr("CONCAT('{\"id\": ', id, '}') AS value"))
    files = [gzip.open(f, "rt").read().splitlines() for f in glob.glob(f"{path.removeprefix('file:')}/part-*.gz")]
    assert sorted(map(len, files)) == [20, 40, 40]
    assert {r["id"] for r in spark.read.schema("id long").json(path).collect()} == set(range(100))


def test_a_group_takes_no_more_bits_than_its_values_need(spark):
    # One value a group, in codes far apart, as a dictionary given task by task has them.
    rows = spark.range(500).selectExpr("id AS g", "CAST(id AS STRING) AS v")
    codes = rows.selectExpr("v", "g * 8589934592 + 64 AS code")
    sets = bitmaps.bitmaps(rows, ["g"], "v", codes)
    assert dict(sets.dtypes)["_bits"] == "bigint" and sets.count() == 500
    assert {r["n"] for r in bitmaps.counted(sets, ["g"], "n").collect()} == {1}
    assert bitmaps.counted(sets, [], "n").first()["n"] == 500


def test_buyers_meet_orders_before_lines(spark, tmp_path):
    for name, schema in adapter.SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    plan = adapter.raw_transactions(spark, str(tmp_path))._jdf.queryExecution().analyzed().toString()
    joins = re.findall(r"Join LeftOuter, \((\w+)#\d+L? = \w+", plan)
    assert joins.index("o_orderkey") < joins.index("c_custkey")  # the outermost join comes first


def test_copies_are_looked_for_only_where_a_key_repeats(spark, tmp_path, monkeypatch):
    awards = [award(f"A{i}") for i in range(60)]
    actions = [action(f"A{i}", "0", "2023-01-01", 1.0) for i in range(60)]
    looked, find = [], ingest.duplicates.repeated_digests
    monkeypatch.setattr(ingest.duplicates, "repeated_digests", lambda marked: looked.append(marked.columns) or find(marked))
    for more, found in (([], 0), (actions[:5], 1)):
        store = DayStore(spark, str(tmp_path / f"raw{found}"))
        pull = frames(spark, awards, actions + more, details=[detail(f"A{i}", "2027-01-01", "2027-06-01") for i in range(60)])
        ingest.load_day(store, DAY, *pull, min_rows=1)
        assert len(looked) == found and store.read("raw_transactions").count() == 60


def test_a_pull_that_is_loaded_often_is_built_once(spark, monkeypatch):
    plans = []
    pull = spark.range(5).selectExpr("CONCAT('ORD_', id) AS award_key", "CAST(id AS DOUBLE) AS award_amount")
    monkeypatch.setattr(queries, "_clean_pull", lambda *_: (pull, pull, pull))
    monkeypatch.setattr(queries.ingest, "load_day", lambda store, day, *rows: plans.extend(
        r._jdf.queryExecution().optimizedPlan().toString() for r in rows))
    queries.load_all_or_nothing(spark, "")
    assert len(plans) == 12 and not any("Range (" in plan for plan in plans)


def test_stored_tables_are_written_in_the_tighter_codec(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "raw"))
    store.replace_day("raw_awards", DAY, frames(spark, awards=[award("A1")])[0])
    draft = Versions(spark, str(tmp_path / "versions")).begin()
    draft.keep("plain", spark.range(10))
    draft.keep_by_key("bucketed", spark.range(10).selectExpr("id AS award_key"), "award_key")
    queries.stored(spark, spark.range(10), "zstd-stored")
    for root in (f"{tmp_path}/raw", f"{tmp_path}/versions", spark.conf.get("spark.checkpoint.dir") + "/zstd-stored-*"):
        files = glob.glob(f"{root}/**/part-*.parquet", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_a_day_is_merged_into_the_intervals_by_one_shuffle(spark):
    none = spark.createDataFrame([], "k string, v double, valid_from date, valid_to date")
    rows = spark.createDataFrame([("A", 1.0), ("A", 1.0), ("B", -0.0)], "k string, v double")
    merged = intervals.with_day(none, rows, [], DAY)
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(repr, merged.collect())) == [repr(r) for r in spark.createDataFrame(
        [("A", 1.0, DAY, None), ("B", 0.0, DAY, None)], none.schema).collect()]


def test_lines_are_put_together_by_order_and_need_no_shuffle_by_award(spark, tmp_path):
    for name, schema in adapter.SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for with_award in (False, True):
        lines = queries._clean_pull(spark, str(tmp_path), adapter.AS_OF, with_award)[1]
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(l_orderkey" in plan and "Exchange hashpartitioning(award_key" not in plan


def test_a_draft_without_copies_becomes_the_day(spark, tmp_path, monkeypatch):
    awards = [award(f"A{i}") for i in range(60)]
    actions = [action(f"A{i}", "0", "2023-01-01", 1.0) for i in range(60)]
    store, written = DayStore(spark, str(tmp_path / "raw")), []
    replace = store.replace_day
    monkeypatch.setattr(store, "replace_day", lambda table, *rest: written.append(table) or replace(table, *rest))
    for more, tables in ((actions[:5], ["raw_transactions"]), ([], [])):
        written.clear()
        pull = frames(spark, awards, actions + more, details=[detail(f"A{i}", "2027-01-01", "2027-06-01") for i in range(60)])
        ingest.load_day(store, DAY, *pull, min_rows=1)
        assert written == tables
        assert [store.read(table).count() for table in store.schemas] == [60, 60, 60]
        assert sorted(os.listdir(store.root)) == sorted(store.schemas)


def test_ids_are_written_without_dictionaries(spark, tmp_path):
    rows = spark.range(1000, numPartitions=1).selectExpr("concat('AWARD', id % 100) AS award_key", "concat('N', id % 5) AS naics_code")
    writer(rows).save(str(tmp_path / "plain"))
    Versions(spark, str(tmp_path / "versions")).begin().keep_by_key("bucketed", rows, "award_key")
    for file in glob.glob(f"{tmp_path}/**/part-*.parquet", recursive=True):
        group = pq.ParquetFile(file).metadata.row_group(0)
        dictionary = {group.column(i).path_in_schema: group.column(i).has_dictionary_page for i in range(2)}
        assert dictionary == {"award_key": False, "naics_code": True}
    assert spark.read.parquet(str(tmp_path / "plain")).exceptAll(rows).isEmpty()


def test_buckets_are_not_sorted_beyond_need(spark, tmp_path):
    draft = Versions(spark, str(tmp_path)).begin()
    rows = spark.range(1000).selectExpr("CAST(id % 300 AS STRING) AS award_key", "id AS n")
    draft.keep_spread("t", rows, "award_key")
    part = draft.tables["t"]["parts"][0]
    for _ in range(2):
        told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED `{draft.versions.declared(part)}`").collect()}
        assert told.get("Sort Columns", "[]") == "[]" and told["Num Buckets"] == str(part["buckets"])
        assert draft.versions.read_part(part).exceptAll(rows).isEmpty()
        spark.sql(f"DROP TABLE `{draft.versions.declared(part)}`")


def test_the_audit_reads_the_actions_once(spark, tmp_path):
    days = [("A1", "0"), ("A1", "0"), ("A1", "1"), ("A2", "0"), ("LOST", "0"), ("LOST", "0"), (None, "0"), (None, None), (None, None)]
    spark.createDataFrame(days, "award_key string, modification_number string").write.parquet(str(tmp_path / "actions"))
    staged = spark.createDataFrame([("A1",), ("A1",), ("A2",), ("A3",), (None,)], "award_key string")
    fact = publish.build(*frames(spark))["fact_awards"]
    results = audit.audit_results(fact, spark.read.parquet(str(tmp_path / "actions")), marts.recompetes(fact), staged, (0, 1))
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<award_key:string,modification_number:string>") == 1
    found = {r["check"]: r["failing_rows"] for r in results.collect()}
    assert found["unique_obligation_key"] == 3 and found["obligations_belong_to_awards"] == 5


def test_rows_of_unknown_keys_are_found_by_one_shuffle(spark):
    rows = spark.createDataFrame([("A",), ("A",), ("B",), ("B",), ("C",), (None,), (None,)], "k string")
    known = spark.createDataFrame([("A",), ("A",), ("D",), (None,)], "k string")
    found = unmatched(rows, known, "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert {tuple(r) for r in found.collect()} == {("B", 2), ("C", 1), (None, 2)}
