"""Rank, text search and the plans they produce."""

import random
import re

import pytest
from pyspark.sql import functions as F

from obligato import fixed_values as fixed
from obligato.functions.text import matches, trimmed
from obligato.operators.ranking import nth_largest, with_rank_desc
from obligato.operators.snapshots import keep_latest, latest_snapshot
from obligato.plans import ingest, marts, staging, views
from obligato.sources.raw_store import DayStore
from obligato.sources.schemas import RAW_AWARDS, RAW_TRANSACTIONS
from tests.handmade import award, d


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", [
    [], [None], [1.0], [5.0] * 40, [0.0] * 300 + [float(i) for i in range(-50, 400)],
    [random.Random(3).choice([None, -1.5, 0.0, 7.25, random.Random(i).random()]) for i in range(500)],
])
def test_rank_matches_the_window_function(spark, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(5)
    got = {r["id"]: r["place"] for r in with_rank_desc(rows, "v", "place", buckets=7).collect()}
    order = [v for v in values]
    def rank(v):
        return 1 + sum(1 for x in order if x is not None and (v is None or x > v))
    assert got == {i: rank(v) for i, v in enumerate(values)}


def test_nth_largest_keeps_ties(spark):
    rows = spark.createDataFrame([(v,) for v in (9.0, 8.0, 8.0, 8.0, 1.0, None)], "v double")
    for n, kept in ((1, 1), (2, 4), (4, 4), (5, 5), (50, 5)):
        assert rows.where(F.col("v") >= nth_largest(rows, "v", n)).count() == kept


def test_rank_never_gathers_rows_in_one_task(spark):
    rows = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"))
    ranked = plan(with_rank_desc(rows, "v", "place"))
    # The only ordering without a partition key is over the bucket totals.
    for line in ranked.splitlines():
        if "Window [" in line and "_bucket" not in line:
            raise AssertionError(line)


def test_patterns_agree_with_python(spark):
    pieces = ["RECRUIT", "HEADHUNT", "HEAD HUNT", "HEAD  HUNT", "LICENSE", "LICENCE", "LICENZE", "AVUE", "XAVUE", "AVUE9",
              "IT SUPPORT", "AUDIT SUPPORT", "SYSTEMS SUPPORT", "SYSTEM SUPPORT", "PRISM", "PRISMS", "AV", "AVAV", "AUDIO-VISUAL",
              "AUDIOVISUAL", "AUDIO--VISUAL", "BPA CALL 12", "CALL#5", "CALL", " ", "\t", "\n", ".", "_", "-", "ADVERTISE"]
    dice = random.Random(5)
    texts = ["".join(dice.choices(pieces, k=dice.randint(1, 4))) for _ in range(1500)] + ["", "CALL 1", "BPA CALL # 12"]
    patterns = [fixed.RECRUITING_TERMS, fixed.MASKED_RECIPIENT, *[p for _, p, _ in fixed.DESCRIPTION_RULES]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", *[matches(F.col("t"), p).alias(f"p{i}") for i, p in enumerate(patterns)]).collect()
    for r in got:
        for i, p in enumerate(patterns):
            python = p.replace("$", r"\Z").replace(r"\s", r"[\t\n\f\r ]")
            assert r[f"p{i}"] == bool(re.search(python, r["t"], re.ASCII)), (r["t"], p)


@pytest.fixture
def eager_skew_handling(spark):
    """Thresholds scaled down to the size of test data, and no broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(rows):
    execution = rows._jdf.queryExecution()
    rows._jdf.queryExecution().executedPlan().execute().count()
    return execution.executedPlan().toString()


def hot_third(spark, path):
    """Actions of which a third belong to one award and a third to one sub-agency; several files."""
    i = F.col("id")
    rows = spark.range(0, 30000, 1, 12).select(
        F.lit(d("2023-05-15")).alias("snapshot_date"),
        F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("A"), (i % 500).cast("string"))).alias("award_key"),
        i.cast("string").alias("modification_number"), F.lit(d("2023-01-01")).alias("action_date"),
        F.lit(1.0).alias("obligation_amount"),
        F.when(i % 3 == 1, "HOT SUB").otherwise(F.concat(F.lit("S"), (i % 300).cast("string"))).alias("awarding_sub_agency"),
    )
    for f in RAW_TRANSACTIONS.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_hot_award_and_sub_agency_are_split(spark, tmp_path, eager_skew_handling):
    actions = staging.stg_transactions(hot_third(spark, str(tmp_path / "raw")))
    keys = spark.createDataFrame([("HOT",)] + [(f"A{n}",) for n in range(250)], "award_key string")
    keys.withColumn("in_niche", F.lit(True)).write.parquet(str(tmp_path / "niche"))
    labelled = marts.fct_obligations(actions, spark.read.parquet(str(tmp_path / "niche")))
    assert "skew=true" in final_plan(labelled)
    assert labelled.where("award_key = 'HOT' and in_niche").count() == 10000

    labelled.write.parquet(str(tmp_path / "actions"))
    agencies = spark.createDataFrame([("HOT SUB", "active"), ("S1", "new")], "awarding_sub_agency string, agency_status string")
    agencies.write.parquet(str(tmp_path / "agencies"))
    market = views.vw_dash_market(*[spark.read.parquet(str(tmp_path / t)) for t in ("actions", "agencies")])
    assert "skew=true" in final_plan(market)
    assert market.where("agency_status = 'active'").count() == labelled.where(
        "in_niche and awarding_sub_agency = 'HOT SUB'").count() > 0


def test_rank_of_a_value_that_most_rows_share_is_split(spark, tmp_path, eager_skew_handling):
    i = F.col("id")
    spark.range(0, 30000, 1, 12).select(i, F.when(i % 3 > 0, 0.0).otherwise(i.cast("double")).alias("v"),
                                        F.repeat(F.lit("x"), 50).alias("name")).write.parquet(str(tmp_path / "vendors"))
    ranked = with_rank_desc(spark.read.parquet(str(tmp_path / "vendors")), "v", "place")
    assert "skew=true" in final_plan(ranked)
    # Row 0 has no money either; the 9,999 other rows divisible by three stand before it.
    assert ranked.where("place = 10000").count() == 20001 and ranked.where("id = 29997").first()["place"] == 1


def test_hot_keys_are_counted_before_the_shuffle(spark, tmp_path):
    actions = hot_third(spark, str(tmp_path / "raw"))
    text = plan(ingest.gate_transactions(actions).unionByName(ingest.gate_orphans(actions, actions)))
    # Every shuffle by a data key sits above a partial aggregate.
    for exchange in re.finditer(r"Exchange hashpartitioning\(([^\n]*)\n([^\n]*)", text):
        assert "HashAggregate" in exchange[2], exchange[0]


def test_trim_keeps_inner_space_and_null(spark):
    rows = spark.createDataFrame([("　  A  B \t\r\n",), (None,), ("",)], "t string")
    assert [r[0] for r in rows.select(trimmed(F.col("t"))).collect()] == ["A  B", None, ""]


def test_latest_day_prunes_partitions(spark, tmp_path):
    store = DayStore(spark, str(tmp_path))
    store.replace_days("raw_awards", spark.createDataFrame(
        [award("A", snapshot_date=d(f"2026-09-{n:02}")) for n in range(1, 6)], RAW_AWARDS))
    newest = latest_snapshot(store.read("raw_awards"))
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date[^\]]*= Subquery", plan(newest))
    assert [r["as_of_date"] for r in newest.collect()] == [d("2026-09-05")]
    assert [r["as_of_date"] for r in latest_snapshot(store.read("raw_awards"), d("2026-09-03")).collect()] == [d("2026-09-03")]
    assert len(store.read_latest("raw_awards", d("2026-09-02")).inputFiles()) == 1


def test_keep_latest_limits_before_the_shuffle(spark):
    rows = spark.createDataFrame([award("A"), award("B")], RAW_AWARDS)
    text = plan(keep_latest(rows, ["award_key"], [F.col("last_modified_date").desc_nulls_last()]))
    before, after = text.split("Exchange hashpartitioning(award_key")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
