"""Copies by digest, distinct counts by bitmaps, and what landed records held that did not fit."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from obligato.operators import bitmaps, duplicates
from obligato.plans import ingest
from obligato.sources import landed
from obligato.sources.raw_store import DayStore
from tests.handmade import DAY, DETAILS, detail
from tests.test_load_and_publish import lines, pull

ROWS = [(1, "a", 1.0), (1, "a", 1.0), (1, "a", 2.0), (None, None, None), (None, None, None), (None, "", None), (2, None, 0.0), (2, None, -0.0)]


def counted(rows):
    return sorted(map(repr, map(tuple, rows.collect())))


@pytest.mark.parametrize("hashes", [None, lambda rows: [F.lit(1), F.lit(1)], lambda rows: [F.coalesce(F.col("k") % 2, F.lit(5)), F.lit(0)]])
def test_copies_are_dropped_whatever_their_digests_say(spark, hashes):
    dice = random.Random(1)
    rows = ROWS + [(dice.randrange(40), dice.choice("ab"), 0.5) for _ in range(300)] + [(7, "hot", 1.0)] * 500
    frame = spark.createDataFrame(rows, "k long, s string, x double").repartition(5)
    once = duplicates.distinct_rows(frame, hashes) if hashes else duplicates.distinct_rows(frame)
    assert counted(once) == counted(frame.dropDuplicates())
    assert duplicates.distinct_rows(frame.limit(0)).count() == 0


def test_only_digests_and_suspects_are_shuffled(spark, tmp_path):
    rows = spark.range(50_000).selectExpr("id", *[f"REPEAT(CAST(id AS STRING), {n}) AS wide{n}" for n in range(9, 20)])
    duplicates.with_digest(rows.unionByName(rows.where("id % 1000 = 0"))).write.parquet(str(tmp_path / "marked"))
    marked = spark.read.parquet(str(tmp_path / "marked"))
    duplicates.repeated_digests(marked).write.parquet(str(tmp_path / "repeated"))
    repeated = spark.read.parquet(str(tmp_path / "repeated"))
    assert repeated.count() == 50
    narrow = duplicates.repeated_digests(marked)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<_row_digest_a:bigint,_row_digest_b:bigint>", narrow)
    once = duplicates.without_copies(marked, repeated)
    assert once.count() == 50_000
    # Rows of their own pass through a broadcast; the one shuffle of whole rows is that of the suspects.
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1 and plan.count("BroadcastHashJoin") == 2


def test_merged_bitmaps_count_as_distinct_does(spark):
    dice = random.Random(2)
    rows = [(dice.choice("AB"), dice.choice(["x", "y", None]), 2000 + dice.randrange(5), dice.choice([None, *map(str, range(60))])) for _ in range(900)]
    frame = spark.createDataFrame(rows, "d string, s string, y int, v string").repartition(4).cache()
    codes = spark.createDataFrame(bitmaps.extended(None, frame.where("y < 2003"), "v").collect(), "v string, code long")
    more = spark.createDataFrame(bitmaps.extended(codes, frame, "v").collect(), "v string, code long")
    assert more.count() == more.select("code").distinct().count() == 60 and codes.exceptAll(more).isEmpty()
    # Bitmaps made with the earlier dictionary are merged with later ones.
    old = bitmaps.bitmaps(frame.where("y < 2003"), ["d", "s", "y"], "v", codes)
    sets = old.unionByName(bitmaps.bitmaps(frame.where("y >= 2003"), ["d", "s", "y"], "v", more)).cache()
    for by in ([], ["d"], ["s", "y"], ["d", "s", "y"]):
        plain = frame.where("v IS NOT NULL").groupBy(*by).agg(F.countDistinct("v").alias("n"))
        assert counted(bitmaps.counted(sets, by, "n")) == counted(plain)
    over = {(d, y, len({v for dd, _, yy, v in rows if dd == d and y - 2 < yy <= y and v is not None}))
            for d, _, y, v in rows if v is not None}
    years = bitmaps.trailing(bitmaps.merged(sets, ["d", "y"]), ["d"], "y", 2, "n")
    assert {tuple(r) for r in years.select("d", "y", "n").collect()} == over
    assert bitmaps.counted(sets.limit(0), [], "n").first()["n"] == 0


def test_codes_pass_bucket_ends(spark):
    many = spark.range(100_000).selectExpr("CAST(id AS STRING) AS v", "id % 3 AS g").cache()
    codes = spark.createDataFrame(bitmaps.extended(None, many, "v").toPandas())
    sets = bitmaps.bitmaps(many, ["g"], "v", codes).cache()
    assert sets.select("_bucket").distinct().count() >= 4
    assert {tuple(r) for r in bitmaps.counted(sets, ["g"], "n").collect()} == {(0, 33_334), (1, 33_333), (2, 33_333)}
    assert bitmaps.counted(sets, [], "n").first()["n"] == 100_000


LANDED = [
    {"generated_internal_id": "GOOD", "Award Amount": "5.5", "Start Date": "2023-01-01"},
    {"generated_internal_id": "BAD", "Award Amount": "about 5", "Start Date": "spring", "End Date": " ", "Total Outlays": "NaN"},
    {"generated_internal_id": "HALF", "Award Amount": 1, "Start Date": "2023-02-30", "PSC": {"code": "R4"}},
]


def test_what_does_not_fit_is_counted_and_kept(spark, tmp_path):
    path = lines(tmp_path / "awards.json", LANDED)
    with open(path, "a") as file:
        file.write('\n{"generated_internal_id": "TORN", "Award Am\n')
    parsed = landed.parse_awards(spark, path).cache()
    rescued = {r.award_key: r.rescued for r in parsed.collect()}
    assert rescued == {"GOOD": None, "BAD": {"award_amount": "about 5", "start_date": "spring", "total_outlays": "NaN"},
                       "HALF": {"start_date": "2023-02-30"}, None: None}
    counts = {r.field: (r.coerced, r.filled) for r in landed.coercions(parsed, "raw_awards").collect()}
    assert counts["award_amount"] == (1, 3) and counts["start_date"] == (2, 3) and counts["end_date"] == (0, 0)
    kept = {tuple(r) for r in landed.quarantined(parsed, "raw_awards").collect()}
    assert kept == {("raw_awards", "BAD", "award_amount", "about 5"), ("raw_awards", "BAD", "start_date", "spring"),
                    ("raw_awards", "BAD", "total_outlays", "NaN"), ("raw_awards", "HALF", "start_date", "2023-02-30"),
                    ("raw_awards", None, None, '{"generated_internal_id": "TORN", "Award Am')}
    plain = landed.read_awards(spark, path)
    assert counted(parsed.drop("rescued", "broken_line")) == counted(plain)

    def failing(share):
        return {r.check: r.failing_rows for r in ingest.gate_landed(parsed, "raw_awards", share).where("failing_rows > 0").collect()}

    assert failing(None) == {"raw_awards_broken_lines": 1}
    assert failing(0.5) == {"raw_awards_broken_lines": 1, "raw_awards_start_date_coerced": 2, "raw_awards_total_outlays_coerced": 1}


def test_a_load_refuses_too_many_bad_texts_and_keeps_them(spark, tmp_path):
    store, kept = DayStore(spark, str(tmp_path / "raw")), ingest.quarantine_store(spark, str(tmp_path / "quarantine"))
    running = DETAILS + [detail(f"Q{n}", "2024-02-29", "2024-02-29") for n in range(1, 9)]
    awards, actions, details = pull(spark, details=running)
    bad = F.when(F.col("award_key") == "H1", F.create_map(F.lit("start_date"), F.lit("spring")))
    spoiled = landed.as_parsed(awards).withColumn("rescued", bad)
    with pytest.raises(ingest.ValidationError, match="raw_awards_start_date_coerced: 1"):
        ingest.load_day(store, DAY, spoiled, actions, details, min_rows=1, max_coerced=0.01, quarantine=kept)
    assert store.days("raw_awards") == []
    found = [("H1", "start_date", "spring")]
    assert [tuple(r) for r in kept.read("quarantine").select("award_key", "field", "value").collect()] == found

    torn = landed.as_parsed(actions).unionByName(
        landed.as_parsed(actions.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in actions.schema.fields]))
        .withColumn("broken_line", F.lit('{"x')))
    with pytest.raises(ingest.ValidationError, match="raw_transactions_broken_lines: 1"):
        ingest.load_day(store, DAY, awards, torn, details, min_rows=1, quarantine=kept)
    assert [r.value for r in kept.read("quarantine").collect()] == ['{"x']

    ingest.load_day(store, DAY, spoiled, actions, details, min_rows=1, max_coerced=0.5, quarantine=kept)
    assert store.read("raw_awards").count() == 17 and kept.read("quarantine").count() == 1


def test_landed_fields_may_be_missing_or_nested(spark, tmp_path):
    path = lines(tmp_path / "details.json", [json.loads("{}"), {"generated_unique_award_id": "A", "total_obligation": {"odd": 1}}])
    parsed = {r.award_key: r.rescued for r in landed.parse_details(spark, path).collect()}
    assert parsed == {None: None, "A": {"obligated_amount": '{"odd": 1}'}}
