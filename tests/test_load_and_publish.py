"""Landed JSON, gates, day store, audit, reconciliation and publishing."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from obligato.functions.dates import fiscal_years, lookback_window
from obligato.plans import audit, history, ingest, publish, staging
from obligato.sources import landed
from obligato.sources.raw_store import DayStore
from obligato.sources import schemas
from obligato.sources.schemas import RAW_AWARDS, RAW_TRANSACTIONS
from tests.handmade import ACTIONS, AWARDS, DAY, DETAILS, action, award, d, detail, frames

GOLDEN = [a for a in AWARDS if a[0] == DAY]


def lines(path, records):
    path.write_text("\n".join(json.dumps(r) for r in records))
    return str(path)


def test_awards_from_json(spark, tmp_path):
    path = lines(tmp_path / "awards.json", [
        {"generated_internal_id": "LOCK", "Award ID": "77-L", "Award Amount": 640000, "Total Outlays": None,
         "Start Date": "2022-02-28", "End Date": "2024-02-29", "Recipient Name": "Elm & Sons",
         "NAICS": {"code": "561311", "description": "PLACEMENT"}, "PSC": {"code": "R499", "description": "OTHER"},
         "Last Modified Date": "2023-01-31 23:59:58", "Base Obligation Date": "2022-02-27", "unknown field": [1]},
        {"generated_internal_id": "TEXT", "PSC": None, "NAICS": "561320", "Award Amount": "0.75", "Total Outlays": 0},
        {"generated_internal_id": "BAD", "Award Amount": "about 5", "Start Date": "spring", "End Date": "2023-02-29",
         "Last Modified Date": "-", "Total Outlays": "9x"},
    ])
    rows = {r["award_key"]: r.asDict() for r in landed.read_awards(spark, path).collect()}
    assert set(rows["LOCK"]) == {f.name for f in RAW_AWARDS.fields} - {"snapshot_date"}

    def part(key, *columns):
        return [rows[key][c] for c in columns]

    assert part("LOCK", "award_amount", "total_outlays", "naics_code", "psc_description", "recipient_name") == [
        640000.0, None, "561311", "OTHER", "Elm & Sons"]
    assert part("LOCK", "start_date", "end_date", "last_modified_date", "base_obligation_date") == [
        d("2022-02-28"), d("2024-02-29"), dt.datetime(2023, 1, 31, 23, 59, 58), d("2022-02-27")]
    assert part("TEXT", "award_amount", "total_outlays", "psc_code", "naics_code") == [0.75, 0.0, None, None]
    assert part("BAD", "award_amount", "start_date", "end_date", "last_modified_date", "total_outlays") == [None] * 5


def test_transactions_and_details_from_json(spark, tmp_path):
    path = lines(tmp_path / "tx.json", [
        {"generated_internal_id": "LOCK", "Mod": "M9", "Action Type": "K", "Transaction Amount": -88.25,
         "naics_code": None, "product_or_service_code": "R431", "Award Type": "BPA CALL"},
        {"generated_internal_id": "LOCK", "Mod": "0", "Action Type": None, "Action Date": "2022-02-28",
         "Transaction Amount": "1204", "naics_code": "561311"},
    ])
    seen = {r.modification_number: (r.action_type, r.action_date, r.obligation_amount, r.psc_code, r.contract_award_type)
            for r in landed.read_transactions(spark, path).collect()}
    assert seen == {"M9": ("K", None, -88.25, "R431", "BPA CALL"), "0": (None, d("2022-02-28"), 1204.0, None, None)}

    path = lines(tmp_path / "details.json", [
        {"generated_unique_award_id": "LOCK", "total_obligation": 1115.75, "base_and_all_options": 5000,
         "period_of_performance": {"end_date": "2024-02-29", "potential_end_date": "2028-02-29 00:00:00"},
         "latest_transaction_contract_data": {"number_of_offers_received": "11", "type_set_aside": "LF"}},
        {"generated_unique_award_id": "BARE"},
        {"generated_unique_award_id": "PART", "latest_transaction_contract_data": {"number_of_offers_received": "2.25"}},
    ])
    rows = {r["award_key"]: r.asDict() for r in landed.read_details(spark, path).collect()}
    assert {k: v for k, v in rows["LOCK"].items() if v is not None} == {
        "award_key": "LOCK", "current_end_date": d("2024-02-29"), "potential_end_date": d("2028-02-29"),
        "obligated_amount": 1115.75, "base_and_all_options_value": 5000.0, "type_set_aside": "LF",
        "number_of_offers_received": 11}
    for key in ("BARE", "PART"):
        assert [c for c, v in rows[key].items() if v is not None] == ["award_key"]


def test_lookback_window():
    assert lookback_window(d("2023-09-30")) == (d("2018-10-01"), d("2023-09-30"))
    assert lookback_window(d("2023-10-01")) == (d("2019-10-01"), d("2023-10-01"))
    assert fiscal_years(d("2023-10-01"), 2) == [2023, 2024]


def test_search_window_is_inclusive(spark):
    rows = [action("A", "1", "2018-10-01", 1.0), action("A", "2", "2018-09-30", 1.0), action("A", "3", "2023-05-15", 1.0),
            action("A", "4", "2023-01-01", 1.0, naics_code="541511"),
            action("A", "5", "2023-01-01", 1.0, contract_award_type="GRANT")]
    kept = staging.niche_search(spark.createDataFrame(rows, RAW_TRANSACTIONS), *lookback_window(DAY))
    assert sorted(r["modification_number"] for r in kept.collect()) == ["1", "3"]


def found(checks):
    return {r["check"]: r["failing_rows"] for r in checks.where("failing_rows > 0").collect()}


def test_award_gates(spark):
    rows = spark.createDataFrame([award("A"), award("A"), award("A"), award(None), award(None), award("B")], RAW_AWARDS)
    assert found(ingest.gate_awards(rows, expected=8, min_rows=7)) == {
        "awards_too_few": 1, "awards_incomplete": 2, "awards_duplicate_key": 3, "awards_missing_award_key": 2}
    assert found(ingest.gate_awards(rows.where("award_key = 'B'"), expected=1, min_rows=1)) == {}
    assert found(ingest.gate_awards(rows.limit(0), expected=None, min_rows=50)) == {"awards_too_few": 50}


def test_transaction_gates(spark):
    awards = spark.createDataFrame([award("A"), award("A")], RAW_AWARDS)
    rows = [action("A", "0", "2026-01-01", 1.0), action("A", "0", "2026-01-01", 2.0), action("A", None, "2026-01-01", 1.0),
            action("A", None, "2026-01-01", 1.0), action("LOST", "0", "2026-01-01", 1.0),
            action("LOST", "1", "2026-01-01", 1.0, action_date=None), action(None, "0", "2026-01-01", 1.0)]
    pulled = spark.createDataFrame(rows, RAW_TRANSACTIONS)
    checks = ingest.gate_transactions(pulled, expected=8).unionByName(ingest.gate_orphans(pulled, awards))
    assert found(checks) == {"transactions_incomplete": 1, "transactions_duplicate_key": 2, "transactions_missing_action_date": 1,
                             "transactions_missing_award_key": 1, "transactions_without_award": 3}


def test_detail_gates(spark):
    _, _, details = frames(spark, details=[detail("A", "2027-01-01", "2027-01-01"), detail("A", "2027-01-01", "2027-01-01"),
                                           detail("B", "2027-01-01", "2027-01-01", potential_end_date=None)])
    running = spark.createDataFrame([award("A"), award("B"), award("C"), award("C")], RAW_AWARDS)
    checks = ingest.gate_details(details).unionByName(ingest.gate_coverage(running, details))
    assert found(checks) == {
        "details_duplicate_key": 1, "details_missing_potential_end_date": 1, "running_without_details": 1}


def test_only_exact_copies_are_dropped(spark):
    rows = spark.createDataFrame([award("A"), award("A"), award("A", award_amount=2.0)], RAW_AWARDS)
    assert ingest.exact_dedupe(rows).count() == 2


def pull(spark, awards=GOLDEN, actions=ACTIONS, details=DETAILS):
    return [f.drop("snapshot_date") for f in frames(spark, awards, actions, details)]


def test_load_is_all_or_nothing_and_replaces_one_day(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "raw"))
    running = DETAILS + [detail(f"Q{n}", "2024-02-29", "2024-02-29") for n in range(1, 9)]
    with pytest.raises(ingest.ValidationError, match="running_without_details: 8"):
        ingest.load_day(store, DAY, *pull(spark), min_rows=1)
    assert store.days("raw_awards") == store.days("raw_transactions") == store.days("raw_award_details") == []

    ingest.load_day(store, DAY, *pull(spark, details=running), expected_awards=17, min_rows=1)
    ingest.load_day(store, d("2023-05-16"), *pull(spark, details=running), min_rows=1)
    twice = [*GOLDEN, GOLDEN[0]]  # an exact copy is dropped, not rejected
    ingest.load_day(store, d("2023-05-16"), *pull(spark, awards=twice, details=running), min_rows=1)
    assert store.days("raw_awards") == [DAY, d("2023-05-16")]
    assert {r["snapshot_date"]: r["count"] for r in store.read("raw_awards").groupBy("snapshot_date").count().collect()} == {
        DAY: 17, d("2023-05-16"): 17}
    assert store.read_latest("raw_awards", DAY).select("snapshot_date").distinct().first()[0] == DAY
    assert store.read("raw_awards").columns == store.read("raw_awards", [DAY]).columns == [f.name for f in RAW_AWARDS.fields]
    with pytest.raises(ingest.ValidationError, match="awards_incomplete"):
        ingest.load_day(store, d("2023-05-17"), *pull(spark, details=running), expected_awards=18, min_rows=1)
    assert store.days("raw_awards") == [DAY, d("2023-05-16")]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    store = DayStore(spark, str(root / "raw"))
    awards, actions, details = frames(spark, GOLDEN)
    for table, rows in (("raw_awards", awards), ("raw_transactions", actions), ("raw_award_details", details)):
        store.replace_days(table, rows)
    return store, publish.Warehouse(spark, str(root / "models"))


def totals(spark, *rows):
    return spark.createDataFrame(list(rows), "agency string, amount double")


def test_publish_only_after_every_check(spark, loaded):
    store, warehouse = loaded
    with pytest.raises(publish.PublishRefused, match="niche_size_in_range: 1"):
        publish.refresh(store, warehouse, None, (100, 600))
    assert warehouse.live_run() is None
    with pytest.raises(LookupError):
        warehouse.table("fact_awards")

    control = totals(spark, ("Energy Council", 35000.0 * 1.004), ("Weather Office", 5.0))
    run = publish.refresh(store, warehouse, control, niche_size=(1, 600))
    assert warehouse.live_run() == run and warehouse.table("fact_awards").count() == 9
    assert history.snapshot_days(warehouse.newest()) == [DAY]
    assert spark.sql("SELECT count(*) FROM vw_dash_wins").first()[0] == 9
    assert spark.sql("SELECT count(*) FROM vw_award_events").first()[0] == 0

    with pytest.raises(publish.PublishRefused, match="control totals: Energy Council"):
        publish.refresh(store, warehouse, totals(spark, ("Energy Council", 35000.0 * 1.05)), niche_size=(1, 600))
    assert warehouse.live_run() == run
    again = publish.refresh(store, warehouse, None, niche_size=(1, 600))
    assert warehouse.live_run() == again != run
    assert history.committed_history(warehouse).count() == 9


def test_raw_tables_at_different_days_are_refused(spark, loaded, tmp_path):
    store, warehouse = loaded
    mixed = DayStore(spark, str(tmp_path / "raw"))
    for table in mixed.schemas:
        mixed.replace_days(table, store.read(table))
    mixed.replace_days("raw_awards", store.read("raw_awards").withColumn("snapshot_date", F.lit(d("2023-05-16"))))
    with pytest.raises(publish.PublishRefused, match="different days"):
        publish.refresh(mixed, warehouse, None, niche_size=(1, 600))


@pytest.mark.parametrize("control, failed, agency", [
    ([("DoD", 100.0), ("State", 5.0)], False, "DoD"),
    ([("DoD", 101.0)], False, "DoD"),
    ([("DoD", 112.0)], True, "DoD"),
    ([("Zed", 500.0)], True, "Zed"),
    ([("Zed", 0.0)], False, "Zed"),
    ([("DoD", 0.0)], True, "DoD"),
    ([("Zed", 100.5), ("DoD", 100.5)], False, "DoD"),
    ([], True, None),
])
def test_reconcile(spark, control, failed, agency):
    rows = [action("A", "0", "2026-01-01", 60.0, awarding_agency="DoD"),
            action("A", "1", "2026-01-01", 40.5, awarding_agency="DoD")]
    staged = staging.stg_transactions(spark.createDataFrame(rows, RAW_TRANSACTIONS))
    result = audit.reconcile(staged, totals(spark, *control)).collect()
    assert [(r["awarding_agency"], r["failed"]) for r in result] == [(agency, failed)]


def test_audit_finds_violations(spark):
    built = publish.build(*frames(spark))
    key = F.col("award_key")
    fact = built["fact_awards"].unionByName(built["fact_awards"].where("award_key = 'H1'")).withColumns({
        "recipient_uei": F.when(key != "H2", F.col("recipient_uei")),
        "status": F.when(key == "H5", "lost").otherwise(F.col("status"))})
    actions = built["fct_obligations"]
    actions = actions.unionByName(actions.where("award_key = 'H1'")).unionByName(
        actions.where("award_key = 'H4'").withColumn("award_key", F.lit("LOST")))
    listed = built["recompetes"].withColumns({
        "potential_end_date": F.when(key != "H3", F.col("potential_end_date")),
        "end_date": F.when(key == "H9", F.lit(d("2023-05-14"))).otherwise(F.col("end_date"))})
    results = audit.audit_results(fact, actions, listed, built["stg_awards"], niche_size=(1, 600))
    assert found(results) == {
        "unique_award_key": 1, "awards_have_agency_and_vendor": 1, "status_values": 1, "unique_obligation_key": 3,
        "obligations_belong_to_awards": 1, "recompetes_have_details": 1, "recompetes_not_expired": 1}


def test_numbers_keep_their_value_or_become_null(spark):
    from obligato.sources.landed import _typed
    from pyspark.sql import types as T

    texts = spark.createDataFrame([(t,) for t in ("6", "6.0", "1e1", "6.5", "NaN", "x", None)], "t string")
    got = texts.select(_typed(F.col("t"), T.LongType()).alias("n"), _typed(F.col("t"), T.DoubleType()).alias("x")).collect()
    assert [r.n for r in got] == [6, 6, 10, None, None, None, None]
    assert [r.x for r in got] == [6.0, 6.0, 10.0, 6.5, None, None, None]


def test_an_emptied_day_is_empty(spark, tmp_path):
    store = DayStore(spark, str(tmp_path))
    rows = spark.createDataFrame([detail("E1", "2027-01-31", "2027-01-31")], schemas.RAW_AWARD_DETAILS)
    store.replace_day("raw_award_details", DAY, rows)
    assert store.read("raw_award_details").count() == 1
    store.replace_day("raw_award_details", DAY, rows.limit(0))
    assert store.read("raw_award_details").count() == 0 and store.days("raw_award_details") == [DAY]


def test_unfit_amounts_are_counted_and_fractions_kept(spark):
    from obligato.functions.money import exact_sum
    from obligato.plans import ingest

    awards = spark.createDataFrame([award(f"U{i}", award_amount=x) for i, x in enumerate((1e300, float("inf"), 12.345))], schemas.RAW_AWARDS)
    none = spark.createDataFrame([], schemas.RAW_TRANSACTIONS), spark.createDataFrame([], schemas.RAW_AWARD_DETAILS)
    counted = {r["check"]: r["failing_rows"] for r in ingest.gate_amounts(awards, *none).collect()}
    assert counted == {"awards_unfit_amount": 2, "transactions_unfit_amount": 0, "details_unfit_amount": 0}
    assert awards.where("award_amount < 100").agg(exact_sum(F.col("award_amount"))).first()[0] == 12.345


def test_a_pivot_leaves_no_year_out(spark):
    from obligato.plans.reports import department_by_fy

    rows = spark.createDataFrame([("D", 2026, 1.0), ("D", 2019, 100.0), ("D", None, 5.0)], "awarding_department string, fiscal_year int, obligated_amount double")
    got = department_by_fy(rows, [2025, 2026]).first()
    assert (got.fy2025, got.fy2026, got.other_years, got.all_years) == (None, 1.0, 105.0, 106.0)


def test_unsupported_patterns_are_refused():
    from obligato.functions.text import _alternatives

    assert _alternatives(r"A|B[C|D]|^E\s*(F)?$") == ["A", r"B[C|D]", r"^E\s*(F)?$"]
    for pattern in (r"A(B|C)", r"A\bB", r"A\$", r"A$B", r"(?i)A"):
        with pytest.raises(ValueError):
            _alternatives(pattern)
