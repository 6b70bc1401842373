"""Registered queries: every model, view, gate, audit and report over the given tables."""

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from obligato.functions.dates import fiscal_years, lookback_window
from obligato.functions.money import exact_sum
from obligato.operators import bitmaps
from obligato.operators.changes import award_events
from obligato.operators.checks import together
from obligato.plans import audit, history, ingest, marts, niche, publish, reports, staging, views
from obligato.sources import landed, schemas
from obligato.sources.files import shared_folder, writer
from obligato.sources.raw_store import DayStore
from obligato.sources.versioned import Versions
from testbed import adapter
from testbed.adapter import AS_OF, DAYS

REPORT_YEARS = fiscal_years(AS_OF, 7)
TOP_N = 20
LANDED_LINES = 500_000


class Models:
    """The models over the adapter's raw tables, each derived on first use.

    ``store`` names models that several others read: like the publish step, they are written
    once and read back.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, day=AS_OF, store: tuple[str, ...] = ()):
        self._raw, self._store = (spark, sf_dir, [day]), store

    def __getattr__(self, name: str) -> DataFrame:
        model = self._build(name)
        if name in self._store:
            model = stored(self._raw[0], model, name)
        setattr(self, name, model)
        return model

    def _build(self, name: str) -> DataFrame:
        match name:
            case "raw_awards": return adapter.raw_awards(*self._raw)
            case "raw_transactions": return adapter.raw_transactions(*self._raw)
            case "raw_award_details": return adapter.raw_award_details(*self._raw)
            case "awards": return staging.stg_awards(self.raw_awards, day=self._raw[2][0])
            case "transactions": return staging.stg_transactions(self.raw_transactions, day=self._raw[2][0])
            case "details": return staging.stg_award_details(self.raw_award_details, day=self._raw[2][0])
            case "niche": return niche.int_niche_filter(self.awards)
            case "flags": return niche.int_recompete_flags(self.niche, self.details)
            case "fact": return marts.fact_awards(self.flags)
            case "recompetes": return marts.recompetes(self.fact)
            case "niche_keys": return self.niche.where("in_niche").select("award_key", "in_niche")
            case "obligations": return marts.fct_obligations(self.transactions, self.niche_keys)
            case "niche_obligations":
                # The stored fact holds exactly the niche awards, so the labels need not be built again.
                return marts.fct_obligations(self.transactions, self.fact.withColumn("in_niche", F.lit(True)))
            case "agencies": return marts.dim_agencies(self.fact, self.niche_obligations)
            case "vendors":
                return marts.dim_vendors(self.fact, self.niche_obligations,
                                         lambda rows: stored(self._raw[0], rows, "vendor_totals"))
            case "dash_recompetes": return views.vw_dash_recompetes(self.recompetes)
            case "dash_market": return views.vw_dash_market(self.niche_obligations, self.agencies)
            case "dash_wins": return views.vw_dash_wins(self.fact)
        raise AttributeError(name)


def stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back, where a plan reads it several times."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer(rows).save(path)
    return spark.read.schema(rows.schema).parquet(path)


# Models that read stored ones: because these have several readers, or so that a join with a
# skewed key takes both sides straight from a shuffle and can be split.
_SHARED = {"obligations": ("niche_keys",), "agencies": ("fact",), "vendors": ("fact",), "dash_market": ("fact", "agencies")}


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(Models(spark, sf_dir, store=_SHARED.get(name, ())), name)


def _report(name: str, report: Callable[..., DataFrame], *args) -> Callable[[SparkSession, str], DataFrame]:
    # Reports do not read the agency status; with the agencies not stored, the optimizer drops their join.
    store = tuple(m for m in _SHARED.get(name, ()) if m != "agencies")
    return lambda spark, sf_dir: report(getattr(Models(spark, sf_dir, store=store), name), *args)


def stg_awards_latest(spark, sf_dir):
    return staging.stg_awards(adapter.raw_awards(spark, sf_dir, DAYS))


def stg_transactions_latest(spark, sf_dir):
    return staging.stg_transactions(adapter.raw_transactions(spark, sf_dir, DAYS))


def stg_details_latest(spark, sf_dir):
    return staging.stg_award_details(adapter.raw_award_details(spark, sf_dir, DAYS))


def rebuild_past_day(spark, sf_dir):
    """The recompete list as it was on the second snapshot day."""
    raw = adapter.raw_awards(spark, sf_dir, DAYS), adapter.raw_award_details(spark, sf_dir, DAYS)
    awards, details = staging.stg_awards(raw[0], DAYS[1]), staging.stg_award_details(raw[1], DAYS[1])
    flags = niche.int_recompete_flags(niche.int_niche_filter(awards), details)
    return marts.recompetes(marts.fact_awards(flags))


def niche_labels_free_text(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "text")
    return niche.with_description_rules(documents, "text").drop("text")


def running_awards(spark, sf_dir):
    m = Models(spark, sf_dir)
    return staging.running_awards(m.raw_awards).select("award_key", "award_amount", "end_date", "as_of_date")


def niche_window_filter(spark, sf_dir):
    return staging.niche_search(adapter.raw_transactions(spark, sf_dir), *lookback_window(AS_OF)).select(
        "award_key", "modification_number", "action_date", "obligation_amount", "naics_code", "contract_award_type")


def gate_counts(spark, sf_dir):
    """Both pulls against the counts of the given tables, and against ones that are off by one and a far larger minimum."""
    m = Models(spark, sf_dir, store=("raw_awards", "raw_transactions"))
    awards, actions = adapter.control_counts(spark, sf_dir)
    runs = [
        together([ingest.gate_awards(m.raw_awards, awards + off, min_rows),
                  ingest.gate_transactions(m.raw_transactions, actions + off)])
        .select(F.lit(name).alias("control"), "check", "failing_rows")
        for name, off, min_rows in (("exact", 0, ingest.fixed.MIN_AWARDS), ("off_by_one", 1, 10**9))
    ]
    return together(runs).where(F.col("check").isin("awards_too_few", "awards_incomplete", "transactions_incomplete"))


def _all_gates(spark, sf_dir) -> DataFrame:
    m = Models(spark, sf_dir)
    return together([ingest.gate_awards(m.raw_awards), ingest.gate_transactions(m.raw_transactions),
                     ingest.gate_details(m.raw_award_details)])


def gate_duplicates(spark, sf_dir):
    return _all_gates(spark, sf_dir).where(F.col("check").endswith("duplicate_key"))


def gate_missing(spark, sf_dir):
    """Pulls in which every required column is empty in some rows."""
    def spoiled(rows, **every):
        return rows.withColumns({c: F.when(_order_of() % n != 0, F.col(c)) for c, n in every.items()})

    m = Models(spark, sf_dir)
    return together([
        ingest.gate_awards(spoiled(m.raw_awards, award_key=83)),
        ingest.gate_transactions(spoiled(m.raw_transactions, award_key=79, action_date=71)),
        ingest.gate_details(spoiled(m.raw_award_details, award_key=73)),
    ]).where(F.col("check").contains("missing"))


def gate_orphans(spark, sf_dir):
    m = Models(spark, sf_dir)
    return ingest.gate_orphans(m.raw_transactions, m.raw_awards)


def gate_coverage(spark, sf_dir):
    m = Models(spark, sf_dir)
    return ingest.gate_coverage(staging.running_awards(m.raw_awards), m.raw_award_details)


def exact_dedupe(spark, sf_dir):
    """A pull in which the lines of every seventh order came twice, without the copies."""
    pull = adapter.raw_transactions(spark, sf_dir)
    order = F.substring_index("award_key", "_", -1).cast("bigint")
    twice = F.when(order % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    repeated = pull.select("*", F.explode(twice).alias("copy")).drop("copy")
    return ingest.exact_dedupe(repeated).select(
        "snapshot_date", "award_key", "modification_number", "action_date", "obligation_amount", "recipient_uei")


def audit_results(spark, sf_dir):
    """The audit of models spoiled so that every data test finds rows: repeated awards, odd statuses, ended periods."""
    m, k = Models(spark, sf_dir, store=("fact",)), _order_of()
    fact = m.fact.withColumn("status", F.when(k % 67 == 0, "lost").otherwise(F.col("status")))
    fact = fact.select("*", F.explode(F.when(k % 61 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    ended = F.when(k % 7 == 0, F.date_sub("as_of_date", 1)).otherwise(F.col("end_date"))
    return audit.audit_results(fact, m.niche_obligations, m.recompetes.withColumn("end_date", ended), m.awards,
                               landed.fixed.NICHE_SIZE)


def reconcile_totals(spark, sf_dir):
    """Control totals within the tolerance and beyond it."""
    m = Models(spark, sf_dir)
    control = stored(spark, adapter.control_totals(spark, sf_dir), "control")
    return together([
        audit.reconcile(m.transactions, control.withColumn("amount", F.col("amount") * factor))
        .select(F.lit(name).alias("control"), "*")
        for name, factor in (("close", 1.004), ("far", 1.05))
    ]).select("control", "awarding_agency", "ours", "theirs", F.round("difference", 6).alias("difference"), "failed")


def snapshot_history(spark, sf_dir):
    """Three days of history, rebuilt in one pass over the raw tables."""
    return history.rebuild_history(adapter.raw_awards(spark, sf_dir, DAYS), adapter.raw_award_details(spark, sf_dir, DAYS))


def award_events_query(spark, sf_dir):
    return award_events(snapshot_history(spark, sf_dir), DAYS)


def vendor_share_rank(spark, sf_dir):
    return views.vw_dash_vendor_share(_model("vendors")(spark, sf_dir))


def top5_share(spark, sf_dir):
    return reports.top_share(vendor_share_rank(spark, sf_dir))


def top_vendors(spark, sf_dir):
    return reports.top_vendors(_model("vendors")(spark, sf_dir), 15)


def _as_landed(rows: DataFrame, fields: dict[str, str], spoil: dict) -> DataFrame:
    """Raw rows back in the landed JSON shape; ``spoil`` replaces some columns by odd text."""
    tree: dict[str, list] = {}
    for path, column in fields.items():
        top, _, leaf = path.partition(".")
        value = spoil.get(column, F.col(column))
        tree.setdefault(top, []).append(value.alias(leaf or top))
    parts = [
        (F.struct(*values).alias(top) if any(p.startswith(f"{top}.") for p in fields) else values[0])
        for top, values in tree.items()
    ]
    return rows.select(F.to_json(F.struct(*parts)).alias("value"))


def _land(spark: SparkSession, rows: DataFrame) -> str:
    """Landed as compressed lines; a compressed file is read by one task, so its number of lines is bounded."""
    path = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    rows.write.option("compression", "gzip").option("maxRecordsPerFile", LANDED_LINES).text(path)
    return path


def _order_of(key: str = "award_key"):
    return F.substring_index(key, "_", -1).cast("bigint")


def _landed_awards(spark, sf_dir) -> DataFrame:
    """Awards as nested JSON lines, with some bad numbers and dates."""
    k = _order_of()
    spoil = {
        "award_amount": F.when(k % 17 == 0, "n/a").otherwise(F.col("award_amount").cast("string")),
        "end_date": F.when(k % 19 == 0, "2001-02-30").otherwise(F.col("end_date").cast("string")),
        "start_date": F.concat(F.col("start_date").cast("string"), F.lit(" 00:00:00")),
        "last_modified_date": F.date_format("last_modified_date", "yyyy-MM-dd HH:mm:ss"),
    }
    return _as_landed(adapter.raw_awards(spark, sf_dir), landed.fixed.AWARD_FIELDS, spoil)


def _landed_transactions(spark, sf_dir) -> DataFrame:
    spoil = {"action_date": F.when(_order_of() % 19 == 0, "soon").otherwise(F.col("action_date").cast("string"))}
    return _as_landed(adapter.raw_transactions(spark, sf_dir), landed.fixed.TRANSACTION_FIELDS, spoil)


def _landed_details(spark, sf_dir) -> DataFrame:
    spoil = {
        "potential_end_date": F.concat(F.col("potential_end_date").cast("string"), F.lit(" 00:00:00")),
        "number_of_offers_received": F.when(_order_of() % 9 == 5, "6.5").otherwise(
            F.col("number_of_offers_received").cast("string")),
    }
    return _as_landed(adapter.raw_award_details(spark, sf_dir), landed.fixed.DETAIL_FIELDS, spoil)


def flatten_awards(spark, sf_dir):
    """Landed awards read back as typed columns."""
    return landed.read_awards(spark, _land(spark, _landed_awards(spark, sf_dir)))


def flatten_transactions(spark, sf_dir):
    return landed.read_transactions(spark, _land(spark, _landed_transactions(spark, sf_dir)))


def flatten_details(spark, sf_dir):
    return landed.read_details(spark, _land(spark, _landed_details(spark, sf_dir)))


def _parsed_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The three landed tables, each with a torn line for every 23rd award or line, parsed and stored."""
    sources = {"raw_awards": (_landed_awards, adapter.raw_awards, landed.parse_awards),
               "raw_transactions": (_landed_transactions, adapter.raw_transactions, landed.parse_transactions),
               "raw_award_details": (_landed_details, adapter.raw_award_details, landed.parse_details)}
    parsed = {}
    for table, (lines, raw, parse) in sources.items():
        torn = raw(spark, sf_dir).where(_order_of() % 23 == 0).select(F.concat(F.lit('{"torn": "'), "award_key").alias("value"))
        parsed[table] = stored(spark, parse(spark, _land(spark, lines(spark, sf_dir).unionByName(torn))), table)
    return parsed


def coercion_counts(spark, sf_dir):
    """Per field of the landed tables, how many texts gave no value."""
    return together([landed.coercions(rows, table) for table, rows in _parsed_tables(spark, sf_dir).items()])


def landed_quarantine(spark, sf_dir):
    """Every text that gave no value, and every torn line."""
    return together([landed.quarantined(rows, table) for table, rows in _parsed_tables(spark, sf_dir).items()])


def _vendor_sets(spark, sf_dir) -> DataFrame:
    """Bitmaps of the vendors of the niche's actions, per department, sub-agency and fiscal year."""
    market = stored(spark, _model("dash_market")(spark, sf_dir), "market")
    vendors = stored(spark, bitmaps.extended(None, market, "recipient_uei"), "vendor_codes")
    return stored(spark, bitmaps.bitmaps(market, reports.VENDOR_GROUPS, "recipient_uei", vendors), "vendor_sets")


def distinct_vendors(spark, sf_dir):
    """Distinct vendors at every level of department, sub-agency and year, from one table of bitmaps."""
    return reports.vendor_roll_ups(_vendor_sets(spark, sf_dir))


def distinct_vendors_3y(spark, sf_dir):
    """Distinct vendors of a department over three fiscal years."""
    return reports.vendors_over_years(_vendor_sets(spark, sf_dir), 3)


def _clean_pull(spark, sf_dir, day, with_award: bool = False):
    """A pull without faults, as it would pass the gates and the audit; the lines of one number are one action.

    ``with_award``: only the lines of awards that the pull holds.
    """
    awards, details = (pull(spark, sf_dir, [day], faults=False) for pull in (adapter.raw_awards, adapter.raw_award_details))
    return awards, adapter.clean_transactions(spark, sf_dir, day, with_award), details


def _warehouse(spark):
    root = f"{shared_folder(spark)}/publish-{uuid.uuid4().hex}"
    return DayStore(spark, f"{root}/raw"), publish.Warehouse(spark, f"{root}/warehouse")


def publish_roundtrip(spark, sf_dir):
    """Load a day through the gates, be refused for totals that are too high, then publish; rows and dollars of each table,
    and whether each is still what the commit says."""
    store, warehouse = _warehouse(spark)
    ingest.load_day(store, AS_OF, *_clean_pull(spark, sf_dir, AS_OF))
    control = stored(spark, adapter.control_totals(spark, sf_dir), "control")
    try:
        publish.refresh(store, warehouse, control.withColumn("amount", F.col("amount") * 1.05), (1, 10**12))
    except publish.PublishRefused:
        refused = warehouse.live_run() is None
    else:
        refused = False
    publish.refresh(store, warehouse, control, (1, 10**12))
    money = {"stg_transactions": "obligation_amount", "fct_obligations": "obligation_amount",
             "stg_award_details": "obligated_amount", "dim_agencies": "niche_award_amount",
             "dim_vendors": "niche_award_amount"}
    tables = {name: warehouse.table(name) for name in publish.MODELS} | {history.TABLE: history.committed_history(warehouse)}
    parts = [rows.agg(F.count("*").alias("rows"), exact_sum(F.col(money.get(name, "award_amount"))).alias("amount"))
             .select(F.lit(name).alias("table_name"), "rows", "amount") for name, rows in tables.items()]
    checked = together(parts).join(warehouse.verify().select("table_name", "intact"), "table_name", "left")
    gate = spark.range(1).select(F.lit("refused").alias("table_name"), F.lit(int(refused)).cast("bigint").alias("rows"),
                                 F.lit(None).cast("double").alias("amount"), F.lit(None).cast("boolean").alias("intact"))
    return checked.unionByName(gate)


def publish_steps(spark, sf_dir):
    """Two runs prepared upon the same commit: what readers see before, between and after, and the slower one refused."""
    store, warehouse = _warehouse(spark)
    seen = []

    def look(step: str, refused: int = 0) -> None:
        fact, days = warehouse.table("fact_awards"), history.committed_history(warehouse)
        one = fact.agg(F.count("*").alias("awards"), exact_sum(F.col("award_amount")).alias("amount"), F.max("as_of_date").alias("as_of_date"))
        row = one.select("*", days.agg(F.count("*")).scalar().alias("history_rows"),
                         history.committed_events(warehouse).agg(F.count("*")).scalar().alias("event_rows")).first()
        seen.append((step, len(warehouse.log.numbers()), *row, refused))

    for day in DAYS[1:]:
        # An award that is missing on the earlier day has no lines there either.
        ingest.load_day(store, day, *_clean_pull(spark, sf_dir, day, with_award=True))
    publish.refresh(store, warehouse, None, (1, 10**12), as_of=DAYS[1])
    look("first day")
    fast, slow = (publish.prepare(store, warehouse, None, (1, 10**12)) for _ in range(2))
    look("two prepared")
    publish.publish(fast)
    look("one published")
    try:
        publish.publish(slow)
    except publish.PublishRefused:
        look("other refused", 1)
    return spark.createDataFrame(seen, "step string, commits int, awards bigint, amount double, as_of_date date, "
                                       "history_rows bigint, event_rows bigint, refused int")


def load_all_or_nothing(spark, sf_dir):
    """Loads that fail one gate leave all three raw tables as they were: before the first good load and after it."""
    store, seen = DayStore(spark, f"{shared_folder(spark)}/load-{uuid.uuid4().hex}"), []
    awards, lines, details = (stored(spark, rows, "pull") for rows in _clean_pull(spark, sf_dir, AS_OF))
    pulls = {"details missing": (awards, lines, details.where(_order_of() % 5 > 0)), "good": (awards, lines, details),
             "keys repeated": (awards.unionByName(awards.withColumn("award_amount", F.lit(-1.0))), lines, details),
             "no awards": (awards.limit(0), lines, details)}
    for name, pull in pulls.items():
        try:
            ingest.load_day(store, AS_OF, *pull)
            refused = 0
        except ingest.ValidationError:
            refused = 1
        seen += [(name, refused, table, store.read(table).count() if store.days(table) else 0) for table in store.schemas]
    return spark.createDataFrame(seen, "pull string, refused int, table_name string, rows bigint")


def views_follow_publish(spark, sf_dir):
    """Rows of the views in a session that was opened before the second of two publishes."""
    store, warehouse = _warehouse(spark)
    for day in DAYS[1:]:
        ingest.load_day(store, day, *_clean_pull(spark, sf_dir, day, with_award=True))
    publish.refresh(store, warehouse, None, (1, 10**12), as_of=DAYS[1])
    reader = spark.newSession()
    names = [*publish.MODELS, *publish.DASHBOARDS, publish.EVENTS_VIEW]
    before = {name: reader.sql(f"SELECT count(*) FROM {name}").first()[0] for name in names}
    publish.refresh(store, warehouse, None, (1, 10**12))
    rows = [(name, before[name], reader.sql(f"SELECT count(*) FROM {name}").first()[0]) for name in names]
    return spark.createDataFrame(rows, "view string, rows_before bigint, rows_after bigint")


def history_rerun(spark, sf_dir):
    """Three days appended to a stored history, the last one twice."""
    store = history.history_store(spark, f"{shared_folder(spark)}/history-{uuid.uuid4().hex}")
    for day in [*DAYS, DAYS[-1]]:
        history.append_day(store, Models(spark, sf_dir, day).fact, day)
    return store.read(history.TABLE).groupBy("snapshot_date").agg(
        F.count("*").alias("rows"), F.countDistinct("award_key").alias("awards"))


def _committed(spark, sf_dir) -> Versions:
    """A history of intervals by one commit a day: the middle day comes last, after a first, empty try at it."""
    versions = Versions(spark, f"{shared_folder(spark)}/intervals-{uuid.uuid4().hex}")
    facts = {day: stored(spark, Models(spark, sf_dir, day).fact, "fact") for day in DAYS}
    for day, fact in ((DAYS[0], facts[DAYS[0]]), (DAYS[1], facts[DAYS[1]].limit(0)), (DAYS[2], facts[DAYS[2]]), (DAYS[1], facts[DAYS[1]])):
        draft = versions.begin()
        history.put_day(draft, fact, day)
        draft.commit()
    return versions


def history_intervals(spark, sf_dir):
    """One row per state of an award, merged day by day."""
    return history.committed_intervals(_committed(spark, sf_dir))


def history_from_intervals(spark, sf_dir):
    return history.committed_history(_committed(spark, sf_dir))


def history_past_day(spark, sf_dir):
    """The history as it stood on a day between two snapshots."""
    return history.committed_day(_committed(spark, sf_dir), DAYS[2] - dt.timedelta(days=1))


def events_from_intervals(spark, sf_dir):
    return history.committed_events(_committed(spark, sf_dir))


def latest_events_stored(spark, sf_dir):
    """Events of the newest day from a stored history; the oldest day's folder is not opened."""
    store = history.history_store(spark, f"{shared_folder(spark)}/history-{uuid.uuid4().hex}")
    store.replace_days(history.TABLE, snapshot_history(spark, sf_dir), many_days=True)
    return history.vw_award_events(store, since=DAYS[-1])


def events_daily_table(spark, sf_dir):
    """Events stored day by day, the first days once more after the last one."""
    store = history.history_store(spark, f"{shared_folder(spark)}/history-{uuid.uuid4().hex}")
    store.replace_days(history.TABLE, snapshot_history(spark, sf_dir), many_days=True)
    for day in [*DAYS, *DAYS[:2]]:
        history.append_events(store, day)
    return history.stored_events(store)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_awards_latest": stg_awards_latest,
    "rebuild_past_day": rebuild_past_day,
    "stg_transactions_latest": stg_transactions_latest,
    "stg_details_latest": stg_details_latest,
    "niche_labels": _model("niche"),
    "niche_labels_free_text": niche_labels_free_text,
    "recompete_status": _model("flags"),
    "fact_awards": _model("fact"),
    "recompete_list": _model("recompetes"),
    "obligations_by_action": _model("obligations"),
    "agency_dimension": _model("agencies"),
    "vendor_dimension": _model("vendors"),
    "vendor_share_rank": vendor_share_rank,
    "award_events": award_events_query,
    "latest_events_stored": latest_events_stored,
    "events_daily_table": events_daily_table,
    "snapshot_history": snapshot_history,
    "running_awards": running_awards,
    "niche_window_filter": niche_window_filter,
    "dash_recompetes": _model("dash_recompetes"),
    "dash_market": _model("dash_market"),
    "dash_wins": _model("dash_wins"),
    "window_kpis": _report("dash_recompetes", reports.window_kpis),
    "expiring_by_month": _report("dash_recompetes", reports.expiring_by_month),
    "next_to_end": _report("dash_recompetes", reports.next_to_end, TOP_N),
    "obligations_by_fy_yoy": _report("dash_market", reports.obligations_by_fy),
    "dept_fy_pivot": _report("dash_market", reports.department_by_fy, REPORT_YEARS),
    "dept_rollup": _report("dash_market", reports.department_drill),
    "top_sub_agencies": _report("dash_market", reports.top_sub_agencies, TOP_N),
    "wins_by_vendor_fy": _report("dash_wins", reports.wins_by_vendor_fy),
    "top5_share": top5_share,
    "top_vendors": top_vendors,
    "niche_funnel": _report("niche", reports.niche_funnel),
    "exclusion_counts": _report("niche", reports.exclusion_counts),
    "quality_flags": _report("awards", reports.quality_flags),
    "agency_totals": _report("transactions", audit.agency_totals),
    "gate_duplicates": gate_duplicates,
    "gate_missing": gate_missing,
    "gate_orphans": gate_orphans,
    "gate_coverage": gate_coverage,
    "gate_counts": gate_counts,
    "exact_dedupe": exact_dedupe,
    "audit_results": audit_results,
    "reconcile_totals": reconcile_totals,
    "flatten_awards": flatten_awards,
    "flatten_transactions": flatten_transactions,
    "flatten_details": flatten_details,
    "coercion_counts": coercion_counts,
    "landed_quarantine": landed_quarantine,
    "distinct_vendors": distinct_vendors,
    "distinct_vendors_3y": distinct_vendors_3y,
    "publish_roundtrip": publish_roundtrip,
    "publish_steps": publish_steps,
    "load_all_or_nothing": load_all_or_nothing,
    "views_follow_publish": views_follow_publish,
    "history_rerun": history_rerun,
    "history_intervals": history_intervals,
    "history_from_intervals": history_from_intervals,
    "history_past_day": history_past_day,
    "events_from_intervals": events_from_intervals,
}
