"""Schemas of the raw tables and of the landed JSON records."""

from pyspark.sql import types as T

from obligato import fixed_values as fixed

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "date": T.DateType(), "bigint": T.LongType(),
    "boolean": T.BooleanType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _columns(names_and_types: str) -> T.StructType:
    """Schema from "name type, ..." without needing a running session, as DDL parsing would."""
    pairs = [column.split() for column in names_and_types.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_AWARDS = _columns("""
    snapshot_date date, award_key string, award_id string, recipient_name string, recipient_uei string,
    awarding_agency string, awarding_sub_agency string, award_amount double, total_outlays double,
    start_date date, end_date date, naics_code string, naics_description string, psc_code string,
    psc_description string, description string, contract_award_type string,
    last_modified_date timestamp_ntz, base_obligation_date date
""")

RAW_TRANSACTIONS = _columns("""
    snapshot_date date, award_key string, award_id string, modification_number string, action_date date,
    action_type string, obligation_amount double, transaction_description string, recipient_name string,
    recipient_uei string, awarding_agency string, awarding_sub_agency string, contract_award_type string,
    naics_code string, psc_code string
""")

RAW_AWARD_DETAILS = _columns("""
    snapshot_date date, award_key string, current_end_date date, potential_end_date date,
    obligated_amount double, base_exercised_options_value double, base_and_all_options_value double,
    type_set_aside string, type_set_aside_description string, extent_competed_description string,
    number_of_offers_received bigint, solicitation_identifier string
""")

SNAPSHOT_DAILY = _columns("""
    snapshot_date date, award_key string, award_id string, awarding_agency string,
    awarding_sub_agency string, recipient_uei string, recipient_name string, subtype string,
    award_amount double, end_date date, status string, successor_award_key string, reconstructed boolean
""")

#: The history as intervals: a day's columns without the day, and the days between which they held.
SNAPSHOT_INTERVALS = T.StructType([f for f in SNAPSHOT_DAILY.fields if f.name != "snapshot_date"]).add(
    "valid_from", "date").add("valid_to", "date")

AWARD_EVENTS = _columns("""
    snapshot_date date, award_key string, award_id string, awarding_sub_agency string, recipient_name string,
    event string, old_value string, new_value string
""")

#: Landed texts that gave no value, and lines that are no records, by the day of the pull.
QUARANTINE = _columns("snapshot_date date, table_name string, award_key string, field string, value string")

RAW_TABLES = {
    "raw_awards": RAW_AWARDS,
    "raw_transactions": RAW_TRANSACTIONS,
    "raw_award_details": RAW_AWARD_DETAILS,
}


def landed_schema(fields: dict[str, str]) -> T.StructType:
    """JSON read schema for a field map. Leaves are text, so a badly typed value never loses its row."""
    tree: dict[str, list[str]] = {}
    for path in fields:
        top, _, leaf = path.partition(".")
        tree.setdefault(top, [])
        if leaf:
            tree[top].append(leaf)
    text = T.StringType()
    return T.StructType([
        T.StructField(top, T.StructType([T.StructField(x, text) for x in leaves]) if leaves else text)
        for top, leaves in tree.items()
    ])


LANDED_AWARDS = landed_schema(fixed.AWARD_FIELDS)
LANDED_TRANSACTIONS = landed_schema(fixed.TRANSACTION_FIELDS)
LANDED_DETAILS = landed_schema(fixed.DETAIL_FIELDS)
