"""Staging models: one clean, typed table per raw table, from its newest snapshot."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from obligato import fixed_values as fixed
from obligato.functions.dates import days_between, fiscal_year
from obligato.functions.text import blank_to_null, matches, trimmed
from obligato.operators.snapshots import keep_latest, latest_snapshot


def stg_awards(raw_awards: DataFrame, as_of: dt.date | None = None, day: dt.date | None = None) -> DataFrame:
    """One row per award. Quality flags are columns; they never drop a row."""
    return _clean_awards(latest_snapshot(raw_awards, as_of, day), ["award_key"])


def every_day_awards(raw_awards: DataFrame) -> DataFrame:
    """``stg_awards`` of all snapshot days at once: one row per day and award."""
    return _clean_awards(raw_awards.withColumnRenamed("snapshot_date", "as_of_date"), ["as_of_date", "award_key"])


def _clean_awards(rows: DataFrame, keys: list[str]) -> DataFrame:
    one_each = keep_latest(rows.drop("total_outlays"), keys, [F.col("last_modified_date").desc_nulls_last()])
    name = F.col("recipient_name")
    return one_each.select(
        "award_key", "award_id",
        trimmed(name).alias("recipient_name"),
        blank_to_null(F.col("recipient_uei")).alias("recipient_uei"),
        trimmed(F.col("awarding_agency")).alias("awarding_agency"),
        trimmed(F.col("awarding_sub_agency")).alias("awarding_sub_agency"),
        "award_amount", "start_date", "end_date",
        "naics_code", "naics_description", "psc_code", "psc_description",
        trimmed(F.coalesce("description", F.lit(""))).alias("description"),
        "contract_award_type", "last_modified_date",
        F.coalesce("base_obligation_date", "start_date").alias("award_date"),
        (F.col("award_amount") == 0).alias("is_zero_amount"),
        matches(F.upper(name), fixed.MASKED_RECIPIENT).alias("is_masked_recipient"),
        (days_between(F.col("end_date"), F.col("start_date")) + 1).alias("duration_days"),
        "as_of_date",
    )


def stg_transactions(raw_transactions: DataFrame, as_of: dt.date | None = None, day: dt.date | None = None) -> DataFrame:
    """One row per contract action. Negative amounts (de-obligations) are kept."""
    used = latest_snapshot(raw_transactions, as_of, day)
    return used.select(
        "award_key", "award_id", "modification_number",
        (F.col("modification_number") == fixed.BASE_MODIFICATION).alias("is_base_award"),
        "action_date",
        fiscal_year(F.col("action_date")).alias("fiscal_year"),
        "action_type", "obligation_amount",
        (F.col("obligation_amount") < 0).alias("is_deobligation"),
        trimmed(F.col("awarding_agency")).alias("awarding_agency"),
        trimmed(F.col("awarding_sub_agency")).alias("awarding_sub_agency"),
        trimmed(F.col("recipient_name")).alias("recipient_name"),
        blank_to_null(F.col("recipient_uei")).alias("recipient_uei"),
        "contract_award_type", "naics_code", "psc_code",
        trimmed(F.coalesce("transaction_description", F.lit(""))).alias("transaction_description"),
        "as_of_date",
    )


def stg_award_details(raw_award_details: DataFrame, as_of: dt.date | None = None, day: dt.date | None = None) -> DataFrame:
    """One row per still-running award, from its detail page."""
    return _clean_details(latest_snapshot(raw_award_details, as_of, day).drop("as_of_date"), ["award_key"])


def every_day_details(raw_award_details: DataFrame) -> DataFrame:
    """``stg_award_details`` of all snapshot days at once, with the day."""
    return _clean_details(raw_award_details.withColumnRenamed("snapshot_date", "as_of_date"),
                          ["as_of_date", "award_key"])


def _clean_details(rows: DataFrame, keys: list[str]) -> DataFrame:
    one_each = keep_latest(rows, keys, [F.col("potential_end_date").desc_nulls_last()])
    set_aside = blank_to_null(F.col("type_set_aside_description"))
    return one_each.select(
        *keys, "current_end_date", "potential_end_date", "obligated_amount",
        "base_exercised_options_value", "base_and_all_options_value",
        blank_to_null(F.col("type_set_aside")).alias("type_set_aside"),
        F.coalesce(set_aside, F.lit(fixed.SET_ASIDE_MISSING)).alias("set_aside"),
        blank_to_null(F.col("extent_competed_description")).alias("extent_competed"),
        "number_of_offers_received",
        blank_to_null(F.col("solicitation_identifier")).alias("solicitation_identifier"),
    )


def running_awards(raw_awards: DataFrame) -> DataFrame:
    """Awards of the newest snapshot that have not ended; no end date means not running."""
    return latest_snapshot(raw_awards).where(F.col("end_date") >= F.col("as_of_date"))


def niche_search(actions: DataFrame, start: dt.date, end: dt.date, day: str = "action_date") -> DataFrame:
    """Landed actions of the niche industry codes and contract types dated inside the window."""
    return actions.where(
        F.col("naics_code").isin(fixed.NICHE_NAICS)
        & F.col("contract_award_type").isin(list(fixed.CONTRACT_TYPES.values()))
        & F.col(day).between(F.lit(start), F.lit(end))
    )
