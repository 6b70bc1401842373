"""Flat dashboard views over the published marts."""

from pyspark.sql import DataFrame, functions as F

from obligato import fixed_values as fixed
from obligato.functions.dates import fiscal_year, in_last_months, month_of
from obligato.operators.ranking import with_rank_desc


def vw_dash_recompetes(recompetes: DataFrame) -> DataFrame:
    soon = F.col("in_act_now_window")
    return recompetes.select(
        "award_id", "usaspending_url", F.col("awarding_agency").alias("awarding_department"),
        "awarding_sub_agency", "incumbent_name", "incumbent_uei", "description",
        "award_amount", "ceiling_value", "start_date", "end_date",
        month_of(F.col("end_date")).alias("expiry_month"),
        "days_to_expiry",
        F.when(soon, "Next 6 months").otherwise("6-12 months").alias("time_window"),
        soon.alias("in_6m_window"),
        "has_options_remaining", "potential_end_date", "set_aside",
        (F.col("set_aside") != fixed.SET_ASIDE_MISSING).alias("set_aside_reported"),
        "extent_competed", "number_of_offers_received", "notice_out",
        F.lit(None).cast("string").alias("notice_id"),
        "as_of_date",
    )


def vw_dash_market(fct_obligations: DataFrame, dim_agencies: DataFrame) -> DataFrame:
    """Niche actions with their sub-agency's status.

    Reads the stored agencies, so that a sub-agency with a large part of all actions can be split.
    """
    as_of = F.col("as_of_date")
    labels = dim_agencies.select("awarding_sub_agency", "agency_status")
    return fct_obligations.where("in_niche").join(labels, "awarding_sub_agency", "left").select(
        "award_id", "modification_number", "action_date", "fiscal_year",
        (F.col("fiscal_year") == fiscal_year(as_of)).alias("is_current_fy"),
        in_last_months(F.col("action_date"), as_of, 24).alias("in_last_24m"),
        F.col("obligation_amount").alias("obligated_amount"),
        "is_deobligation", F.col("awarding_agency").alias("awarding_department"),
        "awarding_sub_agency", "agency_status", "recipient_uei", "recipient_name", "as_of_date",
    )


def vw_dash_wins(fact_awards: DataFrame) -> DataFrame:
    return fact_awards.select(
        "award_id", "recipient_uei", "recipient_name", "is_masked_recipient",
        F.col("award_fiscal_year").alias("win_fiscal_year"), "award_date", "award_amount",
        F.col("awarding_agency").alias("awarding_department"), "awarding_sub_agency", "as_of_date",
    )


def vw_dash_vendor_share(dim_vendors: DataFrame) -> DataFrame:
    """Vendors ranked by recent obligations; a tie shares its rank, so a top list may be longer."""
    columns = ["recipient_uei", "recipient_name", "is_masked_recipient", "niche_awards",
               "active_awards", "obligations_24m", "share_24m"]
    ranked = with_rank_desc(dim_vendors.select(*columns, "as_of_date"), "obligations_24m", "share_rank")
    rank = F.col("share_rank")
    return ranked.select(*columns, "share_rank", (rank <= 5).alias("is_top5"),
                         (rank <= 15).alias("is_top15"), "as_of_date")
