"""Marts: niche awards, the recompete list, contract actions, agencies and vendors."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from obligato import fixed_values as fixed
from obligato.functions.dates import fiscal_year, in_last_months
from obligato.functions.money import exact, exact_sum


def fact_awards(int_recompete_flags: DataFrame) -> DataFrame:
    """One row per niche award with its value measures and window flags."""
    _, soon, this_year, _ = fixed.STATUSES
    status = F.col("status")
    # Unknown duration stays unknown: greatest() alone would skip the NULL and charge one year.
    years = F.greatest(F.col("duration_days") / fixed.DAYS_PER_YEAR, F.lit(1.0))
    per_year = F.when(F.col("duration_days").isNotNull(), F.col("award_amount") / years)
    return int_recompete_flags.select(
        "award_key", "award_id", "recipient_uei", "recipient_name", "is_masked_recipient",
        "awarding_agency", "awarding_sub_agency", "description", "naics_code", "psc_code",
        "contract_award_type", "award_date", "start_date", "end_date", "potential_end_date",
        "has_options_remaining",
        fiscal_year(F.col("award_date")).alias("award_fiscal_year"),
        "duration_days", "award_amount",
        F.col("base_and_all_options_value").alias("ceiling_value"),
        "is_zero_amount",
        per_year.alias("annualized_value"),
        "days_to_expiry", "status", "set_aside", "extent_competed",
        "number_of_offers_received", "solicitation_identifier",
        status.isin(soon, this_year).alias("in_recompete_window"),
        (status == soon).alias("in_act_now_window"),
        (F.col("end_date") >= F.col("as_of_date")).alias("is_active"),
        F.concat(F.lit(fixed.AWARD_URL_PREFIX), "award_key").alias("usaspending_url"),
        "last_modified_date", "as_of_date",
    )


def recompetes(fact_awards: DataFrame) -> DataFrame:
    """Niche awards whose current period ends within twelve months, with the incumbent."""
    return fact_awards.where("in_recompete_window").select(
        "award_key", "award_id", "awarding_agency", "awarding_sub_agency",
        F.col("recipient_name").alias("incumbent_name"),
        F.col("recipient_uei").alias("incumbent_uei"),
        "description", "has_options_remaining", "set_aside", "extent_competed",
        "number_of_offers_received", "award_amount", "ceiling_value", "annualized_value",
        "start_date", "end_date", "potential_end_date", "days_to_expiry", "in_act_now_window",
        "status", F.lit(fixed.NOTICE_UNKNOWN).alias("notice_out"), "usaspending_url", "as_of_date",
    )


def fct_obligations(stg_transactions: DataFrame, int_niche_filter: DataFrame) -> DataFrame:
    """Every contract action with its award's niche label; an action without an award is not niche.

    Only the keys of niche awards travel to the join; their absence means FALSE. Pass the labels as
    a stored table: adaptive execution splits the actions of a hot award over several tasks when
    both sides of the join come straight from their shuffle.
    """
    niche = int_niche_filter.where("in_niche").select("award_key", F.lit(True).alias("_niche"))
    labelled = stg_transactions.join(niche, "award_key", "left")
    columns = [c for c in stg_transactions.columns if c != "as_of_date"]
    return labelled.select(
        *columns, F.coalesce("_niche", F.lit(False)).alias("in_niche"), "as_of_date")


def _niche_obligations_24m(fct_obligations: DataFrame, key: str) -> DataFrame:
    recent = fct_obligations.where(
        F.col("in_niche") & F.col(key).isNotNull()
        & in_last_months(F.col("action_date"), F.col("as_of_date"), 24))
    return recent.groupBy(key).agg(exact_sum(F.col("obligation_amount")).alias("obligations_24m"))


def _or_zero(total: str) -> Column:
    return F.coalesce(total, F.lit(0.0))


def dim_agencies(fact_awards: DataFrame, fct_obligations: DataFrame) -> DataFrame:
    """One row per awarding sub-agency.

    Awards are first summed per sub-agency and vendor. That spreads a sub-agency holding a large
    part of all awards over many tasks, and the distinct counts and names then run on the
    far smaller per-vendor rows.
    """
    active = F.col("is_active")
    amount = exact(F.col("award_amount"))
    per_vendor = fact_awards.groupBy(
        "awarding_sub_agency", "awarding_agency", "recipient_uei", "recipient_name").agg(
        F.count("*").alias("awards"),
        F.count_if(active).alias("active"),
        F.count_if("in_recompete_window").alias("ending"),
        F.sum(amount).alias("amount"),
        F.sum(F.when(active, amount).otherwise(F.lit(0))).alias("active_amount"),
        F.min("award_date").alias("first"),
        F.max("award_date").alias("last"),
        F.max("as_of_date").alias("as_of"),
    ).withColumn("incumbent", F.when(F.col("active") > 0, F.col("recipient_name")))
    # One string per sub-agency is the result itself; only its distinct names reach one task.
    names = F.collect_set("incumbent")
    agencies = per_vendor.groupBy("awarding_sub_agency").agg(
        F.min("awarding_agency").alias("awarding_agency"),
        F.sum("awards").alias("niche_awards"),
        F.sum("active").alias("active_awards"),
        F.sum("ending").alias("awards_in_recompete_window"),
        F.sum("amount").cast("double").alias("niche_award_amount"),
        F.sum("active_amount").cast("double").alias("active_award_amount"),
        F.min("first").alias("first_award_date"),
        F.max("last").alias("last_award_date"),
        F.countDistinct("recipient_uei").alias("vendors"),
        F.when(F.size(names) > 0, F.array_join(F.array_sort(names), fixed.INCUMBENT_SEPARATOR)).alias("incumbents"),
        F.max("as_of").alias("as_of_date"),
    )
    as_of = F.col("as_of_date")
    status = (
        F.when(in_last_months(F.col("first_award_date"), as_of, 12), "new")
        .when(in_last_months(F.col("last_award_date"), as_of, 12), "active")
        .when(in_last_months(F.col("last_award_date"), as_of, 24), "lapsing")
        .otherwise("lapsed")
    )
    spent = _niche_obligations_24m(fct_obligations, "awarding_sub_agency")
    return agencies.join(spent, "awarding_sub_agency", "left").select(
        *agencies.columns, _or_zero("obligations_24m").alias("obligations_24m"),
        status.alias("agency_status"))


def dim_vendors(fact_awards: DataFrame, fct_obligations: DataFrame,
                keep: Callable[[DataFrame], DataFrame] = lambda vendors: vendors) -> DataFrame:
    """One row per vendor id with niche awards, shown under its newest award's name.

    Summed per vendor and sub-agency first, so a placeholder id shared by many awards is spread.
    ``share_24m`` is the share of the obligations of these vendors; a zero total gives NULL.
    The vendors are read twice, for the total and for the shares: ``keep`` may store them in
    between, so that the awards and actions are read once.
    """
    # Newest award date first, then the smallest award key; no date comes last.
    newest = F.struct(F.coalesce(-F.unix_date("award_date"), F.lit(2**31 - 1)), F.col("award_key"))
    per_agency = fact_awards.where(F.col("recipient_uei").isNotNull()).groupBy(
        "recipient_uei", "awarding_sub_agency").agg(
        F.min(F.struct(newest.alias("place"), F.col("recipient_name").alias("name"))).alias("newest"),
        F.bool_or("is_masked_recipient").alias("masked"),
        F.count("*").alias("awards"),
        F.count_if("is_active").alias("active"),
        F.count_if("in_recompete_window").alias("ending"),
        F.sum(exact(F.col("award_amount"))).alias("amount"),
        F.min("award_date").alias("first"),
        F.max("award_date").alias("last"),
        F.max("as_of_date").alias("as_of"),
    )
    vendors = per_agency.groupBy("recipient_uei").agg(
        F.min("newest")["name"].alias("recipient_name"),
        F.bool_or("masked").alias("is_masked_recipient"),
        F.sum("awards").alias("niche_awards"),
        F.sum("active").alias("active_awards"),
        F.sum("ending").alias("awards_in_recompete_window"),
        F.sum("amount").cast("double").alias("niche_award_amount"),
        # One row per sub-agency is left here; a missing sub-agency is not counted.
        F.count("awarding_sub_agency").alias("sub_agencies_served"),
        F.min("first").alias("first_award_date"),
        F.max("last").alias("last_award_date"),
        F.max("as_of").alias("as_of_date"),
    )
    spent = _niche_obligations_24m(fct_obligations, "recipient_uei")
    valued = keep(vendors.join(spent, "recipient_uei", "left").select(
        *vendors.columns, _or_zero("obligations_24m").alias("obligations_24m")))
    total = valued.agg(exact_sum(F.col("obligations_24m"))).scalar()
    return valued.select("*", F.try_divide("obligations_24m", total).alias("share_24m"))
