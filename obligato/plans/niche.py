"""Niche labels and expiry status."""

from pyspark.sql import Column, DataFrame, functions as F

from obligato import fixed_values as fixed
from obligato.functions.dates import days_between
from obligato.functions.text import matches
from obligato.operators.labels import first_match


def with_description_rules(rows: DataFrame, text: str = "description") -> DataFrame:
    """Adds ``has_recruiting_terms`` and ``description_exclusion`` (NULL = no rule hit).

    The rules read one upper-cased copy of the text. As a lambda argument it is made once per row,
    also where the optimizer moves a filter on the label below other steps.
    """
    def label(upper: Column) -> Column:
        recruiting = matches(upper, fixed.RECRUITING_TERMS)
        return F.struct(
            recruiting.alias("has_recruiting_terms"),
            first_match(upper, fixed.DESCRIPTION_RULES, recruiting).alias("description_exclusion"))

    labels = F.get(F.transform(F.array(F.upper(text)), label), F.lit(0))
    labelled = rows.select("*", labels.alias("_labels"))
    return labelled.select(*rows.columns, "_labels.*")


def int_niche_filter(stg_awards: DataFrame) -> DataFrame:
    """Every award, labelled in or out of the niche with the first reason that excludes it."""
    coded = stg_awards.select(
        "*",
        F.coalesce(F.col("naics_code").isin(fixed.NICHE_NAICS), F.lit(False)).alias("naics_ok"),
        F.coalesce(F.col("psc_code").isin(fixed.NICHE_PSC), F.lit(False)).alias("psc_ok"),
    )
    reason = (
        F.when(~F.col("naics_ok"), "naics")
        .when(~F.col("psc_ok"), "psc")
        .otherwise(F.col("description_exclusion"))
    )
    in_niche = F.col("naics_ok") & F.col("psc_ok") & F.col("description_exclusion").isNull()
    return with_description_rules(coded).select(
        "*", reason.alias("exclusion_reason"), in_niche.alias("in_niche"))


def int_recompete_flags(int_niche_filter: DataFrame, stg_award_details: DataFrame) -> DataFrame:
    """Niche awards with expiry status (by end date only) and the option facts of the detail page.

    Both sides hold one row per award (and day, for all days at once). Taken straight from staging they are
    hashed by it already and the join adds no shuffle; stored models are shuffled once more, narrow as
    they are by then. An award without an end date stays ``active``.
    """
    keys = [c for c in ("as_of_date", "award_key") if c in stg_award_details.columns]
    facts = stg_award_details.select(
        *keys, "potential_end_date", "base_and_all_options_value", "set_aside",
        "extent_competed", "number_of_offers_received", "solicitation_identifier",
    )
    end, as_of = F.col("end_date"), F.col("as_of_date")
    beyond = F.col("potential_end_date") > F.date_add(end, fixed.OPTION_SLACK_DAYS)
    expired, soon, this_year, active = fixed.STATUSES
    status = (
        F.when(end < as_of, expired)
        .when(end <= F.add_months(as_of, 6), soon)
        .when(end <= F.add_months(as_of, 12), this_year)
        .otherwise(active)
    )
    return int_niche_filter.where("in_niche").join(facts, keys, "left").select(
        "*",
        F.coalesce(beyond, F.lit(False)).alias("has_options_remaining"),
        days_between(end, as_of).alias("days_to_expiry"),
        status.alias("status"),
    )
