"""Dashboard aggregates over the flat views."""

from pyspark.sql import DataFrame, Window, functions as F

from obligato import fixed_values as fixed
from obligato.functions.money import exact, exact_sum
from obligato.operators import bitmaps
from obligato.operators.ranking import nth_largest


def _dollars(condition, amount: str):
    return F.coalesce(F.sum(F.when(condition, exact(F.col(amount)))).cast("double"), F.lit(0.0))


def window_kpis(dash_recompetes: DataFrame) -> DataFrame:
    """Counts and dollars ending within 12 and 6 months, and how much has a set-aside reported."""
    soon, reported = F.col("in_6m_window"), F.col("set_aside_reported")
    anyway = F.lit(True)
    totals = dash_recompetes.agg(
        F.count("*").alias("awards_12m"),
        F.count_if(soon).alias("awards_6m"),
        _dollars(anyway, "award_amount").alias("amount_12m"),
        _dollars(soon, "award_amount").alias("amount_6m"),
        F.count_if(reported).alias("set_aside_reported"),
        _dollars(F.col("set_aside") == fixed.SET_ASIDE_MISSING, "award_amount").alias("amount_not_reported"),
    )
    return totals.select(
        "*",
        F.try_divide("set_aside_reported", "awards_12m").alias("set_aside_reported_share"),
        F.try_divide("amount_not_reported", "amount_12m").alias("not_reported_amount_share"),
    )


def expiring_by_month(dash_recompetes: DataFrame) -> DataFrame:
    return dash_recompetes.groupBy("expiry_month").agg(
        F.count("*").alias("awards"), exact_sum(F.col("award_amount")).alias("award_amount"))


def next_to_end(dash_recompetes: DataFrame, n: int) -> DataFrame:
    """The recompete table in end-date order, first ``n`` rows."""
    return dash_recompetes.orderBy("end_date", "award_id").limit(n)


def obligations_by_fy(dash_market: DataFrame) -> DataFrame:
    """Money committed per fiscal year and the change to the fiscal year before it in the table."""
    years = dash_market.groupBy("fiscal_year").agg(
        F.count("*").alias("actions"),
        exact_sum(F.col("obligated_amount")).alias("obligated_amount"),
        F.bool_or("is_current_fy").alias("is_current_fy"),
    )
    before = F.lag("obligated_amount").over(Window.orderBy("fiscal_year"))  # one row per year
    return years.select("*", before.alias("previous_amount")).select(
        "*", F.try_divide(F.col("obligated_amount") - F.col("previous_amount"),
                          F.col("previous_amount")).alias("yoy_change"))


def department_by_fy(dash_market: DataFrame, years: list[int]) -> DataFrame:
    """Department x fiscal year, the other years together and the total, so that no amount is left out.

    The years shown are given, so no job runs to find them.
    """
    year, amount = F.col("fiscal_year"), F.col("obligated_amount")
    other = ~F.coalesce(year.isin(years), F.lit(False))
    return dash_market.groupBy("awarding_department").agg(
        *[exact_sum(F.when(year == y, amount)).alias(f"fy{y}") for y in years],
        exact_sum(F.when(other, amount)).alias("other_years"), exact_sum(amount).alias("all_years"))


def department_drill(dash_market: DataFrame) -> DataFrame:
    """Department totals with the drill to sub-agencies and the grand total, in one pass."""
    return dash_market.rollup("awarding_department", "awarding_sub_agency").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count("*").alias("actions"),
        exact_sum(F.col("obligated_amount")).alias("obligated_amount"))


def top_sub_agencies(dash_market: DataFrame, n: int) -> DataFrame:
    """Sub-agencies with the most money committed in the last 24 months."""
    recent = dash_market.where("in_last_24m").groupBy("awarding_sub_agency").agg(
        exact_sum(F.col("obligated_amount")).alias("obligated_amount"), F.count("*").alias("actions"))
    return recent.orderBy(F.col("obligated_amount").desc(), "awarding_sub_agency").limit(n)


def wins_by_vendor_fy(dash_wins: DataFrame) -> DataFrame:
    return dash_wins.groupBy("recipient_uei", "win_fiscal_year").agg(
        F.count("*").alias("wins"), exact_sum(F.col("award_amount")).alias("award_amount"))


def top_vendors(dim_vendors: DataFrame, n: int) -> DataFrame:
    """Vendors ranked ``n`` or better by recent obligations, ties included, without ranking the rest."""
    floor = nth_largest(dim_vendors, "obligations_24m", n)
    return dim_vendors.where(F.col("obligations_24m") >= floor).select(
        "recipient_uei", "recipient_name", "is_masked_recipient", "obligations_24m", "share_24m")


def top_share(dash_vendor_share: DataFrame) -> DataFrame:
    """Share of the five and fifteen largest vendors."""
    # Shares are ratios of one total; rounding makes their sum independent of task order.
    def share(flag: str):
        return F.round(F.sum(F.when(F.col(flag), F.col("share_24m"))), 6)
    return dash_vendor_share.agg(
        share("is_top5").alias("top5_share"), share("is_top15").alias("top15_share"),
        F.count_if("is_top5").alias("top5_vendors"), F.count_if("is_top15").alias("top15_vendors"))


def niche_funnel(int_niche_filter: DataFrame) -> DataFrame:
    """Awards and dollars left after each cleaning step, one row per step."""
    coded = F.col("naics_ok") & F.col("psc_ok")
    steps = [("pulled", F.lit(True)), ("after_codes", coded), ("niche", F.col("in_niche"))]
    aggregates = [
        column
        for name, kept in steps
        for column in (F.count_if(kept).alias(f"{name}_n"), _dollars(kept, "award_amount").alias(f"{name}_amount"))
    ]
    rows = [
        F.struct(F.lit(i).cast("bigint").alias("step_no"), F.lit(name).alias("step"),
                 F.col(f"{name}_n").alias("awards"), F.col(f"{name}_amount").alias("award_amount"))
        for i, (name, _) in enumerate(steps, 1)
    ]
    return int_niche_filter.agg(*aggregates).select(F.inline(F.array(*rows)))


def exclusion_counts(int_niche_filter: DataFrame) -> DataFrame:
    """Awards and dollars per exclusion reason; a NULL reason is the niche itself."""
    return int_niche_filter.groupBy("exclusion_reason").agg(
        F.count("*").alias("awards"), exact_sum(F.col("award_amount")).alias("award_amount"))


def quality_flags(stg_awards: DataFrame) -> DataFrame:
    return stg_awards.agg(
        F.count("*").alias("awards"),
        F.count_if("is_zero_amount").alias("zero_amount"),
        F.count_if("is_masked_recipient").alias("masked_recipient"))


#: The finest groups whose vendors are kept as bitmaps; distinct vendors of anything wider are merged from them.
VENDOR_GROUPS = ["awarding_department", "awarding_sub_agency", "fiscal_year"]


def vendor_roll_ups(vendor_sets: DataFrame) -> DataFrame:
    """Distinct vendors in all, per department, sub-agency and fiscal year, and per two of them."""
    department, sub_agency, year = VENDOR_GROUPS
    levels = {"all": [], "department": [department], "sub_agency": [department, sub_agency], "year": [year],
              "department_year": [department, year], "sub_agency_year": VENDOR_GROUPS}
    return bitmaps.roll_ups(vendor_sets, levels, VENDOR_GROUPS, "vendors")


def vendors_over_years(vendor_sets: DataFrame, years: int) -> DataFrame:
    """Distinct vendors of each department over so many fiscal years, up to each year it has."""
    return bitmaps.trailing(bitmaps.merged(vendor_sets, ["awarding_department", "fiscal_year"]), ["awarding_department"],
                            "fiscal_year", years, "vendors")
