"""Contract records derived from the given order tables (the mapping is described in FIXTURES.md).

Every order is an award and every line an action. The modulo rules vary values (blanks, NULLs, copies), so that
each rule of the models meets data; some actions come a second time under an award that does not exist, and some
awards are missing on one of the two earlier days, which makes the new and dropped awards of the events. A pull without
faults has no copies, strays, blanks or missing detail pages, and passes the gates and the audit.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DAYS = [dt.date(2001, 7, 25), dt.date(2001, 7, 30), dt.date(2001, 8, 1)]
AS_OF = DAYS[-1]

# At least one text per description rule, override and near miss.
DESCRIPTIONS = [
    "EXECUTIVE SEARCH SERVICES",
    "LinkedIn licenses and job postings",
    "BPA CALL 0008",
    "ELECTRONIC CASE ADJUDICATION",
    "AV SUPPORT SERVICES",
    "COMMERCIAL ADVERTISING CAMPAIGN",
    "RECRUITING ADVERTISING CAMPAIGN",
    "AUDIT SUPPORT FOR HUMAN RESOURCES",
    "IT SUPPORT FOR THE BENEFITS OFFICE",
    "  HEAD HUNT FOR A SYSTEMS SUPPORT DIRECTOR  ",
    "AUDIO-VISUAL AND LIGHTING RENTAL",
    "IGF::CT::IGF MARKETING SUPPORT",
    "CALL # 17\n",
    None,
    "JAVUEL PROGRAM OFFICE",
    "STAFFING SOFTWARE SUBSCRIPTION",
]
CONTRACT_TYPES = ["BPA CALL", "PURCHASE ORDER", "DELIVERY ORDER", "DEFINITIVE CONTRACT", "INDEFINITE DELIVERY"]
PSC = ["R431", "R499", "R408", "R699", "R497", "R701", None]

# Declared schemas spare one inference job per table.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _array(values: list[str | None]) -> str:
    return "array(" + ", ".join("NULL" if v is None else repr(v) for v in values) + ")"


_BUYERS = f"""
  SELECT c_custkey, c_name AS awarding_sub_agency, n_name AS awarding_agency, c_mktsegment
  FROM {{customer}} LEFT JOIN {{nation}} ON n_nationkey = c_nationkey
"""
_CODES = f"""
         CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN '561312'
              WHEN left(o_orderpriority, 1) = '3' THEN '561311'
              WHEN left(o_orderpriority, 1) = '4' THEN '561320' END AS naics_code,
         get({_array(PSC)}, int(o_orderkey % 7)) AS psc_code,
         get({_array(CONTRACT_TYPES)}, int(o_orderkey % 5)) AS contract_award_type
"""
_VENDORS = """
  SELECT s_suppkey, if(s_suppkey % 40 = 0, s_name || ' (Undisclosed)', s_name) AS vendor,
         'UEI' || lpad(string(s_suppkey), 9, '0') AS uei
  FROM {supplier}
"""
_AWARD_ROWS = """
  SELECT *, o_orderkey AS k, date(o_orderdate) AS day,
         CASE WHEN NOT (no = 2 AND o_orderkey % 43 = 0)
              THEN if(o_orderkey % 25 = 0, 0D, o_totalprice) + if(no >= 2 AND o_orderkey % 41 = 0, 1000D, 0D) + 7D * old
         END AS award_amount,
         CASE WHEN o_orderkey % 223 <> 0
              THEN date_add(date(o_orderdate), int(o_orderkey * 37 % 1800 + if(no >= 2 AND o_orderkey % 31 = 0, 365, 0)
                                                   - if(no >= 2 AND o_orderkey % 37 = 0, 10, 0))) END AS end_date
  FROM {orders}
  LATERAL VIEW inline({days}) AS no, snapshot_date
  LATERAL VIEW explode(if({faults} AND o_orderkey % 101 = 0, array(0, 1), array(0))) AS old
  WHERE NOT (no = 1 AND o_orderkey % 53 = 0) AND NOT (no = 2 AND o_orderkey % 59 = 0)
"""
_AWARDS = f"""
  SELECT snapshot_date, 'ORD_' || k AS award_key, 'AW' || k AS award_id,
         if(k % 11 = 0, '\\t ' || vendor || '\\u00a0 ', vendor) AS recipient_name,
         if({{faults}} AND k % 50 = 0, '  ', uei) AS recipient_uei,
         awarding_agency, awarding_sub_agency, award_amount,
         if(k % 3 <> 0, o_totalprice * 0.5D, NULL) AS total_outlays,
         if(k % 211 <> 0, day, NULL) AS start_date, end_date,
         naics_code, 'INDUSTRY ' || naics_code AS naics_description,
         psc_code, 'SERVICE ' || psc_code AS psc_description,
         get({_array(DESCRIPTIONS)}, int(k % 16)) AS description, contract_award_type,
         timestampadd(SECOND, int(k % 86400) - old * 2592000, o_orderdate) AS last_modified_date,
         if(k % 13 <> 0, day, NULL) AS base_obligation_date
  FROM (SELECT *, {_CODES} FROM ({_AWARD_ROWS}))
  LEFT JOIN ({_BUYERS}) ON c_custkey = o_custkey
  LEFT JOIN ({_VENDORS}) ON s_suppkey = k % (SELECT count(*) FROM {{supplier}})
"""
_TRANSACTIONS = f"""
  SELECT snapshot_date, if(stray, 'LOST_', 'ORD_') || l_orderkey AS award_key, 'AW' || l_orderkey AS award_id,
         if(l_linenumber = 1, '0', 'P' || lpad(string(l_linenumber), 5, '0')) AS modification_number,
         date(l_shipdate) AS action_date,
         if(l_linenumber <> 1, l_linestatus, NULL) AS action_type,
         if(l_returnflag = 'R', -l_extendedprice, l_extendedprice) AS obligation_amount,
         if(l_linenumber % 3 <> 0, ' LINE ' || l_linenumber || '\\n', NULL) AS transaction_description,
         vendor AS recipient_name, if(l_partkey % 50 = 0, ' ', uei) AS recipient_uei,
         if(stray, NULL, awarding_agency) AS awarding_agency, if(stray, NULL, awarding_sub_agency) AS awarding_sub_agency,
         contract_award_type, naics_code, psc_code
  FROM (SELECT * FROM {{lineitem}} LATERAL VIEW inline({{days}}) AS no, snapshot_date
        LATERAL VIEW explode(if({{faults}} AND l_orderkey % 97 = 0, array(false, true), array(false))) AS stray
        WHERE date(l_shipdate) <= snapshot_date)
  LEFT JOIN (SELECT o_orderkey, awarding_agency, awarding_sub_agency, {_CODES}
             FROM {{orders}} LEFT JOIN ({_BUYERS}) ON c_custkey = o_custkey) ON o_orderkey = l_orderkey
  LEFT JOIN ({_VENDORS}) ON s_suppkey = l_suppkey
"""
# Lines are put together before they meet their orders, so that they travel without the orders' columns and hot orders
# come as few rows; an order that is there twice counts its lines twice, as a plain join would.
_CLEAN_TRANSACTIONS = f"""
  SELECT 'ORD_' || l_orderkey AS award_key, modification_number,
         CAST(amount * coalesce(held, 1) AS DOUBLE) AS obligation_amount, snapshot_date, 'AW' || l_orderkey AS award_id, action_date,
         action_type, transaction_description, recipient_name, recipient_uei, awarding_agency, awarding_sub_agency,
         contract_award_type, naics_code, psc_code
  FROM (SELECT l_orderkey, snapshot_date, if(l_linenumber = 1, '0', 'P' || lpad(string(l_linenumber), 5, '0')) AS modification_number,
               sum(CAST(if(l_returnflag = 'R', -l_extendedprice, l_extendedprice) AS DECIMAL(18,2))) AS amount,
               min(date(l_shipdate)) AS action_date, min(if(l_linenumber <> 1, l_linestatus, NULL)) AS action_type,
               min(if(l_linenumber % 3 <> 0, ' LINE ' || l_linenumber || '\\n', NULL)) AS transaction_description,
               min(vendor) AS recipient_name, min(if(l_partkey % 50 = 0, ' ', uei)) AS recipient_uei
        FROM (SELECT * FROM {{lineitem}} LATERAL VIEW inline({{days}}) AS no, snapshot_date WHERE date(l_shipdate) <= snapshot_date)
        LEFT JOIN ({_VENDORS}) ON s_suppkey = l_suppkey GROUP BY ALL)
  LEFT JOIN (SELECT o_orderkey, count(*) AS held, min(awarding_agency) AS awarding_agency,
                    min(awarding_sub_agency) AS awarding_sub_agency, min(contract_award_type) AS contract_award_type,
                    min(naics_code) AS naics_code, min(psc_code) AS psc_code
             FROM (SELECT *, {_CODES} FROM {{orders}} LEFT JOIN ({_BUYERS}) ON c_custkey = o_custkey)
             GROUP BY o_orderkey) ON o_orderkey = l_orderkey
"""
_OF_AWARDS = f"{_CLEAN_TRANSACTIONS} LEFT SEMI JOIN (SELECT k FROM ({_AWARD_ROWS})) ON k = l_orderkey"
_DETAILS = f"""
  SELECT snapshot_date, 'ORD_' || k AS award_key, end_date AS current_end_date,
         if({{faults}} AND k % 107 = 0, NULL, date_add(end_date, get(array(0, 15, 30, 365), int(k % 4)) - earlier)) AS potential_end_date,
         award_amount AS obligated_amount, award_amount AS base_exercised_options_value,
         award_amount * 1.5D AS base_and_all_options_value,
         if(k % 2 = 0, ' ', left(c_mktsegment, 3)) AS type_set_aside,
         if(k % 2 = 0, '  ', c_mktsegment) AS type_set_aside_description,
         get(array('FULL AND OPEN', ' ', NULL), int(k % 3)) AS extent_competed_description,
         nullif(k % 9, 0L) AS number_of_offers_received,
         if(k % 5 = 0, '', 'SOL' || k) AS solicitation_identifier
  FROM (SELECT * FROM ({_AWARD_ROWS}) LATERAL VIEW explode(if({{faults}} AND k % 103 = 0, array(0, 5), array(0))) AS earlier
        WHERE old = 0 AND end_date >= snapshot_date AND NOT ({{faults}} AND k % 89 = 0))
  LEFT JOIN {{customer}} ON c_custkey = o_custkey
"""


def _run(spark: SparkSession, sf_dir: str, sql: str, days: list[dt.date], faults: bool) -> DataFrame:
    at = ", ".join(f"struct({DAYS.index(d) + 1}, DATE '{d}')" for d in days)
    used = {name: table(spark, sf_dir, name) for name in SCHEMAS if f"{{{name}}}" in sql}
    return spark.sql(sql.replace("{days}", f"array({at})").replace("{faults}", str(faults).lower()), **used)


def raw_awards(spark: SparkSession, sf_dir: str, days: list[dt.date] = [AS_OF], faults: bool = True) -> DataFrame:
    return _run(spark, sf_dir, _AWARDS, days, faults)


def raw_transactions(spark: SparkSession, sf_dir: str, days: list[dt.date] = [AS_OF], faults: bool = True) -> DataFrame:
    return _run(spark, sf_dir, _TRANSACTIONS, days, faults)


def clean_transactions(spark: SparkSession, sf_dir: str, day: dt.date, with_award: bool = False) -> DataFrame:
    """A day's transactions without faults, the lines of one number as one action: their dollars, and the least value of each
    other column. ``with_award``: only those of awards that the pull holds."""
    return _run(spark, sf_dir, _OF_AWARDS if with_award else _CLEAN_TRANSACTIONS, [day], faults=False)


def raw_award_details(spark: SparkSession, sf_dir: str, days: list[dt.date] = [AS_OF], faults: bool = True) -> DataFrame:
    return _run(spark, sf_dir, _DETAILS, days, faults)


def control_totals(spark: SparkSession, sf_dir: str, day: dt.date = AS_OF) -> DataFrame:
    """An outside party's totals per agency, straight from the given tables and not from our raw rows."""
    bought = (table(spark, sf_dir, "orders")
              .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")))
    shipped = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate").cast("date") <= F.lit(day))
    signed = "CAST(if(l_returnflag = 'R', -l_extendedprice, l_extendedprice) AS DECIMAL(18,2))"
    return shipped.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("n_name").alias("agency")).agg(
        F.expr(f"CAST(sum({signed}) AS DOUBLE)").alias("amount"))


def control_counts(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    """How many awards and contract actions a pull with faults must hold, straight from the given tables."""
    def rows(key: str, n: int) -> Column:
        return F.sum(F.when(F.col(key) % n == 0, 2).otherwise(1))

    shipped = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate").cast("date") <= F.lit(AS_OF))
    return table(spark, sf_dir, "orders").agg(rows("o_orderkey", 101)).scalar(), shipped.agg(rows("l_orderkey", 97)).scalar()
