"""Codes, word patterns, field names and formats that decide the results.

These are facts of the source data and of the business rules, kept together as plain text.
Patterns are written in RE2 syntax; ``functions.text.matches`` gives them the same meaning
in Spark.
"""

# Industry and service codes of the niche.
NICHE_NAICS = ["561311", "561312"]
NICHE_PSC = ["R431", "R499", "R408", "R699", "R497"]

# Contract types, by type code.
CONTRACT_TYPES = {
    "A": "BPA CALL",
    "B": "PURCHASE ORDER",
    "C": "DELIVERY ORDER",
    "D": "DEFINITIVE CONTRACT",
}

# Words that show recruiting work (they cancel the rules marked "override").
RECRUITING_TERMS = r"RECRUIT|SEARCH|HEAD ?HUNT|STAFFING|PLACEMENT|HIRING"

# Description rules in order, first match wins: (reason, pattern, override applies).
DESCRIPTION_RULES = [
    ("software_tool",
     r"LINKEDIN|HIREEZ|POLIHIRE|\bAVUE\b|SALESFORCE|SOFTWARE|LICEN[CS]E|SUBSCRIPTION|HOLOLENS", False),
    ("it_system",
     r"\bIT SUPPORT|SYSTEMS? SUPPORT|\bATRRS\b|\bEFLOW\b|\bERADS\b|ELECTRONIC CASE|\bORACLE\b|\bPRISM\b", True),
    ("av_equipment", r"\bAV\b|AUDIO.?VISUAL|LIGHTING|EQUIPMENT", True),
    ("advertising", r"ADVERTIS", True),
    ("unlabeled_call", r"^\s*(BPA\s+)?CALL\s*#?\s*\d+\s*$", False),
]

# Names that hide the real recipient.
MASKED_RECIPIENT = r"UNDISCLOSED|REDACTED|MULTIPLE RECIPIENTS"

# Statuses, defaults and limits.
STATUSES = ["expired", "expiring_6m", "expiring_12m", "active"]
BASE_MODIFICATION = "0"
SET_ASIDE_MISSING = "NOT REPORTED"
NOTICE_UNKNOWN = "unknown"
OPTION_SLACK_DAYS = 30
DAYS_PER_YEAR = 365.25
LOOKBACK_FISCAL_YEARS = 5
MIN_AWARDS = 50
NICHE_SIZE = (100, 600)
RECONCILE_TOLERANCE = 0.01
INCUMBENT_SEPARATOR = "; "
AWARD_URL_PREFIX = "https://www.usaspending.gov/award/"

# Landed field -> raw column.
AWARD_FIELDS = {
    "generated_internal_id": "award_key",
    "Award ID": "award_id",
    "Recipient Name": "recipient_name",
    "Recipient UEI": "recipient_uei",
    "Awarding Agency": "awarding_agency",
    "Awarding Sub Agency": "awarding_sub_agency",
    "Award Amount": "award_amount",
    "Total Outlays": "total_outlays",
    "Start Date": "start_date",
    "End Date": "end_date",
    "NAICS.code": "naics_code",
    "NAICS.description": "naics_description",
    "PSC.code": "psc_code",
    "PSC.description": "psc_description",
    "Description": "description",
    "Contract Award Type": "contract_award_type",
    "Last Modified Date": "last_modified_date",
    "Base Obligation Date": "base_obligation_date",
}
TRANSACTION_FIELDS = {
    "generated_internal_id": "award_key",
    "Award ID": "award_id",
    "Mod": "modification_number",
    "Action Date": "action_date",
    "Action Type": "action_type",
    "Transaction Amount": "obligation_amount",
    "Transaction Description": "transaction_description",
    "Recipient Name": "recipient_name",
    "Recipient UEI": "recipient_uei",
    "Awarding Agency": "awarding_agency",
    "Awarding Sub Agency": "awarding_sub_agency",
    "Award Type": "contract_award_type",
    "naics_code": "naics_code",
    "product_or_service_code": "psc_code",
}
DETAIL_FIELDS = {
    "generated_unique_award_id": "award_key",
    "period_of_performance.end_date": "current_end_date",
    "period_of_performance.potential_end_date": "potential_end_date",
    "total_obligation": "obligated_amount",
    "base_exercised_options": "base_exercised_options_value",
    "base_and_all_options": "base_and_all_options_value",
    "latest_transaction_contract_data.type_set_aside": "type_set_aside",
    "latest_transaction_contract_data.type_set_aside_description": "type_set_aside_description",
    "latest_transaction_contract_data.extent_competed_description": "extent_competed_description",
    "latest_transaction_contract_data.number_of_offers_received": "number_of_offers_received",
    "latest_transaction_contract_data.solicitation_identifier": "solicitation_identifier",
}
