"""Hand-built raw rows as of 15 May 2023: H rows belong to the niche, Q rows are kept out of it."""

import datetime as dt

from obligato.sources.schemas import RAW_AWARD_DETAILS, RAW_AWARDS, RAW_TRANSACTIONS

DAY = dt.date(2023, 5, 15)


def d(text):
    return dt.date.fromisoformat(text)


def row(schema, values, defaults):
    known = {f.name for f in schema.fields}
    assert set(values) <= known, set(values) - known
    return tuple(values.get(f.name, defaults.get(f.name)) for f in schema.fields)


def award(key, **values):
    start = values.get("start_date", d("2022-11-15"))
    return row(RAW_AWARDS, {"award_key": key, "award_id": f"id {key}", **values}, {
        "snapshot_date": DAY, "recipient_name": "ALDER TALENT", "recipient_uei": "ALDER",
        "awarding_agency": "Ministry of Harbors", "awarding_sub_agency": "Pilot Board",
        "award_amount": 40000.0, "start_date": start, "base_obligation_date": start,
        "end_date": d("2024-02-29"), "naics_code": "561311", "psc_code": "R499",
        "description": "PLACEMENT OF HARBOR CREWS", "contract_award_type": "PURCHASE ORDER",
        "last_modified_date": dt.datetime(2023, 5, 2, 8, 30),
    })


def action(key, modification, day, amount, **values):
    return row(RAW_TRANSACTIONS, {"award_key": key, "modification_number": modification, "action_date": d(day),
                                  "obligation_amount": amount, **values}, {
        "snapshot_date": DAY, "award_id": f"id {key}", "action_type": "C", "recipient_name": "AS ON THE ORDER",
        "recipient_uei": "ALDER", "awarding_agency": "Ministry of Harbors", "awarding_sub_agency": "Pilot Board",
        "contract_award_type": "PURCHASE ORDER", "naics_code": "561311", "psc_code": "R499",
        "transaction_description": "crew placement",
    })


def detail(key, end, potential, **values):
    return row(RAW_AWARD_DETAILS, {"award_key": key, "current_end_date": d(end), "potential_end_date": d(potential),
                                   **values}, {
        "snapshot_date": DAY, "obligated_amount": 31000.0, "base_exercised_options_value": 36000.0})


def vendor(uei, name):
    return {"recipient_uei": uei, "recipient_name": name}


def office(agency, sub_agency):
    return {"awarding_agency": agency, "awarding_sub_agency": sub_agency}


GRID = office("Energy Council", "Grid Desk")
WEATHER = office("Weather Office", "Weather Office")
TRAIL = office("Parks Authority", "Trail Service")
DREDGING = office("Ministry of Harbors", "Dredging Bureau")
BIRCH, CEDAR = vendor("BIRCH", "BIRCH CREWS"), vendor("CEDAR", "CEDAR PARTNERS")

AWARDS = [
    # End dates on both sides of every status limit.
    award("H1", end_date=d("2023-11-15"), start_date=d("2022-09-30"), award_amount=35000.0, **GRID, **BIRCH),
    award("H2", end_date=d("2023-11-16"), start_date=d("2022-05-15"), award_amount=0.0, **GRID,
          **vendor("HIDDEN", "Multiple Recipients")),
    award("H3", end_date=d("2024-05-15")),
    award("H4", end_date=d("2024-05-16"), start_date=d("2021-12-01"), award_amount=12000.0, **WEATHER, **CEDAR),
    award("H5", end_date=d("2023-05-14"), start_date=d("2021-11-15")),
    award("H6", end_date=d("2023-05-15"), start_date=d("2022-05-16"), **DREDGING, **vendor("DOGWOOD", "DOGWOOD HR")),
    award("H7", end_date=d("2021-12-31"), start_date=d("2020-01-01"), award_amount=9000.0, **TRAIL,
          **vendor("ELM", "ELM BROTHERS")),
    # Words of a rule that recruiting words cancel.
    award("H8", description="SYSTEM SUPPORT: STAFFING OF THE LOCKS", award_amount=62500.5),
    award("H9", description="HIRING FAIR FOR EQUIPMENT OPERATORS", **vendor("FIR", "FIR PEOPLE")),
    # One row for each reason to stay outside.
    award("Q1", description="HIREEZ SEATS"),
    award("Q2", description="SOFTWARE FOR RECRUITING"),
    award("Q3", description="STAGE LIGHTING"),
    award("Q4", description="ADVERTISEMENTS IN PORT NEWS"),
    award("Q5", description=" call #7 "),
    award("Q6", naics_code="541611"),
    award("Q7", psc_code="B599"),
    award("Q8", description="ORACLE DATABASE"),
    # An older day.
    award("H1", snapshot_date=d("2023-05-10"), award_amount=7.0),
]
ACTIONS = [
    action("H1", "0", "2022-09-30", 30000.0, **GRID, **BIRCH),
    action("H1", "M1", "2022-10-01", 7500.25, **GRID, **BIRCH),
    action("H1", "M2", "2023-04-03", -2500.25, **GRID, **BIRCH),
    action("H4", "0", "2021-12-01", 12000.0, **WEATHER, **CEDAR),
    action("H7", "0", "2020-01-01", 9000.0, **TRAIL, recipient_uei="ELM"),
    action("Q1", "0", "2023-01-10", 5000.0),
]
DETAILS = [
    detail("H1", "2023-11-15", "2024-11-15", type_set_aside_description="VETERAN FIRM",
           number_of_offers_received=3, base_and_all_options_value=90000.0),
    detail("H2", "2023-11-16", "2023-12-16"),
    detail("H3", "2024-05-15", "2024-06-15"),
    detail("H4", "2024-05-16", "2026-05-16"),
    detail("H6", "2023-05-15", "2023-05-15", type_set_aside_description="LOCAL FIRM"),
    detail("H8", "2024-02-29", "2024-02-29"),
    detail("H9", "2024-02-29", "2024-02-29"),
]


def frames(spark, awards=AWARDS, actions=ACTIONS, details=DETAILS):
    return (spark.createDataFrame(awards, RAW_AWARDS), spark.createDataFrame(actions, RAW_TRANSACTIONS),
            spark.createDataFrame(details, RAW_AWARD_DETAILS))


def keyed(rows, key="award_key"):
    found = {r[key]: r for r in rows.collect()}
    return found
