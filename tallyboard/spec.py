"""Fixed values of the programme: code lists, labels, overrides, thresholds.

Everything here is data the published figures depend on. Operators take these
as arguments, so another programme can pass its own.
"""

from __future__ import annotations

# --- fixed values: record-level columns that are kept at ingest ---------------
RECORD_COLUMNS = [
    "RecordID",
    "AuditID",
    "REPORTING_PERIOD",
    "ODS_CODE",
    "ODS_Name",
    "SETTING_TYPE",
    "ACTIVITY_TYPE",
    "ACTIVITY_DATE",
    "HOSPITAL_SPELL_ID",
    "PREGNANCY_ID",
    "OP_ATTENDANCE_ID",
    "COMMUNITYCARECONTACT_ID",
    "MATERNITYTRANSFER",
    "GENDER",
    "ETHNICITY",
    "SMOKINGSTATUS",
    "SMOKER_ATDELIVERY",
    "SMOKER_AT36WEEKS",
    "INHOUSE_REFERRAL",
    "INHOUSE_REFERRAL_DATE",
    "SEEN_INHOUSE",
    "ATTENDANCE_INHOUSE_DATE",
    "TOBACCODEPENDENCE_CAREPLAN",
    "ONGOINGSUPPORT",
    "OUTCOME_AT28DAYS",
    "PHARMACOTHERAPY_TYPE",
    "GP_PRACTICE_CODE_TRACED",
    "CCG_OF_RESIDENCE",
    "ICS_OF_RESIDENCE",
    "LA_OF_RESIDENCE",
    "LSOA_OF_RESIDENCE",
    "ICS_OF_REGISTRATION",
    "CCG_OF_REGISTRATION",
    "LA_OF_REGISTRATION",
    "LSOA_OF_REGISTRATION",
    "CURRENTVAPING",
    "INTENDEDQUITDATE",
    "NUMBERQUITS",
    "SUPPORTEDQUITATTEMPT",
    "Der_Age_at_CDS_Activity_Date",
    "Der_AgeWks_at_CDS_Activity_Date",
    "Der_Postcode_CCG_Code",
    "Der_Postcode_Constituency_Code",
    "Der_Postcode_Dist_Unitary_Auth",
    "Der_Postcode_Electoral_Ward",
    "Der_Postcode_Local_Auth",
    "Der_Postcode_LSOA_Code",
    "Der_Postcode_MSOA_Code",
    "Der_Postcode_PCT_Code",
    "Der_Postcode_Sector",
    "Der_PostCode_Traced_CCG_Code",
    "Der_PostCode_Traced_Constituency_Code",
    "Der_PostCode_Traced_Dist_Unitary_Auth",
    "Der_PostCode_Traced_Electoral_Ward",
    "Der_PostCode_Traced_Local_Auth",
    "Der_PostCode_Traced_LSOA_Code",
    "Der_PostCode_Traced_MSOA_Code",
    "Der_PostCode_Traced_PCT_Code",
    "Der_PostCode_Traced_Sector",
    "Der_PostCode_Traced_yr2011_LSOA",
    "Der_PostCode_Traced_yr2011_MSOA",
    "Der_Postcode_yr2011_LSOA",
    "Der_Postcode_yr2011_MSOA",
    "pseudo_nhs_number_ncdr",
    "Pseudo_Person_ID_NCDR",
    "DerRfaRecipientAll",
    "CustomerAll",
    "UDALFileID",
    "UDALYear",
    "UDALMonth",
    "UDALDay",
]
RECORD_DATES = ["ACTIVITY_DATE"]
PERSON = "pseudo_nhs_number_ncdr"

# --- fixed values: the one submission known to be wrong ------------------------
KNOWN_BAD = {"ODS_CODE": "RNA", "REPORTING_PERIOD": "TobaccoDependence-08-2022"}

# --- fixed values: commissioner candidates, best first --------------------------
COMMISSIONER_CANDIDATES = [
    "CCG_OF_REGISTRATION",
    "CCG_OF_RESIDENCE",
    "Der_Postcode_CCG_Code",
]

# --- fixed values: keys and labels of the record checks -------------------------
VERSION_KEYS = [PERSON, "HOSPITAL_SPELL_ID", "ACTIVITY_DATE"]
SUBMISSION_KEYS = ["ODS_CODE", "REPORTING_PERIOD"]
DUPLICATE_LABEL = "[Duplicate Record]"
DUMMY_LABEL = "[Dummy Record]"
DATE_LABEL = "[Invalid Activity Date]"
SETTING_LABEL = "[Invalid Setting Type]"
NO_ISSUE = "No DQ Issue Identified"

# --- fixed values: provider overrides (code, name, parent, region) --------------
PROVIDER_OVERRIDES = [
    ("902", "CORNWALL COUNCIL LOCAL AUTHORITY", "QT6", "Y58"),
    ("8J558", "FIRST CONTACT CLINICAL", "QHM", "Y63"),
    ("RV3", None, "QRV", None),
    ("RVN", None, "QUY", None),
    ("RWX", None, "QU9", None),
    ("RXK", None, "QUA", None),
]

# --- fixed values: code -> label maps --------------------------------------------
SERVICE_SETTINGS = [
    (["1", "2"], "All other services"),
    (["3"], "Maternity services"),
]
SERVICE_SETTING_ELSE = "All other services"
# (setting codes, activity codes or None for any, label)
ACTIVITY_TYPES = [
    (["1"], ["1"], "Acute Inpatient"),
    (["1"], ["2"], "Acute Outpatient"),
    (["2"], ["1", "3"], "Mental Health Inpatient"),
    (["2"], ["4"], "Specialist Community Mental Health"),
    (["3"], None, "Maternity"),
]
ACTIVITY_TYPE_ELSE = "Other activity"
GENDERS = [(["1"], "Male"), (["2"], "Female"), (["3"], "Is not stated")]
GENDER_ELSE = "Unknown"
# (from, below, label); 44 is in no band, as published
AGE_BANDS = [
    (None, 18, "Under 18"),
    (18, 35, "18-34"),
    (35, 44, "35-44"),
    (45, 60, "45-59"),
    (60, None, "60 and over"),
]
AGE_ELSE = "Unknown"
ETHNIC_GROUPS = [
    (["A", "B", "C"], "White"),
    (["D", "E", "F", "G"], "Mixed or multiple ethnic groups"),
    (["H", "J", "K", "L"], "Asian or Asian British"),
    (["M", "N", "P"], "Black, African, Caribbean or Black British"),
    (["R", "S"], "Other ethnic group"),
]
ETHNIC_GROUP_ELSE = "Is not stated"
QUINTILES = [
    (["1", "2"], "Quintile 1 - Most deprived"),
    (["3", "4"], "Quintile 2"),
    (["5", "6"], "Quintile 3"),
    (["7", "8"], "Quintile 4"),
    (["9", "10"], "Quintile 5 - Least deprived"),
]
QUINTILE_ELSE = "Unknown"
DEPRIVATION_SNAPSHOT = "2019-12-31"

# --- fixed values: rule and metric definition tables ------------------------------
RECORD_ELEMENT_SOURCE = "Tobacco Patient Level Dataset"
PROPORTION = "Proportion"

# --- fixed values: aggregate columns -> element (id, service setting, activity) -----
AGGREGATE_ELEMENTS = {
    "COMPLETESMOKINGSTATUS_IP": ("001", "All other services", "Acute Inpatient"),
    "COMPLETESMOKINGSTATUS_MATERNITY": ("001", "Maternity services", "Maternity"),
    "COMPLETESMOKINGSTATUS_OP": ("001", "All other services", "Acute Outpatient"),
    "COMPLETESMOKINGSTATUS_MENTALHEALTH_CMHS": (
        "001",
        "All other services",
        "Specialist Community Mental Health",
    ),
    "COMPLETESMOKINGSTATUS_MENTALHEALTH_IP": (
        "001",
        "All other services",
        "Mental Health Inpatient",
    ),
}
# Aggregate columns -> scorecard setting
AGGREGATE_TOTALS = {
    "Physical Acute": [
        "COMPLETESMOKINGSTATUS_IP",
        "COMPLETESMOKINGSTATUS_OP",
        "COMPLETESMOKINGSTATUS_COMMUNITY_IP",
    ],
    "Maternity": ["COMPLETESMOKINGSTATUS_MATERNITY"],
    "Adult Mental Health": [
        "COMPLETESMOKINGSTATUS_MENTALHEALTH_IP",
        "COMPLETESMOKINGSTATUS_MENTALHEALTH_OP",
    ],
}

# --- fixed values: activity counted as element 010 ----------------------------------
ACTIVITY_ELEMENT = "010"
ACUTE_CLASSIFICATION = "1"
ADULT_AGE = 16
EXCLUDED_DISCHARGE_METHODS = ["4", "04"]
EXCLUDED_SPECIALTIES = ["424", "501", "560"]

# --- fixed values: levels of the hierarchy -------------------------------------------
NATIONAL_CODE = "ENG"
NATIONAL_NAME = "England"
MATERNITY_SETTING = "Maternity services"
MATERNITY = "Maternity"

# --- fixed values: scorecard settings and code lists ---------------------------------
# (setting codes, activity codes or None for any, label)
SCORE_SETTINGS = [
    (["1"], ["1", "2", "5"], "Physical Acute"),
    (["2"], None, "Adult Mental Health"),
    (["3"], None, "Maternity"),
]
SCORE_AGES = {
    "Physical Acute": (10, 120),
    "Adult Mental Health": (10, 120),
    "Maternity": (10, 60),
}
# Setting code -> record column that links to that setting's activity source
LINK_COLUMNS = {
    "1": "HOSPITAL_SPELL_ID",
    "2": "HOSPITAL_SPELL_ID",
    "3": "PREGNANCY_ID",
}
FOLLOW_UP_PLANS = ["20", "30", "70", "80", "90"]
LOST_TO_FOLLOW_UP = "4"
CURRENT_STATUS = "1"
COMPLETE = "Complete"

# --- fixed values: scorecard measures (label, type, column, test, threshold) ---------
SCORE_CHECKS = [
    ("Patient Records Submitted", "Count", "Patient_Records", ">=", 10),
    ("Aggregate Records Submitted", "Count", "Aggregate_Records", ">=", 10),
    ("Patient Referrals Submitted", "Count", "Referrals_Count", ">=", 10),
    ("Care Plan Field Complete", "Proportion", "Percent_CarePlan_Complete", ">=", 0.9),
    ("Records Linkable", "Proportion", "Percent_Records_Linkable", ">=", 0.75),
    ("People lost to follow up", "Proportion", "Percent_LTFU", "<=", 0.75),
    ("Age in appropriate range", "Proportion", "Percent_Age_Range", ">=", 0.95),
    ("Reported Smoking Prevalence", "Proportion", "Percent_Prevalence", "<", 0.5),
    ("Reported identification", "Proportion", "Percent_Identification", "<", 1.25),
    ("Smoking Status Complete", "Proportion", "Percent_SmokingStatus_Complete", ">=", 0.95),
]
SCORE_LABEL = "DQ Score"
