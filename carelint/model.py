"""The clinical data model and the checks' constants, as plain data.

Everything in this file is a fixed value of the data model (table names, keys, date
columns, code lists, thresholds).  The operators read these specs; none of them holds
logic.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values: tables
TABLES = (
    "CONDITION", "DEATH", "DEATH_CAUSE", "DEMOGRAPHIC", "DIAGNOSIS", "DISPENSING",
    "ENCOUNTER", "ENROLLMENT", "EXTERNAL_MEDS", "HARVEST", "HASH_TOKEN",
    "IMMUNIZATION", "LAB_HISTORY", "LAB_RESULT_CM", "LDS_ADDRESS_HISTORY",
    "MED_ADMIN", "OBS_CLIN", "OBS_GEN", "PAT_RELATIONSHIP", "PCORNET_TRIAL",
    "PRESCRIBING", "PROCEDURES", "PROVIDER", "PRO_CM", "VITAL",
)
CORE_TABLES = ("DEMOGRAPHIC", "ENROLLMENT", "ENCOUNTER", "DIAGNOSIS", "PROCEDURES", "HARVEST")
EHR_TABLES = ("LAB_RESULT_CM", "PRESCRIBING", "VITAL")

# HARVEST columns that may tell whether the source is an EHR, in order of preference,
# and the values that say yes or no.
EHR_HINT_COLUMNS = ("EHR_CAPTURE", "DATA_SOURCE", "DATASOURCE", "CDM_SOURCE", "SOURCE_DATA")
EHR_YES = ("Y", "YES", "TRUE", "1")
EHR_NO = ("N", "NO", "FALSE", "0")

# ---------------------------------------------------------- fixed values: date windows
DATE_COLUMN = {
    "CONDITION": "REPORT_DATE",
    "DEATH": "DEATH_DATE",
    "DIAGNOSIS": "DX_DATE",
    "DISPENSING": "DISPENSE_DATE",
    "ENCOUNTER": "ADMIT_DATE",
    "ENROLLMENT": "ENR_START_DATE",
    "EXTERNAL_MEDS": "EXT_RECORD_DATE",
    "IMMUNIZATION": "VX_RECORD_DATE",
    "LAB_RESULT_CM": "RESULT_DATE",
    "MED_ADMIN": "MEDADMIN_START_DATE",
    "OBS_CLIN": "OBSCLIN_START_DATE",
    "OBS_GEN": "OBSGEN_START_DATE",
    "PRESCRIBING": "RX_ORDER_DATE",
    "PROCEDURES": "PX_DATE",
    "PRO_CM": "PRO_DATE",
    "VITAL": "MEASURE_DATE",
}

# ------------------------------------------------------------------ fixed values: keys
PRIMARY_KEYS = {
    "DEMOGRAPHIC": ("PATID",),
    "ENROLLMENT": ("PATID", "ENR_START_DATE", "ENR_BASIS"),
    "ENCOUNTER": ("ENCOUNTERID",),
    "DIAGNOSIS": ("DIAGNOSISID",),
    "PROCEDURES": ("PROCEDURESID",),
    "VITAL": ("VITALID",),
    "DISPENSING": ("DISPENSINGID",),
    "LAB_RESULT_CM": ("LAB_RESULT_CM_ID",),
    "CONDITION": ("CONDITIONID",),
    "PRO_CM": ("PRO_CM_ID",),
    "PRESCRIBING": ("PRESCRIBINGID",),
    "PCORNET_TRIAL": ("PATID", "TRIALID", "PARTICIPANTID"),
    "DEATH": ("PATID", "DEATH_SOURCE"),
    "DEATH_CAUSE": ("PATID", "DEATH_CAUSE", "DEATH_CAUSE_CODE", "DEATH_CAUSE_TYPE", "DEATH_CAUSE_SOURCE"),
    "MED_ADMIN": ("MEDADMINID",),
    "PROVIDER": ("PROVIDERID",),
    "OBS_CLIN": ("OBSCLINID",),
    "OBS_GEN": ("OBSGENID",),
    "HASH_TOKEN": ("PATID", "TOKEN_ENCRYPTION_KEY"),
    "LDS_ADDRESS_HISTORY": ("ADDRESSID",),
    "IMMUNIZATION": ("IMMUNIZATIONID",),
    "LAB_HISTORY": ("LABHISTORYID",),
    "PAT_RELATIONSHIP": ("PATID_1", "PATID_2", "RELATIONSHIP_TYPE"),
    "EXTERNAL_MEDS": ("EXTMEDID",),
}

PATIENT_CHILDREN = (
    ("ENROLLMENT", "PATID"), ("ENCOUNTER", "PATID"), ("DIAGNOSIS", "PATID"),
    ("PROCEDURES", "PATID"), ("VITAL", "PATID"), ("DISPENSING", "PATID"),
    ("PRESCRIBING", "PATID"), ("LAB_RESULT_CM", "PATID"), ("CONDITION", "PATID"),
    ("PRO_CM", "PATID"), ("PCORNET_TRIAL", "PATID"), ("DEATH", "PATID"),
    ("DEATH_CAUSE", "PATID"), ("MED_ADMIN", "PATID"), ("OBS_CLIN", "PATID"),
    ("OBS_GEN", "PATID"), ("HASH_TOKEN", "PATID"), ("LDS_ADDRESS_HISTORY", "PATID"),
    ("IMMUNIZATION", "PATID"), ("LAB_HISTORY", "PATID"), ("EXTERNAL_MEDS", "PATID"),
    ("PAT_RELATIONSHIP", "PATID_1"), ("PAT_RELATIONSHIP", "PATID_2"),
)
ENCOUNTER_CHILDREN = tuple(
    (t, "ENCOUNTERID")
    for t in ("DIAGNOSIS", "PROCEDURES", "VITAL", "LAB_RESULT_CM", "PRESCRIBING", "MED_ADMIN",
              "OBS_CLIN", "OBS_GEN", "CONDITION", "PRO_CM", "IMMUNIZATION")
)
PROVIDER_CHILDREN = (
    ("ENCOUNTER", "PROVIDERID"), ("DIAGNOSIS", "PROVIDERID"), ("PROCEDURES", "PROVIDERID"),
    ("PRESCRIBING", "RX_PROVIDERID"), ("IMMUNIZATION", "VX_PROVIDERID"),
    ("MED_ADMIN", "MEDADMIN_PROVIDERID"), ("MED_ADMIN", "PROVIDERID"),
    ("OBS_CLIN", "OBSCLIN_PROVIDERID"), ("OBS_CLIN", "PROVIDERID"),
    ("OBS_GEN", "OBSGEN_PROVIDERID"), ("OBS_GEN", "PROVIDERID"),
)
ENCOUNTER_TABLES = (
    "CONDITION", "DIAGNOSIS", "ENCOUNTER", "IMMUNIZATION", "LAB_RESULT_CM", "MED_ADMIN",
    "OBS_CLIN", "OBS_GEN", "PRESCRIBING", "PROCEDURES", "PRO_CM", "VITAL",
)
# Tables whose ENC_TYPE and ADMIT_DATE are copies of the encounter's.
REPLICA_TABLES = ("DIAGNOSIS", "PROCEDURES")

LENGTH_CHECKED_IDS = (
    "PATID", "PATID_1", "PATID_2", "ENCOUNTERID", "PRESCRIBINGID", "PROCEDURESID", "PROVIDERID",
    "MEDADMIN_PROVIDERID", "OBSGEN_PROVIDERID", "OBSCLIN_PROVIDERID", "RX_PROVIDERID", "VX_PROVIDERID",
)

REFRESH_COLUMNS = {
    "DEMOGRAPHIC": "REFRESH_DEMOGRAPHIC_DATE",
    "ENROLLMENT": "REFRESH_ENROLLMENT_DATE",
    "ENCOUNTER": "REFRESH_ENCOUNTER_DATE",
    "DIAGNOSIS": "REFRESH_DIAGNOSIS_DATE",
    "PROCEDURES": "REFRESH_PROCEDURES_DATE",
    "VITAL": "REFRESH_VITAL_DATE",
    "DISPENSING": "REFRESH_DISPENSING_DATE",
    "LAB_RESULT_CM": "REFRESH_LAB_RESULT_CM_DATE",
    "CONDITION": "REFRESH_CONDITION_DATE",
    "PRO_CM": "REFRESH_PRO_CM_DATE",
    "PRESCRIBING": "REFRESH_PRESCRIBING_DATE",
    "PCORNET_TRIAL": "REFRESH_PCORNET_TRIAL_DATE",
    "DEATH": "REFRESH_DEATH_DATE",
    "DEATH_CAUSE": "REFRESH_DEATH_CAUSE_DATE",
    "MED_ADMIN": "REFRESH_MED_ADMIN_DATE",
    "OBS_CLIN": "REFRESH_OBS_CLIN_DATE",
    "OBS_GEN": "REFRESH_OBS_GEN_DATE",
    "PROVIDER": "REFRESH_PROVIDER_DATE",
    "HASH_TOKEN": "REFRESH_HASH_TOKEN_DATE",
    "LDS_ADDRESS_HISTORY": "REFRESH_LDS_ADDRESS_HX_DATE",
    "IMMUNIZATION": "REFRESH_IMMUNIZATION_DATE",
}

# ------------------------------------------------------- fixed values: value vocabulary
UNKNOWN_VALUES = ("NI", "UN", "OT")
INVALID_TOKENS = ("", "NI", "UN", "OT", "NA")
INVALID_TOKEN_PREFIX = "XXX"
FACE_TO_FACE = ("ED", "EI", "IP", "OS", "AV")
VOLUME_ENC_TYPES = ("AV", "ED", "EI", "IP", "TH")
KNOWN_ENC_TYPES = ("AV", "ED", "EI", "IC", "IP", "IS", "OA", "OS", "TH")
OTHER_ENC_TYPE_GROUP = "Missing/NI/UN/OT"
SNAPSHOT_ENC_TYPES = ("AV", "ED", "IP", "OA", "TH")
PRINCIPAL_ENC_TYPES = ("EI", "IP", "IS", "OS")
PRINCIPAL_ORIGINS = ("BI", "CL", "DR", "OD")
INPATIENT_ENC_TYPES = ("IP", "EI")
RESULT_MODIFIERS = ("EQ", "GE", "GT", "LE", "LT", "NE")
PX_PER_ENCOUNTER_MINIMUM = {"AV": 0.75, "ED": 0.75, "EI": 1.0, "IP": 1.0, "TH": None}
EXCLUDED_MONTHS = ("2020-03-01", "2020-04-01")

ZIP_COLUMNS = (
    ("ENCOUNTER", "FACILITY_LOCATION", 5),
    ("LDS_ADDRESS_HISTORY", "ADDRESS_ZIP5", 5),
    ("LDS_ADDRESS_HISTORY", "ADDRESS_ZIP9", 9),
)
NUMERIC_BOUNDS = (
    ("VITAL", "HT", 21, 76),
    ("VITAL", "WT", 0, 350),
    ("VITAL", "DIASTOLIC", 40, 120),
    ("VITAL", "SYSTOLIC", 40, 210),
    ("VITAL", "BMI", 0, 100),
    ("DISPENSING", "DISPENSE_SUP", 1, 90),
)

# RxNorm term types by tier; everything else, and a missing code, is tier 5.
RXNORM_TIERS = {
    "TIER_1": ("SCD", "SBD", "BPCK", "GPCK"),
    "TIER_2": ("SBDF", "SBDFP", "SCDF", "SCDFP", "SBDG", "SCDG", "SCDGP", "SBDC", "BN", "MIN"),
    "TIER_3": ("SCDC", "PIN", "IN"),
    "TIER_4": ("DF", "DFG"),
}
RXNORM_BRAND = ("SBD", "BPCK")

# -------------------------------------------------------- fixed values: checked columns
FUTURE_DATE_COLUMNS = {
    "DEMOGRAPHIC": ("BIRTH_DATE",),
    "ENROLLMENT": ("ENR_START_DATE", "ENR_END_DATE"),
    "ENCOUNTER": ("ADMIT_DATE", "DISCHARGE_DATE"),
    "DIAGNOSIS": ("ADMIT_DATE", "DX_DATE"),
    "PROCEDURES": ("ADMIT_DATE", "PX_DATE"),
    "VITAL": ("MEASURE_DATE",),
    "DISPENSING": ("DISPENSE_DATE",),
    "PRESCRIBING": ("RX_ORDER_DATE",),
    "LAB_RESULT_CM": ("RESULT_DATE",),
    "CONDITION": ("REPORT_DATE", "ONSET_DATE", "RESOLVE_DATE"),
    "DEATH": ("DEATH_DATE",),
    "MED_ADMIN": ("MEDADMIN_START_DATE", "MEDADMIN_STOP_DATE"),
    "OBS_CLIN": ("OBSCLIN_START_DATE", "OBSCLIN_STOP_DATE"),
    "OBS_GEN": ("OBSGEN_START_DATE", "OBSGEN_STOP_DATE"),
    "PRO_CM": ("PRO_DATE",),
    "IMMUNIZATION": ("VX_RECORD_DATE", "VX_ADMIN_DATE"),
    "LDS_ADDRESS_HISTORY": ("ADDRESS_PERIOD_START", "ADDRESS_PERIOD_END"),
    "PAT_RELATIONSHIP": ("RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE"),
    "EXTERNAL_MEDS": ("EXT_RECORD_DATE", "RX_START_DATE", "RX_END_DATE"),
}
SERVICE_DATE_COLUMNS = {
    "ENCOUNTER": ("ADMIT_DATE", "DISCHARGE_DATE"),
    "DIAGNOSIS": ("DX_DATE",),
    "PROCEDURES": ("PX_DATE",),
    "VITAL": ("MEASURE_DATE",),
    "LAB_RESULT_CM": ("RESULT_DATE",),
    "PRESCRIBING": ("RX_ORDER_DATE",),
    "DISPENSING": ("DISPENSE_DATE",),
    "CONDITION": ("REPORT_DATE", "ONSET_DATE", "RESOLVE_DATE"),
    "IMMUNIZATION": ("VX_RECORD_DATE", "VX_ADMIN_DATE"),
    "MED_ADMIN": ("MEDADMIN_START_DATE", "MEDADMIN_STOP_DATE"),
    "OBS_CLIN": ("OBSCLIN_START_DATE", "OBSCLIN_STOP_DATE"),
    "OBS_GEN": ("OBSGEN_START_DATE", "OBSGEN_STOP_DATE"),
    "PRO_CM": ("PRO_DATE",),
    "EXTERNAL_MEDS": ("EXT_RECORD_DATE", "RX_START_DATE", "RX_END_DATE"),
    "PAT_RELATIONSHIP": ("RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE"),
}
START_STOP_COLUMNS = (
    ("EXTERNAL_MEDS", "RX_START_DATE", "RX_END_DATE"),
    ("MED_ADMIN", "MEDADMIN_START_DATE", "MEDADMIN_STOP_DATE"),
    ("OBS_CLIN", "OBSCLIN_START_DATE", "OBSCLIN_STOP_DATE"),
    ("OBS_GEN", "OBSGEN_START_DATE", "OBSGEN_STOP_DATE"),
    ("PAT_RELATIONSHIP", "RELATIONSHIP_START_DATE", "RELATIONSHIP_END_DATE"),
)
KEY_FIELDS = {
    "CONDITION": ("CONDITION", "CONDITIONID", "CONDITION_SOURCE", "CONDITION_TYPE", "PATID"),
    "DEATH": ("DEATH_SOURCE", "PATID"),
    "DEATH_CAUSE": ("DEATH_CAUSE", "DEATH_CAUSE_CODE", "DEATH_CAUSE_SOURCE", "DEATH_CAUSE_TYPE", "PATID"),
    "DEMOGRAPHIC": ("PATID",),
    "DIAGNOSIS": ("DIAGNOSISID", "DX", "DX_SOURCE", "DX_TYPE", "PATID"),
    "DISPENSING": ("DISPENSE_DATE", "DISPENSINGID", "NDC", "PATID"),
    "ENCOUNTER": ("ADMIT_DATE", "ENCOUNTERID", "ENC_TYPE", "PATID"),
    "ENROLLMENT": ("ENR_BASIS", "ENR_START_DATE", "PATID"),
    "EXTERNAL_MEDS": ("EXTMEDID", "PATID"),
    "HARVEST": ("DATAMARTID", "NETWORKID"),
    "HASH_TOKEN": ("PATID", "TOKEN_ENCRYPTION_KEY"),
    "IMMUNIZATION": ("IMMUNIZATIONID", "PATID", "VX_CODE", "VX_CODE_TYPE", "VX_STATUS"),
    "LAB_HISTORY": ("LABHISTORYID", "LAB_LOINC"),
    "LAB_RESULT_CM": ("LAB_RESULT_CM_ID", "PATID", "RESULT_DATE"),
    "LDS_ADDRESS_HISTORY": ("ADDRESSID", "ADDRESS_PREFERRED", "ADDRESS_TYPE", "ADDRESS_USE", "PATID"),
    "MED_ADMIN": ("MEDADMINID", "MEDADMIN_START_DATE", "PATID"),
    "OBS_CLIN": ("OBSCLINID", "OBSCLIN_START_DATE", "PATID"),
    "OBS_GEN": ("OBSGENID", "OBSGEN_START_DATE", "PATID"),
    "PAT_RELATIONSHIP": ("PATID_1", "PATID_2", "RELATIONSHIP_TYPE"),
    "PCORNET_TRIAL": ("PARTICIPANTID", "PATID", "TRIALID"),
    "PRESCRIBING": ("PATID", "PRESCRIBINGID"),
    "PROCEDURES": ("PATID", "PROCEDURESID", "PX", "PX_TYPE"),
    "PROVIDER": ("PROVIDERID",),
    "PRO_CM": ("PATID", "PRO_CM_ID", "PRO_DATE"),
    "VITAL": ("MEASURE_DATE", "PATID", "VITALID", "VITAL_SOURCE"),
}

# --------------------------------------------------------- fixed values: code placement
LOINC_PLACEMENT = (
    # table, code column, expected classes, SQL test that the class is wrong
    ("LAB_RESULT_CM", "LAB_LOINC", "1", "<>", "1"),
    ("LAB_HISTORY", "LAB_LOINC", "1", "<>", "1"),
    ("OBS_CLIN", "OBSCLIN_CODE", "2", "<>", "2"),
    ("OBS_GEN", "OBSGEN_CODE", "2/3/4", "=", "1"),
)
LOINC_PANEL_COLUMNS = (
    ("LAB_RESULT_CM", "LAB_LOINC", None),
    ("OBS_CLIN", "OBSCLIN_CODE", "OBSCLIN_TYPE"),
    ("PRO_CM", "PRO_CODE", "PRO_TYPE"),
)

# -------------------------------------------------------------- fixed values: snapshots
SNAPSHOT_ID_COLUMNS = {
    "DEMOGRAPHIC": "PATID", "ENROLLMENT": "PATID", "ENCOUNTER": "PATID", "DIAGNOSIS": "PATID",
    "PROCEDURES": "PATID", "VITAL": "PATID", "DEATH": "PATID", "PRESCRIBING": "PATID",
    "DISPENSING": "PATID", "LAB_RESULT_CM": "PATID", "CONDITION": "PATID", "DEATH_CAUSE": "PATID",
    "PRO_CM": "PATID", "PROVIDER": "PROVIDERID", "MED_ADMIN": "PATID", "OBS_CLIN": "PATID",
    "OBS_GEN": "PATID", "HASH_TOKEN": "PATID", "IMMUNIZATION": "PATID",
    "LDS_ADDRESS_HISTORY": "PATID", "LAB_HISTORY": "LAB_FACILITYID", "EXTERNAL_MEDS": "PATID",
    "PAT_RELATIONSHIP": "PATID_1",
}
SNAPSHOT_ENC_DOMAINS = ("DIAGNOSIS", "PROCEDURES", "LAB_RESULT_CM", "PRESCRIBING")
SNAPSHOT_CODES = (
    # table, label, category column, code column, categories
    ("DIAGNOSIS", "DIA_L3_DX_DXTYPE", "DX_TYPE", "DX", ("09", "10")),
    ("PROCEDURES", "PRO_L3_PX_PXTYPE", "PX_TYPE", "PX", ("09", "10", "CH", "ND")),
    ("DISPENSING", "DISP_L3_NDC", None, "NDC", ("ND",)),
    ("IMMUNIZATION", "IMMUNE_L3_CODE_CODETYPE", "VX_CODE_TYPE", "VX_CODE", ("CH", "ND", "RX", "CX")),
    ("MED_ADMIN", "MEDADM_L3_CODE_TYPE", "MEDADMIN_TYPE", "MEDADMIN_CODE", ("ND", "RX")),
    ("PRESCRIBING", "PRES_L3_RXCUI", None, "RXNORM_CUI", ("RX",)),
    ("OBS_CLIN", "OBSCLIN_L3_CODE_TYPE", "OBSCLIN_TYPE", "OBSCLIN_CODE", ("LC",)),
    ("PRO_CM", "PROCM_L3_CODE_TYPE", "PRO_TYPE", "PRO_CODE", ("LC",)),
    ("EXTERNAL_MEDS", "EXTMED_L3_RXCUI", None, "RXNORM_CUI", ("RX",)),
)
SNAPSHOT_CODE_NOT_FLAGGED = "09"

# ---------------------------------------------------------------- fixed values: volumes
MONTHLY_SERIES = (
    # table, date column, category column (None: the whole table is one series)
    ("ENCOUNTER", "ADMIT_DATE", "ENC_TYPE"),
    ("DIAGNOSIS", "ADMIT_DATE", "ENC_TYPE"),
    ("PROCEDURES", "ADMIT_DATE", "ENC_TYPE"),
    ("VITAL", "MEASURE_DATE", None),
    ("PRESCRIBING", "RX_ORDER_DATE", None),
    ("LAB_RESULT_CM", "RESULT_DATE", None),
    ("MED_ADMIN", "MEDADMIN_START_DATE", None),
    ("EXTERNAL_MEDS", "EXT_RECORD_DATE", None),
    ("PRO_CM", "PRO_DATE", None),
)
ENCOUNTER_SERIES = ("ENCOUNTER", "DIAGNOSIS", "PROCEDURES")
CLINICAL_SERIES = (("VITAL", "MEASURE_DATE"), ("PRESCRIBING", "RX_ORDER_DATE"), ("LAB_RESULT_CM", "RESULT_DATE"))
MEDICATION_SERIES = (
    ("MED_ADMIN", "MEDADMIN_START_DATE"), ("DISPENSING", "DISPENSE_DATE"), ("OBS_CLIN", "OBSCLIN_START_DATE"),
)

# ----------------------------------------------------------- fixed values: code domains
CODE_DOMAINS = (
    # table, id column, code column, type column (or None), fixed type, types checked
    ("DIAGNOSIS", "DIAGNOSISID", "DX", "DX_TYPE", None, ("09", "10")),
    ("PROCEDURES", "PROCEDURESID", "PX", "PX_TYPE", None, ("CH", "09", "10", "ND")),
    ("PRESCRIBING", "PRESCRIBINGID", "RXNORM_CUI", None, "RX", ("RX",)),
    ("DISPENSING", "DISPENSINGID", "NDC", None, "ND", ("ND",)),
    ("MED_ADMIN", "MEDADMINID", "MEDADMIN_CODE", "MEDADMIN_TYPE", None, ("RX", "ND")),
    ("LAB_RESULT_CM", "LAB_RESULT_CM_ID", "LAB_LOINC", None, "LC", ("LC",)),
    ("CONDITION", "CONDITIONID", "CONDITION", "CONDITION_TYPE", None, ("09", "10")),
    ("IMMUNIZATION", "IMMUNIZATIONID", "VX_CODE", "VX_CODE_TYPE", None, ("CX", "ND", "RX", "CH")),
    ("OBS_GEN", "OBSGENID", "OBSGEN_CODE", "OBSGEN_TYPE", None, ("LC", "SM")),
    ("OBS_CLIN", "OBSCLINID", "OBSCLIN_CODE", "OBSCLIN_TYPE", None, ("LC", "SM")),
)

# Every column that some check reads as a date.
ALL_DATE_COLUMNS = frozenset(
    {"BIRTH_DATE", "DEATH_DATE", "ADMIT_DATE", "DISCHARGE_DATE"} | set(DATE_COLUMN.values()) | set(REFRESH_COLUMNS.values())
    | {c for cs in (*FUTURE_DATE_COLUMNS.values(), *SERVICE_DATE_COLUMNS.values()) for c in cs}
    | {c for _, a, b in START_STOP_COLUMNS for c in (a, b)})
