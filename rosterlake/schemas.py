"""Names, types and fixed lookup values of the data the jobs read.

Everything in this module that is a literal list or mapping is a fixed value:
official column headers, code lists and their meaning.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- registry

# Official header of each single-valued registry attribute.
SINGLE_HEADERS = {
    "entity": "Entity Type Code",
    "lastupdate": "Last Update Date",
    "pcredential": "Provider Credential Text",
    "pcredentialoth": "Provider Other Credential Text",
    "plocline1": "Provider First Line Business Practice Location Address",
    "plocline2": "Provider Second Line Business Practice Location Address",
    "ploccityname": "Provider Business Practice Location Address City Name",
    "plocstatename": "Provider Business Practice Location Address State Name",
    "ploczip": "Provider Business Practice Location Address Postal Code",
    "ploctel": "Provider Business Practice Location Address Telephone Number",
    "pfname": "Provider First Name",
    "pmname": "Provider Middle Name",
    "plname": "Provider Last Name (Legal Name)",
    "pnamesuffix": "Provider Name Suffix Text",
    "pgender": "Provider Gender Code",
    "pfnameoth": "Provider Other First Name",
    "pmnameoth": "Provider Other Middle Name",
    "plnameoth": "Provider Other Last Name",
    "pnamesuffixoth": "Provider Other Name Suffix Text",
    "penumdate": "Provider Enumeration Date",
    "porgname": "Provider Organization Name (Legal Business Name)",
    "porgnameoth": "Provider Other Organization Name",
    "porgnameothcode": "Provider Other Organization Name Type Code",
    "npideactdate": "NPI Deactivation Date",
    "npireactdate": "NPI Reactivation Date",
    "orgsubpart": "Is Organization Subpart",
    "parent_org_lbn": "Parent Organization LBN",
    "soleprop": "Is Sole Proprietor",
    "replacement_npi": "Replacement NPI",
}

# Headers in the secondary-location files.
SECONDARY_HEADERS = {
    "ploc2line1": "Provider Secondary Practice Location Address- Address Line 1",
    "ploc2line2": "Provider Secondary Practice Location Address-  Address Line 2",
    "ploc2cityname": "Provider Secondary Practice Location Address - City Name",
    "ploc2statename": "Provider Secondary Practice Location Address - State Name",
    "ploc2zip": "Provider Secondary Practice Location Address - Postal Code",
    "ploc2tel": "Provider Secondary Practice Location Address - Telephone Number",
}

# Header stem and slot count of each repeated attribute.
SLOT_STEMS = {
    "ptaxcode": ("Healthcare Provider Taxonomy Code", 15),
    "PTAXGROUP": ("Healthcare Provider Taxonomy Group", 15),
    "PPRIMTAX": ("Healthcare Provider Primary Taxonomy Switch", 15),
    "PLICNUM": ("Provider License Number", 15),
    "PLICSTATE": ("Provider License Number State Code", 15),
    "OTHPID": ("Other Provider Identifier", 50),
    "OTHPIDISS": ("Other Provider Identifier Issuer", 50),
    "OTHPIDST": ("Other Provider Identifier State", 50),
    "OTHPIDTY": ("Other Provider Identifier Type Code", 50),
}

DATE_VARIABLES = ["lastupdate", "penumdate", "npideactdate", "npireactdate"]
LONG_VARIABLES = ["entity", "porgnameothcode", "replacement_npi", "OTHPIDTY"]


def slot_headers(variable: str) -> list[str]:
    stem, n = SLOT_STEMS[variable]
    return [f"{stem}_{i}" for i in range(1, n + 1)]


def headers_of(variable: str) -> list[str]:
    if variable in SLOT_STEMS:
        return slot_headers(variable)
    return [{**SINGLE_HEADERS, **SECONDARY_HEADERS}[variable]]


def variable_type(variable: str) -> T.DataType:
    if variable in DATE_VARIABLES:
        return T.DateType()
    if variable in LONG_VARIABLES:
        return T.LongType()
    return T.StringType()


def is_multi(variable: str) -> bool:
    return variable in SLOT_STEMS or variable in SECONDARY_HEADERS


def panel_schema(variable: str) -> T.StructType:
    fields = [T.StructField("npi", T.LongType(), False)]
    if is_multi(variable):
        fields.append(T.StructField("seq", T.IntegerType()))
    fields += [T.StructField(variable, variable_type(variable)),
               T.StructField("month", T.DateType(), False)]
    return T.StructType(fields)


PANEL_VARIABLES = [*SINGLE_HEADERS, *SLOT_STEMS, *SECONDARY_HEADERS]

# Credential text (no periods, no spaces, upper case) to category.
CREDENTIALS = {
    "MD/DO": ["MD", "DO"],
    "PA": ["PA-C", "PA", "PAC", "PHYSICIANASSISTANT", "RPA-C", "MPAS"],
    "NP": ["NP", "FNP", "ARNP", "FNP-C", "CRNP", "FNP-BC", "CNP", "NP-C", "DNP", "CPNP"],
    "Other APRN": ["APN", "APRN"],
    "CRNA": ["CRNA"],
    "CNM": ["CNM"],
    "CNS": ["CNS"],
    "Chiropractor": ["DC"],
    "Dentist": ["DDS", "DMD"],
    "Podiatrist": ["DPM"],
    "Pharmacist": ["PHARMD", "RPH", "PHARMACIST", "DPH", "BCPS"],
    "Optometrist": ["OD"],
    "Psychologist": ["PSYD", "PSYCHOLOGIST"],
    "RN": ["RN", "REGISTEREDNURSE", "RN-BC", "RNFA", "RNBSN", "RNC"],
    "LPN/LVN": ["LPN", "LVN", "LICENSEDPRACTICALN", "PRACTICALNURSE",
                "LICENSEDVOCATIONAL", "LVNII", "LPN-IV", "LPN-M-IV",
                "LICENSEPRACTICALNU", "NURSELPN", "LPNII", "LPNNURSE",
                "LPNM-IV", "LPN/LVN"],
}

# Practitioner types, in report order.
PRACTITIONER_TYPES = [
    "MD/DO", "Dentist", "Psychologist", "Podiatrist", "Optometrist", "Chiropractor",
    "Pharmacist", "NP", "CNM", "CNS", "CRNA", "Other APRN", "PA", "RN", "LPN/LVN",
    "Other Nurse", "Student", "No Category",
]

# What puts a taxonomy code into a category. A later rule wins.
NURSING_TYPES = ["Nursing Service Providers", "Nursing Service Related Providers"]
STUDENT_CODE = "390200000X"
OTHER_APRN_CODE = "367H00000X"
CLASSIFICATION_CATEGORIES = {
    "Physician Assistant": "PA",
    "Nurse Practitioner": "NP",
    "Nurse Anesthetist, Certified Registered": "CRNA",
    "Advanced Practice Midwife": "CNM",
    "Clinical Nurse Specialist": "CNS",
    "Chiropractor": "Chiropractor",
    "Dentist": "Dentist",
    "Podiatrist": "Podiatrist",
    "Pharmacist": "Pharmacist",
    "Optometrist": "Optometrist",
    "Psychologist": "Psychologist",
}
PHYSICIAN_TYPE = "Allopathic & Osteopathic Physicians"
PRACTICAL_NURSE = ["Licensed Practical Nurse", "Licensed Vocational Nurse"]
REGISTERED_NURSE = "Registered Nurse"

# A month whose snapshot is known to be faulty.
BAD_MONTH = "2011-03-01"

# --------------------------------------------------------------- directory

# The 41 directory columns in file order, and our name for each.
DIRECTORY_COLUMNS = {
    "NPI": "npi",
    "PAC ID": "pac_id",
    "Professional Enrollment ID": "enrollment_id",
    "Last Name": "last_name",
    "First Name": "first_name",
    "Middle Name": "middle_name",
    "Suffix": "suffix",
    "Gender": "gender",
    "Credential": "credential",
    "Medical school name": "medical_school",
    "Graduation year": "graduation_year",
    "Primary specialty": "primary_specialty",
    "Secondary specialty 1": "secondary_specialty_1",
    "Secondary specialty 2": "secondary_specialty_2",
    "Secondary specialty 3": "secondary_specialty_3",
    "Secondary specialty 4": "secondary_specialty_4",
    "All secondary specialties": "all_secondary_specialties",
    "Organization legal name": "org_name",
    "Group Practice PAC ID": "group_id",
    "Number of Group Practice members": "group_size",
    "Line 1 Street Address": "line_1",
    "Line 2 Street Address": "line_2",
    "Marker of address line 2 suppression": "line_2_suppressed",
    "City": "city",
    "State": "state",
    "Zip Code": "zip",
    "Phone Number": "phone",
    "Hospital affiliation CCN 1": "hospital_ccn_1",
    "Hospital affiliation LBN 1": "hospital_lbn_1",
    "Hospital affiliation CCN 2": "hospital_ccn_2",
    "Hospital affiliation LBN 2": "hospital_lbn_2",
    "Hospital affiliation CCN 3": "hospital_ccn_3",
    "Hospital affiliation LBN 3": "hospital_lbn_3",
    "Hospital affiliation CCN 4": "hospital_ccn_4",
    "Hospital affiliation LBN 4": "hospital_lbn_4",
    "Hospital affiliation CCN 5": "hospital_ccn_5",
    "Hospital affiliation LBN 5": "hospital_lbn_5",
    "Professional accepts Medicare Assignment": "accepts_assignment",
    "Reported Quality Measures": "reported_quality",
    "Used electronic health records": "used_ehr",
    "Committed to heart health through the Million Hearts initiative": "million_hearts",
}

# Short headers used by later vintages.
DIRECTORY_SHORT = {
    "Ind_PAC_ID": "pac_id", "Ind_enrl_ID": "enrollment_id", "lst_nm": "last_name",
    "frst_nm": "first_name", "mid_nm": "middle_name", "suff": "suffix", "gndr": "gender",
    "Cred": "credential", "Med_sch": "medical_school", "Grd_yr": "graduation_year",
    "Pri_spec": "primary_specialty", "Sec_spec_1": "secondary_specialty_1",
    "Sec_spec_2": "secondary_specialty_2", "Sec_spec_3": "secondary_specialty_3",
    "Sec_spec_4": "secondary_specialty_4", "Sec_spec_all": "all_secondary_specialties",
    "Org_lgl_nm": "org_name", "org_nm": "org_name", "Org_PAC_ID": "group_id",
    "num_org_mem": "group_size", "adr_ln_1": "line_1", "adr_ln_2": "line_2",
    "ln_2_sprs": "line_2_suppressed", "cty": "city", "st": "state", "zip": "zip",
    "phn_numbr": "phone", "assgn": "accepts_assignment",
    **{f"hosp_afl_{i}": f"hospital_ccn_{i}" for i in range(1, 6)},
    **{f"hosp_afl_lbn_{i}": f"hospital_lbn_{i}" for i in range(1, 6)},
    **{f"Claims based hospital affiliation {k} {i}": f"hospital_{k.lower()}_{i}"
       for k in ("CCN", "LBN") for i in range(1, 6)},
}

DIRECTORY_LONGS = ["npi", "graduation_year", "group_id", "group_size"]

# ------------------------------------------------------------------ claims

# Header variants of the Part B files and the columns they mean.
# A header also matches after trimming.
PART_B_HEADERS = {
    "National Provider Identifier": ["National Provider Identifier", "NPI"],
    "Last Name/Organization Name of the Provider": [
        "Last Name/Organization Name", "Last Name/Organization Name of the Provider",
        "NPPES Provider Last Name / Organization Name"],
    "First Name of the Provider": [
        "First Name", "First Name of the Provider", "NPPES Provider First Name"],
    "Middle Initial of the Provider": [
        "Middle Initial", "Middle Initial of the Provider", "NPPES Provider Middle Initial"],
    "Credentials of the Provider": [
        "Credentials", "Credentials of the Provider", "NPPES Credentials"],
    "Gender of the Provider": [
        "Gender", "Gender of the Provider", "NPPES Provider Gender"],
    "Entity Type of the Provider": [
        "Entity Code", "Entity Type of the Provider", "NPPES Entity Code"],
    "Street Address 1 of the Provider": [
        "Street Address 1", "Street Address 1 of the Provider",
        "NPPES Provider Street Address 1"],
    "Street Address 2 of the Provider": [
        "Street Address 2", "Street Address 2 of the Provider",
        "NPPES Provider Street Address 2"],
    "City of the Provider": ["City", "City of the Provider", "NPPES Provider City"],
    "Zip Code of the Provider": [
        "Zip Code", "Zip Code of the Provider", "NPPES Provider Zip Code"],
    "State Code of the Provider": [
        "State Code", "State Code of the Provider", "NPPES Provider State"],
    "Country Code of the Provider": [
        "Country Code", "Country Code of the Provider", "NPPES Provider Country"],
    "Provider Type": ["Provider Type", "Provider Type of the Provider"],
    "Medicare Participation Indicator": [
        "Medicare Participation", "Medicare Participation Indicator"],
    "Place of Service": ["Place of Service"],
    "HCPCS Code": ["HCPCS_CODE", "HCPCS Code"],
    "HCPCS Description": ["HCPCS_DESCRIPTION", "HCPCS Description"],
    "HCPCS Drug Indicator": [
        "HCPCS_DRUG_INDICATOR", "HCPCS Drug Indicator",
        "Identifies HCPCS As Drug Included in the ASP Drug List"],
    "Number of Services": ["LINE_SRVC_CNT", "Number of Services"],
    "Number of Medicare Beneficiaries": [
        "BENE_UNIQUE_CNT", "Number of Medicare Beneficiaries",
        "Number of Unique Beneficiaries"],
    "Number of Distinct Medicare Beneficiary/Per Day Services": [
        "BENE_DAY_SRVC_CNT", "Number of Distinct Medicare Beneficiary/Per Day Services",
        "Number of Medicare Beneficiary/Day Services"],
    "Average Medicare Allowed Amount": [
        "AVERAGE_MEDICARE_ALLOWED_AMT", "Average Medicare Allowed Amount"],
    "Average Submitted Charge Amount": [
        "AVERAGE_SUBMITTED_CHRG_AMT", "Average Submitted Charge Amount"],
    "Standard Deviation of Submitted Charge Amount": [
        "STDEV_SUBMITTED_CHRG_AMT", "Standard Deviation of Submitted Charge Amount"],
    "Average Medicare Payment Amount": [
        "AVERAGE_MEDICARE_PAYMENT_AMT", "Average Medicare Payment Amount"],
    "Standard Deviation of Medicare Payment Amount": [
        "STDEV_MEDICARE_PAYMENT_AMT", "Standard Deviation of Medicare Payment Amount"],
    "Average Medicare Standardized Amount": ["Average Medicare Standardized Amount"],
    "Standard Deviation of Medicare Allowed Amount": [
        "STDEV_MEDICARE_ALLOWED_AMT", "Standard Deviation of Medicare Allowed Amount"],
    "Total Submitted Charge Amount": ["Total Submitted Charges"],
    "Number of Medicare Beneficiaries With Drug Services": [
        "Number of Unique Beneficiaries With Drug Services"],
    "Total Drug Submitted Charge Amount": ["Total Drug Submitted Charges"],
    "Number of Medicare Beneficiaries With Medical Services": [
        "Number of Unique Beneficiaries With Medical Services"],
    "Total Medical Submitted Charge Amount": ["Total Medical Submitted Charges"],
    "Number of Beneficiaries Age Less 65": ["Number of Beneficiaries Age Less than 65"],
}

# ------------------------------------------------------------ licence list

# Name endings that are credentials or suffixes, in test order.
NAME_ENDINGS = [
    "(JR.)", "(M.D.)", "(RET.)", "M., PH", "M. D.", "M.D.,", "M.D., PHD, DABA,",
    "M .D.", "M.D.", "MD", "NP", "D.O.", "PA", "DO", ".D.", "MPH", "PH.D.", "JR",
    "M.D", "PHD", "P.A.", "FNP", "PA-C", "M.P.H.", "N.P.", "III", "SR.", "D.", ".D",
    "FASAM", "JR.", "MS", "D", "FAAFP", "SR", "D.O", "CNS", "F.A.S.A.M.", "FNP-BC",
    "P.C.", "MBA", "M.S.", "PH.D", "FACP", "M.P.H", "CNM", "NP-C", "MR.", "MDIV",
    "FACEP", "PLLC", "M.A.", "LLC", "MR", "DNP", "PHD.", "FNP-C", "MD.", "CNP",
    "J.D.", "IV", "F.A.P.A.", "DR.", "M.D,", "DABPM", "M,D.", "MS.", "FACOOG", "APRN",
]
GENERATION_SUFFIXES = ["JR", "III", "II", "SR", "IV"]
NEVER_END_SUFFIXES = ["JR", "III", "VIII"]
WAIVER_LIMITS = {30: "date_30", 100: "date_100", 275: "date_275"}

# Types used by the linkage, and its tiers.
LINK_TYPES = ["MD/DO", "NP", "PA", "CRNA", "CNM", "CNS"]
CHAINED_TIERS = [
    ["practitioner_type", "state", "zip5", "tel"],
    ["practitioner_type", "state", "tel"],
    ["practitioner_type", "state", "zip5"],
    ["practitioner_type", "state"],
    ["state", "zip5", "tel"],
]
OPEN_BRANCHES = [["state", "tel"], ["state", "zip5"]]
MIDDLE_NAME_BRANCHES = [["state"], ["practitioner_type"], []]

# Words dropped inside parentheses in last and first names.
LAST_NAME_NOISE = [
    "FORMERLY", "MAIDEN NAME", "DIDN'T HAVE LAST NAME", "-MAIDEN", "MAIDEN",
    "CHANGE FROM", "BIRTH", "NEW NAME", "MARRIED NAME", "MARRIED", "SOLE PROPRIETOR",
    "PREVIOUSLY", "CURRENT NAME", "PREVIOUS NAME", "AND ALSO, ", "CHANGED FROM",
    "ALSO", " - USED BOTH",
]
LAST_NAME_TAIL_NOISE = [",1ST MARRIED-", "-FORMER MARRIAGE"]
FIRST_NAME_NOISE = ["LEGAL NAME", "408", "510"]

# Quarters missing from the directory, filled from the next one.
QUARTER_BACKFILL = [
    ("2013-04-01", "2013-01-01"),
    ("2015-04-01", "2015-01-01"),
    ("2016-04-01", "2016-01-01"),
    ("2017-04-01", "2017-01-01"),
    ("2019-10-01", "2019-07-01"),
]

# Ranges of made ids, so that an id tells which rule made it.
ID_BY_PHONE_PLACE = 100_000_000_000
ID_BY_PERSON_PLACE = 200_000_000_000
ID_BY_REGISTRY_PLACE = 300_000_000_000
ID_BY_LOCATION = 900_000_000_000
