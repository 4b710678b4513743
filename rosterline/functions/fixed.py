"""Fixed values of the public registry: code tables, name parts and markers.

Everything here must match the published files and is stated as plain text.
"""

# Snapshot date column, written by the loaders.
SNAPSHOT_DATE = "_input_file_date"

# Archive and member names of the monthly publication.
MONTHLY_ARCHIVE_PREFIX = "NPPES_Data_Dissemination_"
DEACTIVATION_ARCHIVE_PREFIX = "NPPES_Deactivated"
WEEKLY_ARCHIVE_SUFFIX = "_Weekly"
MEMBER_KINDS = ["npidata", "endpoint", "othername", "pl"]
HEADER_MEMBER_SUFFIX = "fileheader.csv"

# Columns of the main file that carry no information.
UNINFORMATIVE_COLUMNS = [
    "replacement_npi",
    "employer_identification_number_ein",
    "npi_deactivation_reason_code",
    "parent_organization_tin",
]

# Other-identifier type codes.
OTHER_ID_TYPES = {
    "01": "OTHER",
    "02": "MEDICARE UPIN",
    "04": "MEDICARE ID-TYPE UNSPECIFIED",
    "05": "MEDICAID",
    "06": "MEDICARE OSCAR/CERTIFICATION",
    "07": "MEDICARE NSC",
    "08": "MEDICARE PIN",
}

# Other-name type codes.
OTHER_NAME_TYPES = {
    "1": "Former Name",
    "2": "Professional Name",
    "3": "Doing Business As",
    "4": "Former Legal Business Name",
    "5": "Other Name",
}

# Fixed values: (npi, packed value as published, packed value as meant).
OTHER_ID_CORRECTIONS = [
    (
        "1699392548",
        "1255972063^01^^NPPES | INDIVIDUAL NPI",
        "1255972063^01^^NPPES  INDIVIDUAL NPI",
    ),
    (
        "1265511885",
        "1032600^01^MA^|MA SOCIAL WORK LICENSE",
        "1032600^01^MA^MA SOCIAL WORK LICENSE",
    ),
    (
        "1033196803",
        "000000379333^^01^MI^ANTHEM|4788534^05^MI^",
        "000000379333^01^MI^ANTHEM|4788534^05^MI^",
    ),
    (
        "1033196803",
        "4788534^05^MI^|000000379333^^01^MI^ANTHEM",
        "4788534^05^MI^|000000379333^01^MI^ANTHEM",
    ),
]

# A street line ends before the first of these.
STREET_END_MARKERS = [
    " STE",
    " SUITE",
    " BLDG",
    " TOWER",
    ", #",
    " UNIT",
    " APT",
    " BUILDING",
    ",",
    "#",
]

# Fixed value: the key of a row without any address part.
EMPTY_ADDRESS_KEY = "|||||"

# Employer size buckets, all strictly greater than the bound.
SIZE_BUCKETS = [
    (5000, "5000+"),
    (1000, "1000+"),
    (500, "500+"),
    (100, "100+"),
    (50, "50+"),
    (10, "10+"),
    (5, "5+"),
    (1, "1+"),
]
SMALLEST_BUCKET = "sole"

# Column names of the main file's two addresses.
PRACTICE_COLUMNS = {
    "line1": "provider_first_line_business_practice_location_address",
    "line2": "provider_second_line_business_practice_location_address",
    "city": "provider_business_practice_location_address_city_name",
    "state": "provider_business_practice_location_address_state_name",
    "postal_code": "provider_business_practice_location_address_postal_code",
    "country": "provider_business_practice_location_address_country_code_if_outside_us",
}
MAILING_COLUMNS = {
    "line1": "provider_first_line_business_mailing_address",
    "line2": "provider_second_line_business_mailing_address",
    "city": "provider_business_mailing_address_city_name",
    "state": "provider_business_mailing_address_state_name",
    "postal_code": "provider_business_mailing_address_postal_code",
    "country": "provider_business_mailing_address_country_code_if_outside_us",
}

# Column names of the secondary-location file.
PL_COLUMNS = {
    "line1": "provider_secondary_practice_location_address_address_line_1",
    "line2": "provider_secondary_practice_location_address__address_line_2",
    "city": "provider_secondary_practice_location_address__city_name",
    "state": "provider_secondary_practice_location_address__state_name",
    "postal_code": "provider_secondary_practice_location_address__postal_code",
    "country": "provider_secondary_practice_location_address__country_code_if_outside_us",
}

# Columns whose changes are published, for persons and organisations together.
CHANGE_COLUMNS = [
    "provider_last_name_legal_name",
    "provider_first_name",
    "provider_middle_name",
    "provider_name_prefix_text",
    "provider_name_suffix_text",
    "provider_credential_text",
    "provider_other_last_name",
    "provider_other_first_name",
    "provider_other_middle_name",
    "provider_other_name_prefix_text",
    "provider_other_name_suffix_text",
    "provider_other_credential_text",
    "provider_other_last_name_type_code",
    "provider_organization_name_legal_business_name",
    "provider_other_organization_name",
    "provider_other_organization_name_type_code",
    "provider_first_line_business_mailing_address",
    "provider_second_line_business_mailing_address",
    "provider_business_mailing_address_city_name",
    "provider_business_mailing_address_state_name",
    "provider_business_mailing_address_postal_code",
    "provider_business_mailing_address_country_code_if_outside_us",
    "provider_business_mailing_address_telephone_number",
    "provider_business_mailing_address_fax_number",
    "provider_first_line_business_practice_location_address",
    "provider_second_line_business_practice_location_address",
    "provider_business_practice_location_address_city_name",
    "provider_business_practice_location_address_state_name",
    "provider_business_practice_location_address_postal_code",
    "provider_business_practice_location_address_country_code_if_outside_us",
    "provider_business_practice_location_address_telephone_number",
    "provider_business_practice_location_address_fax_number",
    "provider_enumeration_date",
    "last_update_date",
    "npi_reactivation_date",
    "provider_gender_code",
    "is_sole_proprietor",
    "authorized_official_last_name",
    "authorized_official_first_name",
    "authorized_official_middle_name",
    "authorized_official_title_or_position",
    "authorized_official_telephone_number",
    "is_organization_subpart",
    "parent_organization_lbn",
    "authorized_official_name_prefix_text",
    "authorized_official_name_suffix_text",
    "authorized_official_credential_text",
    "certification_date",
    "healthcare_provider_taxonomies",
    "other_provider_identifiers",
    "healthcare_provider_taxonomy_groups",
    "_input_file_date",
]
