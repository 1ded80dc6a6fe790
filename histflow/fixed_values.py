"""The names, codes, dates and patterns results depend on."""

# --- fixed values: business unit codes -------------------------------------
BUSINESS_UNITS = {
    "Third_Party": "3PY",
    "Caremark": "PBM",
    "Aetna": "HCB",
}

# --- fixed values: open-ended dates ----------------------------------------
LOW_DATE = "1900-01-01"
HIGH_DATE = "9999-12-31"
OPEN_END = "9999-12-31 00:00:00"

# --- fixed values: constant columns ----------------------------------------
SOURCE_SYSTEM = "PCT"
UPDATED_BY = "PCT GCP Integration User"
NULL_TEXT = "X"

# --- fixed values: validation statuses -------------------------------------
PASS = "PASS"
FAIL_NOT_NULL = "FAIL_NOT_NULL"
FAIL_DATATYPE = "FAIL_DATATYPE"
FAIL_VALID_VALUE = "FAIL_VALID_VALUE"
REQUIRED_CUSTOMER_COLUMNS = [
    "sgk_customer_id",
    "source_system_cd",
    "business_unit_cd",
    "insert_dts",
    "record_hash_key_id",
    "business_effective_dt",
    "business_expiration_dt",
    "record_start_dts",
    "record_end_dts",
    "active_record_ind",
    "customer_id",
    "customer_nm",
    "sf_account_id",
]
DUPLICATE_CUSTOMER_KEYS = ["customer_id", "customer_nm", "sf_account_id"]
PLATFORM_FLAG_VALUES = ["true", "false"]

# --- fixed values: columns of the account-structure hashes ------------------
ACCOUNT_BUSINESS_HASH = ["customer_id", "business_unit_cd", "line_of_business_cd"]
ACCOUNT_BUSINESS_KEY = ["customer_id", "plan_sponsor_unique_id", "sf_group_census_id"]
ACCOUNT_RECORD_HASH = [
    "source_system_cd",
    "business_unit_cd",
    "line_of_business_cd",
    "plan_sponsor_unique_id",
    "account_status_cd",
    "sf_group_census_id",
]

# --- fixed values: attribute category -> document column --------------------
CATEGORIES = {
    "Program Rules": "program_rules",
    "Billing": "billing_detail",
    "Product Level": "product_level",
    "Client Type": "client_type",
    "Assigned Owner & Contact Information": "assigned_owner_contact_info",
    "Client Contract": "client_contract",
    "Account Management": "account_management",
    "ROI/PGs": "ROI_performance_guarantees",
    "Implementation": "product_implementation",
    "Reporting": "reporting_detail",
}
# Categories rolled up with cleaned keys when the others are kept raw.
KEYED_CATEGORIES = ["Program Rules", "Billing"]
LIST_KEYS = ["Contracted_LOB_Sub_Category"]

# --- fixed values: attribute fields -----------------------------------------
CATEGORY_PATH = "$.Attribute_Category__c"
NAME_PATH = "$.AttributeName__c"
VALUE_PATH = "$.Attribute_Value__c"
ENVELOPE_PATHS = {
    "Client_External_Id__c": "$.Client_External_Id__c",
    "Configured_Product__c": "$.Configured_Product__c",
    "Grouper_ID__c": "$.Grouper_ID__c",
    "line_of_business": "$.line_of_business",
    "LastModifiedBy": "$.LastModifiedBy.Name.value",
}
ENVELOPE_KEYS = [
    "Attribute_Category__c",
    "Client_External_Id__c",
    "Configured_Product__c",
    "Grouper_ID__c",
    "Product_Association_ID",
    "line_of_business",
    "LastModifiedBy",
]

# --- fixed values: child collection -> document column ----------------------
CHILDREN = {
    "HEDISs__r": "HEDIS_client_to_metric",
    "Activity_Rules__r": "activity_rule",
    "Engagement_Rules__r": "engagement_rule",
    "Reactivation_Rules__r": "reactivation_rule",
    "CCNLs__r": "care_connection_newsletter",
    "Fulfillments__r": "fulfillment",
    "Program_Flips__r": "program_flip_client_spinoff",
    "IVRs__r": "interactive_voice_response",
    "Phone_Search__r": "phone_search",
    "Concurrent_Enrollment__r": "concurrent_enrollment",
    "SMS_Campaigns__r": "sms_campaign",
    "Email_Campaigns__r": "email_campaign",
    "Health_Optimizers__r": "health_optimizer",
    "Call_Sheets__r": "call_sheet",
}

# --- fixed values: contact key prefix -> document column --------------------
CONTACT_PREFIXES = {
    "ACI": "assigned_owner_contact_information",
    "AcAu": "accreditation_audits",
}

# --- fixed values: mapped columns read from fixed payload fields ------------
MAPPED_TIMES = {
    "orig_src_pst_dts": "CreatedDate",
    "source_last_process_dts": "LastModifiedDate",
}
DATES_THROUGH_TIMESTAMP = ["business_effective_dt", "business_expiration_dt"]

# --- fixed values: text patterns --------------------------------------------
AMPERSAND_PATTERN = r"\\u0026amp;|&amp;"
KEY_NOISE_PATTERN = r"[^A-Za-z0-9 ]"
SPACES_PATTERN = r" +"
DIGITS_PATTERN = r"(\d+)"
WHITESPACE = " \t\n\r\f\v"
