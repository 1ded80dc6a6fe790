"""Declared schemas of the landing and history tables, as DDL text."""

from __future__ import annotations

from histflow import fixed_values as fv

# --- fixed values: landing tables -------------------------------------------
LANDING_CONTACTS = (
    "ID string not null, AccountId string, line_of_business string, CreatedDate timestamp, "
    "LastModifiedDate timestamp, inserted_time timestamp, updated_time timestamp, "
    "indicator_flag string, Payload string"
)
LANDING_CONFIGURATION = (
    "ID string, Product_Association_ID string, line_of_business string, Grouper_val string, "
    "CreatedDate timestamp, LastModifiedDate timestamp, inserted_time timestamp, "
    "updated_time timestamp, indicator_flag string, Payload string"
)
LANDING_CUSTOMER = (
    "customer_id string, customer_nm string, sf_account_id string, sf_platform_id_level_nm string, "
    "business_unit_cd string, indicator_flag string, business_effective_dt date, business_expiration_dt date"
)

# --- fixed values: history tables -------------------------------------------
CONTACTS_HISTORY = (
    "surrogate_key string not null, id string not null, assigned_owner_contact_information string, "
    "accreditation_audits string, indicator_flag string, active_flg string, "
    "effective_start_ts timestamp, effective_end_ts timestamp, load_ts timestamp"
)
CUSTOMER_HISTORY = (
    "sgk_customer_id string, source_system_cd string, business_unit_cd string, insert_dts timestamp, "
    "record_hash_key_id string, last_process_dts timestamp, business_effective_dt date, "
    "business_expiration_dt date, record_start_dts timestamp, record_end_dts timestamp, "
    "active_record_ind string, indicator_flag string, customer_id string, customer_nm string, "
    "sf_account_id string, sf_platform_id_level_nm string"
)
CONFIGURATION_HISTORY = (
    "sgk_customer_product_configuration_id string, source_system_cd string, business_unit_cd string, "
    "line_of_business_cd string, insert_dts timestamp, source_record_sequence_nbr string, "
    "business_hash_key_id string, record_hash_key_id string, last_process_dts timestamp, "
    "orig_src_pst_dts timestamp, source_last_process_dts timestamp, business_effective_dt date, "
    "business_expiration_dt date, sgk_job_run_id string, business_key_txt string, "
    "customer_population_group_id string, customer_id string, sf_account_id string, "
    "sf_group_census_id string, sf_product_association_id string, sf_product_configuration_id string, "
    "sf_product_implementation_grouper_id string, "
    + ", ".join(f"{c} string" for c in [*fv.CATEGORIES.values(), *fv.CHILDREN.values()])
    + ", record_status_cd string, active_record_ind string, record_start_dts timestamp, "
    "record_end_dts timestamp, update_by string"
)
ACCOUNT_STRUCTURE_HISTORY = (
    "sgk_customer_account_structure_id string, source_system_cd string, business_unit_cd string, "
    "line_of_business_cd string, insert_dts timestamp, record_status_cd string, "
    "source_record_sequence_nbr string, business_hash_key_id string, record_hash_key_id string, "
    "last_process_dts timestamp, source_last_process_dts timestamp, business_effective_dt date, "
    "business_expiration_dt date, record_start_dts timestamp, record_end_dts timestamp, "
    "active_record_ind string, sgk_job_run_id string, business_key_txt string, sgk_customer_id string, "
    "plan_sponsor_unique_id string, plan_sponsor_unique_nm string, account_employment_status_cd string, "
    "cms_contract_st_cd string, cms_lep_attestation_cd string, cobra_ind string, contact_typ_cd string, "
    "cust_mkt_subseg_cd string, customer_category_cd string, customer_group_contact_nm string, "
    "customer_group_nm string, decision_maker_typ_cd string, eligible_employee_cnt bigint, "
    "emplyr_class_cd string, excld_cd string, exprnc_acctng_basis_cd string, group_size_cd string, "
    "renewal_effective_dt date, renewal_expiration_dt date, service_fld_office_cd string, sic_cd string, "
    "small_grp_reform_ind string, source_pln_typ_cd string, source_pln_typ_id string, stplss_st_cd string, "
    "total_employee_cnt bigint, trust_cd string, trust_nm string, account_id string, "
    "account_status_cd string, data_share_consent_ind string, "
    + ", ".join(
        f"customer_account_structure_level_{n}_{kind}_dt date"
        for n in (1, 2, 3, 4)
        for kind in ("effective", "expiration")
    )
    + ", client_plan_group_id string, rx_claim_client_cd string, non_business_unit_customer_ind string, "
    "non_business_unit_customer_type_cd string, non_business_unit_line_of_business_cd string, "
    "cfo_cd string, clm_office_cd string, super_client_effective_dt date, super_client_expiration_dt date, "
    "quantum_leap_client_cd string, quantum_leap_client_id string, "
    + ", ".join(f"customer_account_structure_level_{n}_id string" for n in (1, 2, 3, 4))
    + ", source_customer_id string, source_customer_qualifier_cd string, master_customer_id string, "
    "source_organization_id string, "
    + ", ".join(f"customer_account_structure_level_{n}_nm string" for n in (1, 2, 3, 4))
    + ", customer_account_type_cd string, rdc_ind string, rdc_level_cd string, sf_group_census_id string, "
    "sf_coalition_nm string, sf_member_list_typ_nm string, orig_src_pst_dts timestamp, "
    "sf_account_id string, customer_id string"
)
