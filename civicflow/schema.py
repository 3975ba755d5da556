"""Typed relational model of the register: 84 tables.

Each table is a list of ``(column, type, nullable, references)``; every
table except the four enum code tables carries a surrogate ``id``.  The
flatteners emit exactly these schemas and ``conform`` brings any DataFrame
(e.g. a fixture that defines only the columns the queries read) to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPARK = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "decimal": T.DecimalType(18, 4),
}

_DUCK = {
    "string": "VARCHAR",
    "long": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
    "decimal": "DECIMAL(18,4)",
}

# The four enum code tables and their seed codes.
ENUMS = {
    "legislation_type": ["GL2022", "GL2024"],
    "lobbyist_identity_type": ["NATURAL", "ORGANIZATION"],
    "address_type": ["NATIONAL", "POSTBOX", "FOREIGN"],
    "activity_operation_type": ["SELF_OPERATED", "MANDATE_OPERATED", "BOTH"],
}

TABLES: dict[str, list[tuple[str, str, bool, str | None]]] = {
    "legislation_type": [
        ('code', 'string', True, None),
    ],
    "lobbyist_identity_type": [
        ('code', 'string', True, None),
    ],
    "address_type": [
        ('code', 'string', True, None),
    ],
    "activity_operation_type": [
        ('code', 'string', True, None),
    ],
    "code_label": [
        ('id', 'long', False, None),
        ('domain', 'string', False, None),
        ('code', 'string', False, None),
        ('de', 'string', True, None),
        ('en', 'string', True, None),
    ],
    "country_label": [
        ('id', 'long', False, None),
        ('code', 'string', False, None),
        ('de', 'string', True, None),
        ('en', 'string', True, None),
    ],
    "address": [
        ('id', 'long', False, None),
        ('kind', 'string', True, 'address_type'),
        ('national_additional1', 'string', True, None),
        ('national_additional2', 'string', True, None),
        ('international_additional1', 'string', True, None),
        ('international_additional2', 'string', True, None),
        ('street', 'string', True, None),
        ('street_number', 'string', True, None),
        ('zip_code', 'string', True, None),
        ('city', 'string', True, None),
        ('post_box', 'string', True, None),
        ('country_id', 'long', True, 'country_label'),
    ],
    "contact": [
        ('id', 'long', False, None),
        ('phone_number', 'string', True, None),
    ],
    "contact_email": [
        ('id', 'long', False, None),
        ('contact_id', 'long', False, 'contact'),
        ('ordinal', 'int', False, None),
        ('email', 'string', False, None),
    ],
    "contact_website": [
        ('id', 'long', False, None),
        ('contact_id', 'long', False, 'contact'),
        ('ordinal', 'int', False, None),
        ('website', 'string', False, None),
    ],
    "department": [
        ('id', 'long', False, None),
        ('title', 'string', False, None),
        ('short_title', 'string', True, None),
        ('url', 'string', True, None),
        ('election_period', 'int', True, None),
    ],
    "gov_function_type": [
        ('id', 'long', False, None),
        ('label_id', 'long', False, 'code_label'),
    ],
    "recent_government_function": [
        ('id', 'long', False, None),
        ('ended', 'boolean', True, None),
        ('end_year_month', 'string', True, None),
        ('type_label_id', 'long', False, 'code_label'),
    ],
    "recent_gov_house_reps": [
        ('id', 'long', False, None),
        ('recent_gov_fn_id', 'long', False, 'recent_government_function'),
        ('function_label_id', 'long', False, 'code_label'),
        ('function_position', 'string', True, None),
    ],
    "recent_gov_federal_gov": [
        ('id', 'long', False, None),
        ('recent_gov_fn_id', 'long', False, 'recent_government_function'),
        ('function_label_id', 'long', False, 'code_label'),
        ('department_id', 'long', True, 'department'),
    ],
    "recent_gov_federal_admin": [
        ('id', 'long', False, None),
        ('recent_gov_fn_id', 'long', False, 'recent_government_function'),
        ('supreme_federal_authority', 'string', True, None),
        ('supreme_federal_authority_short', 'string', True, None),
        ('supreme_federal_authority_elect_prd', 'int', True, None),
        ('function_text', 'string', True, None),
    ],
    "register_entry": [
        ('id', 'long', False, None),
        ('schema_uri', 'string', True, None),
        ('source', 'string', False, None),
        ('source_url', 'string', False, None),
        ('source_date', 'timestamp', False, None),
        ('json_doc_url', 'string', False, None),
        ('register_number', 'string', False, None),
    ],
    "account_details": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('active_lobbyist', 'boolean', False, None),
        ('inactive_lobbyist_start', 'timestamp', True, None),
        ('first_publication_date', 'timestamp', False, None),
        ('last_update_date', 'timestamp', True, None),
        ('account_has_codex_violations', 'boolean', False, None),
    ],
    "account_active_range": [
        ('id', 'long', False, None),
        ('account_id', 'long', False, 'account_details'),
        ('ordinal', 'int', False, None),
        ('from_date', 'timestamp', False, None),
        ('until_date', 'timestamp', True, None),
    ],
    "account_inactive_range": [
        ('id', 'long', False, None),
        ('account_id', 'long', False, 'account_details'),
        ('ordinal', 'int', False, None),
        ('from_date', 'timestamp', False, None),
        ('until_date', 'timestamp', True, None),
    ],
    "account_register_entry_version": [
        ('id', 'long', False, None),
        ('account_id', 'long', False, 'account_details'),
        ('ordinal', 'int', False, None),
        ('register_entry_id_num', 'long', False, None),
        ('json_detail_url', 'string', True, None),
        ('version', 'int', False, None),
        ('legislation', 'string', False, 'legislation_type'),
        ('valid_from_date', 'timestamp', False, None),
        ('valid_until_date', 'timestamp', True, None),
        ('active_until_date', 'timestamp', True, None),
        ('version_active_lobbyist', 'boolean', False, None),
    ],
    "codex_violation": [
        ('id', 'long', False, None),
        ('account_id', 'long', False, 'account_details'),
        ('ordinal', 'int', False, None),
        ('name', 'string', False, None),
    ],
    "register_entry_details": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('register_entry_id_num', 'long', False, None),
        ('legislation', 'string', False, 'legislation_type'),
        ('version', 'int', False, None),
        ('details_page_url', 'string', True, None),
        ('pdf_url', 'string', True, None),
        ('valid_from_date', 'timestamp', False, None),
        ('valid_until_date', 'timestamp', True, None),
        ('refused_anything', 'boolean', True, None),
    ],
    "register_entry_annual_update": [
        ('id', 'long', False, None),
        ('details_id', 'long', False, 'register_entry_details'),
        ('update_missing', 'boolean', True, None),
        ('last_annual_update', 'timestamp', True, None),
    ],
    "register_entry_fiscal_year_update": [
        ('id', 'long', False, None),
        ('details_id', 'long', False, 'register_entry_details'),
        ('update_missing', 'boolean', True, None),
        ('last_fiscal_year_update', 'timestamp', True, None),
    ],
    "lobbyist_identity": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('identity', 'string', True, 'lobbyist_identity_type'),
        ('natural_person_type_label_id', 'long', True, 'code_label'),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('last_name', 'string', True, None),
        ('first_name', 'string', True, None),
        ('common_first_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('company_name', 'string', True, None),
        ('recent_gov_function_present', 'boolean', True, None),
        ('recent_gov_function_id', 'long', True, 'recent_government_function'),
        ('address_id', 'long', True, 'address'),
        ('contact_id', 'long', True, 'contact'),
        ('legal_form_type_label_id', 'long', True, 'code_label'),
        ('legal_form_label_id', 'long', True, 'code_label'),
        ('legal_form_text', 'string', True, None),
        ('capital_city_repr_id', 'long', True, None),
        ('entrusted_persons_present', 'boolean', True, None),
        ('name_text', 'string', True, None),
        ('members_present', 'boolean', True, None),
        ('memberships_present', 'boolean', True, None),
    ],
    "capital_city_representation": [
        ('id', 'long', False, None),
        ('address_id', 'long', True, 'address'),
        ('contact_id', 'long', True, 'contact'),
    ],
    "entrusted_person": [
        ('id', 'long', False, None),
        ('identity_id', 'long', False, 'lobbyist_identity'),
        ('ordinal', 'int', False, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('last_name', 'string', True, None),
        ('first_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('recent_gov_function_present', 'boolean', True, None),
        ('recent_gov_function_id', 'long', True, 'recent_government_function'),
    ],
    "legal_representative": [
        ('id', 'long', False, None),
        ('identity_id', 'long', False, 'lobbyist_identity'),
        ('ordinal', 'int', False, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('last_name', 'string', True, None),
        ('first_name', 'string', True, None),
        ('common_first_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('function_text', 'string', True, None),
        ('recent_gov_function_id', 'long', True, 'recent_government_function'),
        ('contact_id', 'long', True, 'contact'),
    ],
    "named_employee": [
        ('id', 'long', False, None),
        ('identity_id', 'long', False, 'lobbyist_identity'),
        ('ordinal', 'int', False, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('last_name', 'string', True, None),
        ('common_first_name', 'string', True, None),
    ],
    "members_count": [
        ('id', 'long', False, None),
        ('identity_id', 'long', False, 'lobbyist_identity'),
        ('natural_persons', 'int', True, None),
        ('organizations', 'int', True, None),
        ('total_count', 'int', True, None),
        ('date_count', 'date', True, None),
    ],
    "membership": [
        ('id', 'long', False, None),
        ('identity_id', 'long', False, 'lobbyist_identity'),
        ('ordinal', 'int', False, None),
        ('membership', 'string', False, None),
    ],
    "activities_interests": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('activity_label_id', 'long', True, 'code_label'),
        ('activity_text', 'string', True, None),
        ('activity_legal_basis', 'string', True, None),
        ('activity_operation_type', 'string', True, 'activity_operation_type'),
        ('activity_description', 'string', True, None),
    ],
    "activity_exercising_type": [
        ('id', 'long', False, None),
        ('activities_id', 'long', False, 'activities_interests'),
        ('ordinal', 'int', False, None),
        ('label_id', 'long', False, 'code_label'),
    ],
    "field_of_interest": [
        ('id', 'long', False, None),
        ('activities_id', 'long', False, 'activities_interests'),
        ('ordinal', 'int', False, None),
        ('label_id', 'long', True, 'code_label'),
        ('field_of_interest_text', 'string', True, None),
    ],
    "legislative_project": [
        ('id', 'long', False, None),
        ('activities_id', 'long', False, 'activities_interests'),
        ('ordinal', 'int', False, None),
        ('name', 'string', True, None),
        ('printing_number', 'string', True, None),
        ('document_title', 'string', True, None),
        ('document_url', 'string', True, None),
    ],
    "client_identity": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('clients_present', 'boolean', False, None),
        ('clients_count', 'int', True, None),
    ],
    "client_org": [
        ('id', 'long', False, None),
        ('client_identity_id', 'long', False, 'client_identity'),
        ('ordinal', 'int', False, None),
        ('reference_name', 'string', True, None),
        ('reference_details_url', 'string', True, None),
        ('name', 'string', True, None),
        ('legal_form_type_label_id', 'long', True, 'code_label'),
        ('legal_form_label_id', 'long', True, 'code_label'),
        ('legal_form_text', 'string', True, None),
        ('address_id', 'long', True, 'address'),
        ('contact_id', 'long', True, 'contact'),
    ],
    "client_org_legal_rep": [
        ('id', 'long', False, None),
        ('client_org_id', 'long', False, 'client_org'),
        ('ordinal', 'int', False, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('common_first_name', 'string', True, None),
        ('last_name', 'string', True, None),
        ('function_text', 'string', True, None),
        ('contact_id', 'long', True, 'contact'),
    ],
    "client_person": [
        ('id', 'long', False, None),
        ('client_identity_id', 'long', False, 'client_identity'),
        ('ordinal', 'int', False, None),
        ('reference_name', 'string', True, None),
        ('reference_details_url', 'string', True, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('last_name', 'string', True, None),
        ('common_first_name', 'string', True, None),
    ],
    "employees_involved": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('related_year_finished', 'boolean', True, None),
        ('related_year_start', 'date', True, None),
        ('related_year_end', 'date', True, None),
        ('employees_from', 'int', True, None),
        ('employees_to', 'int', True, None),
        ('employee_fte', 'decimal', True, None),
    ],
    "financial_expenses": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('refuse_info', 'boolean', True, None),
        ('refuse_reason', 'string', True, None),
        ('related_year_finished', 'boolean', True, None),
        ('related_year_start', 'date', True, None),
        ('related_year_end', 'date', True, None),
        ('fiscal_year_completed', 'boolean', True, None),
        ('fiscal_year_start_ym', 'string', True, None),
        ('fiscal_year_end_ym', 'string', True, None),
        ('expenses_from_eur', 'long', True, None),
        ('expenses_to_eur', 'long', True, None),
    ],
    "main_funding_sources": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('related_year_finished', 'boolean', True, None),
        ('related_year_start', 'date', True, None),
        ('related_year_end', 'date', True, None),
    ],
    "main_funding_source_item": [
        ('id', 'long', False, None),
        ('parent_id', 'long', False, 'main_funding_sources'),
        ('ordinal', 'int', False, None),
        ('label_id', 'long', True, 'code_label'),
    ],
    "public_allowances": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('refuse_info', 'boolean', True, None),
        ('refuse_reason', 'string', True, None),
        ('allowances_present', 'boolean', True, None),
        ('related_year_finished', 'boolean', True, None),
        ('related_year_start', 'date', True, None),
        ('related_year_end', 'date', True, None),
        ('fiscal_year_completed', 'boolean', True, None),
        ('fiscal_year_start_ym', 'string', True, None),
        ('fiscal_year_end_ym', 'string', True, None),
    ],
    "public_allowance_item": [
        ('id', 'long', False, None),
        ('parent_id', 'long', False, 'public_allowances'),
        ('ordinal', 'int', False, None),
        ('name', 'string', True, None),
        ('type_label_id', 'long', True, 'code_label'),
        ('country_id', 'long', True, 'country_label'),
        ('location', 'string', True, None),
        ('amount_from_eur', 'long', True, None),
        ('amount_to_eur', 'long', True, None),
        ('description', 'string', True, None),
    ],
    "donators": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('refuse_info', 'boolean', True, None),
        ('refuse_reason', 'string', True, None),
        ('info_present', 'boolean', True, None),
        ('related_year_finished', 'boolean', True, None),
        ('related_year_start', 'date', True, None),
        ('related_year_end', 'date', True, None),
        ('fiscal_year_completed', 'boolean', True, None),
        ('fiscal_year_start_ym', 'string', True, None),
        ('fiscal_year_end_ym', 'string', True, None),
        ('total_from_eur', 'long', True, None),
        ('total_to_eur', 'long', True, None),
    ],
    "donator_item": [
        ('id', 'long', False, None),
        ('parent_id', 'long', False, 'donators'),
        ('ordinal', 'int', False, None),
        ('name', 'string', True, None),
        ('amount_from_eur', 'long', True, None),
        ('amount_to_eur', 'long', True, None),
        ('description', 'string', True, None),
    ],
    "membership_fees": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('related_year_finished', 'boolean', False, None),
        ('related_year_start', 'date', True, None),
        ('related_year_end', 'date', True, None),
        ('total_from_eur', 'long', True, None),
        ('total_to_eur', 'long', True, None),
        ('individual_contributors_present', 'boolean', True, None),
    ],
    "individual_contributor": [
        ('id', 'long', False, None),
        ('fees_id', 'long', False, 'membership_fees'),
        ('ordinal', 'int', False, None),
        ('name', 'string', True, None),
    ],
    "annual_reports": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('disclosure_requirements_exist', 'boolean', True, None),
        ('refuse_annual_fin_stmt', 'boolean', True, None),
        ('refuse_annual_fin_stmt_reason', 'string', True, None),
        ('annual_report_exists', 'boolean', True, None),
        ('annual_report_last_fy_exists', 'boolean', True, None),
        ('annual_report_prev_last_fy_exists', 'boolean', True, None),
        ('finished_fy_exists', 'boolean', True, None),
        ('last_fy_start', 'date', True, None),
        ('last_fy_end', 'date', True, None),
        ('prev_last_fy_start', 'date', True, None),
        ('prev_last_fy_end', 'date', True, None),
        ('annual_report_pdf_url', 'string', True, None),
        ('missing_annual_report_reason', 'string', True, None),
        ('report_was_published_elsewhere', 'boolean', True, None),
        ('location_of_report_publication', 'string', True, None),
    ],
    "regulatory_projects": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('projects_present', 'boolean', True, None),
        ('projects_count', 'int', True, None),
    ],
    "regulatory_project_item": [
        ('id', 'long', False, None),
        ('parent_id', 'long', False, 'regulatory_projects'),
        ('ordinal', 'int', False, None),
        ('regulatory_project_number', 'string', True, None),
        ('title', 'string', True, None),
        ('printed_matters_present', 'boolean', True, None),
        ('draft_bill_present', 'boolean', True, None),
        ('description', 'string', True, None),
    ],
    "reg_project_printed_matter": [
        ('id', 'long', False, None),
        ('project_item_id', 'long', False, 'regulatory_project_item'),
        ('ordinal', 'int', False, None),
        ('title', 'string', True, None),
        ('printing_number', 'string', True, None),
        ('issuer', 'string', True, None),
        ('document_url', 'string', True, None),
        ('project_url', 'string', True, None),
    ],
    "leading_ministry": [
        ('id', 'long', False, None),
        ('title', 'string', True, None),
        ('short_title', 'string', True, None),
        ('url', 'string', True, None),
        ('election_period', 'int', True, None),
    ],
    "reg_project_printed_matter_ministry": [
        ('id', 'long', False, None),
        ('printed_matter_id', 'long', False, 'reg_project_printed_matter'),
        ('ordinal', 'int', False, None),
        ('ministry_id', 'long', False, 'leading_ministry'),
    ],
    "migrated_draft_bill": [
        ('id', 'long', False, None),
        ('printed_matter_id', 'long', False, 'reg_project_printed_matter'),
        ('title', 'string', True, None),
        ('publication_date', 'date', True, None),
    ],
    "migrated_draft_bill_ministry": [
        ('id', 'long', False, None),
        ('migrated_db_id', 'long', False, 'migrated_draft_bill'),
        ('ordinal', 'int', False, None),
        ('ministry_id', 'long', False, 'leading_ministry'),
        ('draft_bill_document_url', 'string', True, None),
        ('draft_bill_project_url', 'string', True, None),
    ],
    "draft_bill": [
        ('id', 'long', False, None),
        ('project_item_id', 'long', False, 'regulatory_project_item'),
        ('title', 'string', True, None),
        ('publication_date', 'date', True, None),
        ('custom_title', 'string', True, None),
        ('custom_date', 'date', True, None),
    ],
    "draft_bill_ministry": [
        ('id', 'long', False, None),
        ('draft_bill_id', 'long', False, 'draft_bill'),
        ('ordinal', 'int', False, None),
        ('ministry_id', 'long', False, 'leading_ministry'),
        ('draft_bill_document_url', 'string', True, None),
        ('draft_bill_project_url', 'string', True, None),
    ],
    "reg_project_affected_law": [
        ('id', 'long', False, None),
        ('project_item_id', 'long', False, 'regulatory_project_item'),
        ('ordinal', 'int', False, None),
        ('title', 'string', True, None),
        ('short_title', 'string', True, None),
        ('url', 'string', True, None),
    ],
    "reg_project_field_of_interest": [
        ('id', 'long', False, None),
        ('project_item_id', 'long', False, 'regulatory_project_item'),
        ('ordinal', 'int', False, None),
        ('label_id', 'long', True, 'code_label'),
        ('field_of_interest_text', 'string', True, None),
    ],
    "statements": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('statements_present', 'boolean', True, None),
        ('statements_count', 'int', True, None),
    ],
    "statement_item": [
        ('id', 'long', False, None),
        ('parent_id', 'long', False, 'statements'),
        ('ordinal', 'int', False, None),
        ('statement_number', 'string', True, None),
        ('regulatory_project_number', 'string', True, None),
        ('regulatory_project_title', 'string', True, None),
        ('pdf_url', 'string', True, None),
        ('pdf_page_count', 'int', True, None),
        ('copyright_acknowledgement', 'string', True, None),
        ('text_body', 'string', True, None),
        ('sending_date', 'date', True, None),
    ],
    "statement_recipient_group": [
        ('id', 'long', False, None),
        ('statement_item_id', 'long', False, 'statement_item'),
        ('ordinal', 'int', False, None),
    ],
    "statement_recipient_parliament": [
        ('id', 'long', False, None),
        ('group_id', 'long', False, 'statement_recipient_group'),
        ('ordinal', 'int', False, None),
        ('label_id', 'long', False, 'code_label'),
    ],
    "statement_recipient_federal_gov": [
        ('id', 'long', False, None),
        ('group_id', 'long', False, 'statement_recipient_group'),
        ('ordinal', 'int', False, None),
        ('department_id', 'long', False, 'department'),
    ],
    "contracts": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('contracts_present', 'boolean', True, None),
        ('contracts_count', 'int', True, None),
    ],
    "contract_item": [
        ('id', 'long', False, None),
        ('parent_id', 'long', False, 'contracts'),
        ('ordinal', 'int', False, None),
        ('description', 'string', True, None),
    ],
    "contract_field_of_interest": [
        ('id', 'long', False, None),
        ('contract_item_id', 'long', False, 'contract_item'),
        ('ordinal', 'int', False, None),
        ('label_id', 'long', True, 'code_label'),
        ('field_of_interest_text', 'string', True, None),
    ],
    "contract_reg_project_ref": [
        ('id', 'long', False, None),
        ('contract_item_id', 'long', False, 'contract_item'),
        ('ordinal', 'int', False, None),
        ('regulatory_project_number', 'string', False, None),
        ('regulatory_project_title', 'string', False, None),
    ],
    "contract_clients": [
        ('id', 'long', False, None),
        ('contract_item_id', 'long', False, 'contract_item'),
    ],
    "contract_client_org": [
        ('id', 'long', False, None),
        ('clients_id', 'long', False, 'contract_clients'),
        ('ordinal', 'int', False, None),
        ('reference_name', 'string', True, None),
        ('reference_details_url', 'string', True, None),
        ('name', 'string', True, None),
        ('legal_form_type_label_id', 'long', True, 'code_label'),
        ('legal_form_label_id', 'long', True, 'code_label'),
        ('legal_form_text', 'string', True, None),
        ('address_id', 'long', True, 'address'),
        ('contact_id', 'long', True, 'contact'),
    ],
    "contract_client_org_legal_rep": [
        ('id', 'long', False, None),
        ('client_org_id', 'long', False, 'contract_client_org'),
        ('ordinal', 'int', False, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('first_name', 'string', True, None),
        ('last_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('function_text', 'string', True, None),
    ],
    "contract_client_org_financial_resources": [
        ('id', 'long', False, None),
        ('client_org_id', 'long', False, 'contract_client_org'),
        ('last_fiscal_year_finished', 'boolean', True, None),
        ('last_fiscal_year_start', 'date', True, None),
        ('last_fiscal_year_end', 'date', True, None),
        ('amount_from_eur', 'long', True, None),
        ('amount_to_eur', 'long', True, None),
    ],
    "contract_client_person": [
        ('id', 'long', False, None),
        ('clients_id', 'long', False, 'contract_clients'),
        ('ordinal', 'int', False, None),
        ('reference_name', 'string', True, None),
        ('reference_details_url', 'string', True, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('last_name', 'string', True, None),
        ('first_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('company_name', 'string', True, None),
    ],
    "contract_client_person_financial_resources": [
        ('id', 'long', False, None),
        ('client_person_id', 'long', False, 'contract_client_person'),
        ('last_fiscal_year_finished', 'boolean', True, None),
        ('last_fiscal_year_start', 'date', True, None),
        ('last_fiscal_year_end', 'date', True, None),
        ('amount_from_eur', 'long', True, None),
        ('amount_to_eur', 'long', True, None),
    ],
    "contract_contractors": [
        ('id', 'long', False, None),
        ('contract_item_id', 'long', False, 'contract_item'),
        ('lobbying_is_carried_out_by_lobbyist', 'boolean', True, None),
    ],
    "contractor_entrusted_person": [
        ('id', 'long', False, None),
        ('contractors_id', 'long', False, 'contract_contractors'),
        ('ordinal', 'int', False, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('first_name', 'string', True, None),
        ('last_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('function_text', 'string', True, None),
        ('recent_gov_function_present', 'boolean', True, None),
        ('recent_gov_function_id', 'long', True, 'recent_government_function'),
    ],
    "contractor_org": [
        ('id', 'long', False, None),
        ('contractors_id', 'long', False, 'contract_contractors'),
        ('ordinal', 'int', False, None),
        ('reference_name', 'string', True, None),
        ('reference_details_url', 'string', True, None),
        ('name', 'string', True, None),
        ('legal_form_type_label_id', 'long', True, 'code_label'),
        ('legal_form_label_id', 'long', True, 'code_label'),
        ('legal_form_text', 'string', True, None),
        ('address_id', 'long', True, 'address'),
        ('contact_id', 'long', True, 'contact'),
        ('capital_city_repr_address_id', 'long', True, 'address'),
        ('capital_city_repr_contact_id', 'long', True, 'contact'),
    ],
    "contractor_org_legal_rep": [
        ('id', 'long', False, None),
        ('contractor_org_id', 'long', False, 'contractor_org'),
        ('ordinal', 'int', False, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('first_name', 'string', True, None),
        ('last_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('function_text', 'string', True, None),
        ('recent_gov_function_present', 'boolean', True, None),
        ('recent_gov_function_id', 'long', True, 'recent_government_function'),
    ],
    "assigned_person": [
        ('id', 'long', False, None),
        ('contractors_id', 'long', False, 'contract_contractors'),
        ('ordinal', 'int', False, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('first_name', 'string', True, None),
        ('last_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('recent_gov_function_present', 'boolean', True, None),
        ('recent_gov_function_id', 'long', True, 'recent_government_function'),
    ],
    "contractor_person": [
        ('id', 'long', False, None),
        ('contractors_id', 'long', False, 'contract_contractors'),
        ('ordinal', 'int', False, None),
        ('reference_name', 'string', True, None),
        ('reference_details_url', 'string', True, None),
        ('academic_degree_before', 'string', True, None),
        ('academic_degree_after', 'string', True, None),
        ('last_name', 'string', True, None),
        ('first_name', 'string', True, None),
        ('artist_name', 'string', True, None),
        ('company_name', 'string', True, None),
        ('recent_gov_function_present', 'boolean', True, None),
        ('recent_gov_function_id', 'long', True, 'recent_government_function'),
    ],
    "code_of_conduct": [
        ('id', 'long', False, None),
        ('entry_id', 'long', False, 'register_entry'),
        ('own_code_of_conduct', 'boolean', False, None),
        ('code_of_conduct_pdf_url', 'string', True, None),
    ],
}


def struct(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, _SPARK[t], n) for c, t, n, _ in TABLES[name]])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the table's columns in schema order; absent ones become NULL.

    Present columns keep their type (a narrower fixture type is not widened
    here); absent columns get the schema type.
    """
    have = set(df.columns)
    cols: list[Column] = []
    for c, t, _, _ in TABLES[name]:
        cols.append(F.col(c) if c in have else F.lit(None).cast(_SPARK[t]).alias(c))
    extra = [F.col(c) for c in df.columns if c not in {x[0] for x in TABLES[name]}]
    return df.select(*cols, *extra)


def missing_columns_sql(name: str, present: set[str]) -> str:
    """DuckDB select-list that adds the schema columns missing from a view."""
    parts = [f"CAST(NULL AS {_DUCK[t]}) AS {c}"
             for c, t, _, _ in TABLES.get(name, []) if c not in present]
    return ", ".join(parts)
