"""Declared schemas of the benefit-scheme tables (Spark DDL strings).

Money is decimal(12,2) / decimal(15,2), dates are TIMESTAMP_NTZ (the modelled
DATE type carries a time of day), codes are strings.
"""

SCHEMAS = {
    "department": "department_id int, department_name string",
    "scheme": ("scheme_id bigint, scheme_name string, scheme_code string, department_id bigint, "
               "scheme_type string, base_benefit_amount decimal(12,2), max_benefit_amount decimal(12,2), "
               "is_active string"),
    "rules": ("scheme_id bigint, min_age int, max_age int, max_income decimal(12,2), min_income decimal(12,2), "
              "allowed_categories string, location_type string, gender_restriction string, "
              "min_land_acres decimal(6,2)"),
    "officer": "officer_id bigint, officer_name string, department_id int, assigned_state string",
    "citizen": ("citizen_id bigint, aadhaar_number string, full_name string, gender string, age int, "
                "category string, annual_income decimal(12,2), location_type string, "
                "land_holding_acres decimal(6,2), occupation string, state string, bank_account string, "
                "is_verified string"),
    "application": ("application_id bigint, citizen_id bigint, scheme_id bigint, officer_id bigint, "
                    "apply_date timestamp_ntz, status string, approval_date timestamp_ntz, "
                    "priority_score int, rejection_reason string, remarks string"),
    "disbursement": ("disbursement_id bigint, application_id bigint, amount decimal(12,2), "
                     "disbursement_date timestamp_ntz, payment_mode string, status string, "
                     "transaction_ref string"),
    "pool": "scheme_id bigint, financial_year string, total_budget decimal(15,2), disbursed_amount decimal(15,2)",
    "citizen_document": ("doc_id bigint, citizen_id bigint, doc_type string, status string, "
                         "upload_date timestamp_ntz"),
    "status_event": "event_id bigint, application_id bigint, new_status string, change_date timestamp_ntz",
    "application_request": ("request_id bigint, citizen_id bigint, scheme_id bigint, remarks string, "
                            "requested_at timestamp_ntz"),
    "decision_request": ("request_id bigint, application_id bigint, officer_id bigint, action string, "
                         "requested_at timestamp_ntz, remarks string"),
    "citizen_dirty": ("citizen_id bigint, aadhaar_number string, gender string, age int, "
                      "annual_income decimal(12,2), category string, state string, full_name string, "
                      "location_type string, land_holding_acres decimal(6,2), occupation string, bank_account string, "
                      "is_verified string"),
}

# the same tables with planted breaches
SCHEMAS |= {f"{t}_dirty": SCHEMAS[t] for t in ("scheme", "rules", "pool", "officer", "citizen_document", "application",
                                               "disbursement")}

# Base tables of the modelled system (the ones the constraint jobs police).
BASE_TABLES = ["department", "scheme", "rules", "pool", "officer", "citizen", "citizen_document",
               "application", "disbursement"]

# Driver parquet tables the fixtures read.
SOURCE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "events",
                 "documents", "labels"]

# Read schemas of the driver tables (only the columns the fixtures use):
# declared, never inferred, with TIMESTAMP_NTZ for the wall-clock timestamps.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "documents": "doc_id bigint",
    "labels": "doc_id bigint, quality int",
}
