"""Derivation of the benefit-scheme tables from the driver's parquet tables.

Each table is one SQL template over ``{placeholders}``.  On Spark the
placeholders are bound to DataFrames (``spark.sql(text, **frames)``); for the
DuckDB oracle they become common-table-expression names.  The same text runs
unchanged on both engines, so the oracle sees exactly the data the jobs see.

Two tables are computed differently on the two sides on purpose:
``benefit`` (the f02 rule) and ``application`` (priority score f03 and the
rejection reason f01 stored on generated rejections).  Spark uses the rule
expressions of ``schemelens.functions.rules``; the oracle uses independent SQL,
so the fixture itself cross-checks the rules.
"""

from __future__ import annotations

import re

# Scheme row generators, budget multipliers and code lists of the
# fixture model (documented in FIXTURES.md).
TEMPLATES: dict[str, str] = {
    "department": """
select r_regionkey as department_id, concat('DEPT_', r_name) as department_name from {region}
""",
    "scheme": """
select p_partkey as scheme_id, concat('SCHEME_', lpad(cast(p_partkey as string),cast(greatest(length(cast(p_partkey as string)),2) as int),'0')) as scheme_name, concat('S-', cast(p_partkey as string)) as scheme_code,
 p_partkey % 5 as department_id, case when p_partkey % 2 = 0 then 'MAJOR' else 'MINOR' end as scheme_type,
 cast(900 * (1 + (p_partkey*7) % 20) as decimal(12,2)) as base_benefit_amount,
 cast(case when p_partkey = 18 then null else 900 * (1 + (p_partkey*7) % 20) + 45 * (1 + (p_partkey*7) % 20) * (1 + p_partkey % 6) end as decimal(12,2)) as max_benefit_amount,
 case when p_partkey = 13 then 'N' else 'Y' end as is_active from {part}
""",
    "rules": """
select scheme_id, case scheme_id % 3 when 0 then 18 when 1 then 21 else 0 end as min_age,
 case scheme_id % 4 when 0 then 120 when 1 then 70 when 2 then 55 else 30 end as max_age,
 cast(case when scheme_id % 5 = 4 then null else 200000 + 100000 * (scheme_id % 5) end as decimal(12,2)) as max_income,
 cast(case when scheme_id = 6 then 100000 else 0 end as decimal(12,2)) as min_income,
 case scheme_id % 6 when 4 then 'SC,ST' when 5 then 'SC,ST,OBC' else 'ALL' end as allowed_categories,
 case scheme_id % 7 when 2 then 'RURAL' when 5 then 'URBAN' else 'ALL' end as location_type,
 case scheme_id % 9 when 3 then 'F' when 8 then 'M' else 'ALL' end as gender_restriction,
 cast(case scheme_id % 8 when 1 then 0.1 when 7 then 0.5 else 0 end as decimal(6,2)) as min_land_acres from {scheme} where scheme_id <> 17
""",
    "officer": """
select s_suppkey as officer_id, s_name as officer_name, cast(s_nationkey % 5 as int) as department_id, case when s_suppkey = 0 then null else n_name end as assigned_state
 from {supplier} left join {nation} on s_nationkey = n_nationkey
""",
    "citizen": """
select c_custkey as citizen_id, lpad(cast(700000000000 + c_custkey as string),12,'0') as aadhaar_number, c_name as full_name,
 case when c_custkey % 31 < 16 then 'M' else 'F' end as gender, cast(18 + (c_custkey*11) % 58 as int) as age,
 case when c_custkey % 12 < 2 then 'SC' when c_custkey % 12 < 3 then 'ST' when c_custkey % 12 < 8 then 'OBC' else 'GEN' end as category,
 cast(case when c_custkey % 19 < 8 then 20000 + 100*((c_custkey*7919) % 801) when c_custkey % 19 < 14 then 100000 + 100*((c_custkey*7919) % 1501)
  when c_custkey % 19 < 16 then 250000 + 100*((c_custkey*7919) % 2501) when c_custkey % 19 < 18 then 500000 + 100*((c_custkey*7919) % 5001)
  else 1000000 + 100*((c_custkey*7919) % 20001) end as decimal(12,2)) as annual_income,
 case when c_custkey % 23 < 15 then 'RURAL' else 'URBAN' end as location_type,
 cast(case when c_custkey % 13 < 3 then (5 + (c_custkey*17) % 76) / 10.0 else 0 end as decimal(6,2)) as land_holding_acres,
 case when c_custkey % 13 < 3 then 'Farmer' when c_custkey % 13 < 6 then 'Trader' else 'Other' end as occupation, n_name as state, concat('ACCT', lpad(cast(c_custkey as string),12,'0')) as bank_account,
 case when c_custkey % 17 < 12 then 'Y' else 'N' end as is_verified from {customer} join {nation} on c_nationkey = n_nationkey
""",
    "application0": """
select o_orderkey as application_id, case when o_custkey % 9 <> 0 then o_custkey when o_custkey = 0 then 1 else o_custkey - 1 end as citizen_id, cast(floor(((o_orderkey % 20) * (o_custkey % 20)) / 20) as bigint) as scheme_id,
 case when o_orderkey % 17 = 0 or (o_orderkey % (select count(*) from {supplier})) % 10 = 7 then null else o_orderkey % (select count(*) from {supplier}) end as officer_id,
 o_orderdate + interval '1' hour * cast(o_orderkey % 24 as int) as apply_date,
 case when o_orderstatus = 'O' then case when o_orderkey % 3 = 0 then 'UNDER_REVIEW' else 'SUBMITTED' end
      when o_orderstatus = 'F' then case when o_orderkey % 2 = 0 then 'DISBURSED' else 'APPROVED' end
      else case when o_orderkey % 2 = 0 then 'REJECTED' else 'DISBURSED' end end as status from {orders}
""",
    "application_base": """
select *, case when status in ('APPROVED','DISBURSED') or (status='REJECTED' and application_id % 4 = 0) then apply_date + interval '1' hour * cast(72 + (application_id*7) % 1000 as int) end as approval_date from {application0}
""",
    "benefit": """
select a.application_id, a.citizen_id, a.scheme_id, case when base_benefit_amount is null or max_benefit_amount is null then null else least(cast(round(cast(base_benefit_amount * (case when annual_income<=50000 then 1.00 when annual_income<=150000 then 0.88 when annual_income<=300000 then 0.75 when annual_income<=500000 then 0.60 else 0.40 end)
 * (case when category in ('SC','ST') then 1.20 when category='OBC' then 1.10 else 1.00 end) * (case when location_type='RURAL' then 1.08 else 1.00 end) * (case when age>=60 then 1.12 else 1.00 end) as decimal(28,10)),2) as decimal(12,2)), max_benefit_amount) end as amount
 from {application_base} a join {citizen} c on a.citizen_id=c.citizen_id join {scheme} s on a.scheme_id=s.scheme_id
""",
    "disbursement": """
select b.application_id as disbursement_id, b.application_id, b.amount, a.approval_date + interval '1' hour * cast(24 * (1 + b.application_id % 7) as int) as disbursement_date,
 case b.application_id % 3 when 0 then 'DBT' when 1 then 'NEFT' else 'RTGS' end as payment_mode, case when b.application_id % 29 = 0 then 'FAILED' else 'PROCESSED' end as status,
 concat('TXN', replace(substr(cast(a.approval_date as string),1,10),'-',''), lpad(cast(b.application_id as string),cast(greatest(length(cast(b.application_id as string)),8) as int),'0')) as transaction_ref
 from {benefit} b join {application_base} a on a.application_id=b.application_id where a.status in ('APPROVED','DISBURSED') and b.application_id % 5 <> 4
""",
    "pool": """
select s.scheme_id, '2024-25' as financial_year, cast(base_benefit_amount * (select count(*) from {orders}) * case s.scheme_id when 0 then 150 when 1 then 48 when 2 then 60 when 3 then 45 when 4 then 26 else 40 end / 1000 as decimal(15,2)) as total_budget,
 cast(coalesce(x.amt,0) + case when s.scheme_id % 6 = 1 then 100 else 0 end as decimal(15,2)) as disbursed_amount
 from {scheme} s left join (select a.scheme_id, sum(d.amount) as amt from {disbursement} d join {application_base} a on a.application_id=d.application_id group by a.scheme_id) x on x.scheme_id=s.scheme_id
""",
    "citizen_document": """
select d.doc_id, d.doc_id % (select count(*) from {customer}) as citizen_id, case d.doc_id % 6 when 0 then 'AADHAAR' when 1 then 'INCOME_CERT' when 2 then 'CASTE_CERT' when 3 then 'LAND_RECORD' when 4 then 'BANK_PASSBOOK' else 'RATION_CARD' end as doc_type,
 case when quality = 1 then 'VERIFIED' when quality = 0 then 'REJECTED' else 'PENDING' end as status,
 (select min(o_orderdate) from {orders}) + interval '1' hour * cast((d.doc_id * 5) % 5000 as int) as upload_date from {documents} d left join {labels} l on d.doc_id = l.doc_id
""",
    "status_event": """
select event_id, user_id as application_id, case event_type when 'signup' then 'SUBMITTED' when 'view' then 'UNDER_REVIEW' when 'click' then 'APPROVED' when 'purchase' then 'DISBURSED' else 'REJECTED' end as new_status, ts as change_date from {events}
""",
    "application_request": """
select event_id as request_id, (event_id*11) % ((select count(*) from {customer}) + 5) as citizen_id, case when event_id % 21 = 20 then (select count(*) from {scheme}) + 5 else event_id % 21 end as scheme_id, case when event_type = 'view' then '' else event_type end as remarks, ts as requested_at from {events}
""",
    "decision_request": """
select event_id as request_id, (event_id*13) % cast(floor((select count(*) from {orders}) / 4) as bigint) as application_id, event_id % ((select count(*) from {supplier}) + 1) as officer_id,
 case event_type when 'error' then 'reject' when 'signup' then 'HOLD' else 'Approve' end as action, ts as requested_at,
 case event_id % 3 when 0 then null when 1 then '' else concat('Note ', cast(event_id as string)) end as remarks from {events}
""",
    "citizen_dirty": """
select citizen_id, case when citizen_id % 50 = 49 then substr(aadhaar_number,1,11) when citizen_id % 60 = 59 then '700000000000' else aadhaar_number end as aadhaar_number,
 case when citizen_id % 41 = 40 then 'X' when citizen_id % 43 = 42 then null else gender end as gender, case when citizen_id % 37 = 36 then 130 when citizen_id % 47 = 46 then null else age end as age,
 cast(case when citizen_id % 53 = 52 then -1 else annual_income end as decimal(12,2)) as annual_income, category, state,
 case when citizen_id % 59 = 58 then null else full_name end as full_name, case when citizen_id % 61 = 60 then 'HILLS' else location_type end as location_type, land_holding_acres, occupation,
 case when citizen_id % 67 = 66 then null when citizen_id % 71 = 70 then 'ACCT000000000000' else bank_account end as bank_account, case when citizen_id % 73 = 72 then '?' else is_verified end as is_verified from {citizen}
""",
    "scheme_dirty": """
select scheme_id, case when scheme_id % 61 = 60 then 'SCHEME_01' else scheme_name end as scheme_name, case when scheme_id % 71 = 70 then null else scheme_code end as scheme_code,
 case when scheme_id % 41 = 40 then 77 else department_id end as department_id, case when scheme_id % 37 = 36 then 'MICRO' else scheme_type end as scheme_type, base_benefit_amount,
 cast(case when scheme_id % 43 = 42 then base_benefit_amount - 1 when scheme_id % 47 = 46 then -5 else max_benefit_amount end as decimal(12,2)) as max_benefit_amount,
 case when scheme_id % 53 = 52 then 'X' else is_active end as is_active from {scheme}
""",
    "rules_dirty": """
select case when scheme_id % 59 = 58 then scheme_id + 1000000000000 when scheme_id % 67 = 66 then null else scheme_id end as scheme_id, min_age, max_age, max_income, min_income, allowed_categories,
 case when scheme_id % 41 = 40 then 'HILLS' else location_type end as location_type, case when scheme_id % 43 = 42 then '?' else gender_restriction end as gender_restriction, min_land_acres from {rules}
""",
    "pool_dirty": """
select case when scheme_id % 67 = 66 then 3 when scheme_id % 71 = 70 then scheme_id + 1000000000000 else scheme_id end as scheme_id, case when scheme_id % 73 = 72 then null else financial_year end as financial_year,
 cast(case when scheme_id % 41 = 40 then 0 else total_budget end as decimal(15,2)) as total_budget, cast(case when scheme_id % 43 = 42 then -1 else disbursed_amount end as decimal(15,2)) as disbursed_amount from {pool}
""",
    "officer_dirty": """
select officer_id, case when officer_id % 7 = 6 then null else officer_name end as officer_name, case when officer_id % 5 = 4 then 77 else department_id end as department_id, assigned_state from {officer}
""",
    "citizen_document_dirty": """
select doc_id - case when doc_id % 101 = 100 then 1 else 0 end as doc_id, case when doc_id % 97 = 96 then citizen_id + 1000000000000 when doc_id % 103 = 102 then null else citizen_id end as citizen_id,
 case when doc_id % 89 = 88 then 'PAN' else doc_type end as doc_type, case when doc_id % 83 = 82 then 'LOST' else status end as status, upload_date from {citizen_document}
""",
    "application_dirty": """
select application_id - case when application_id % 211 = 210 then 1 else 0 end as application_id,
 case when application_id % 97 = 96 then citizen_id + 1000000000000 when application_id % 127 = 126 then null else citizen_id end as citizen_id,
 case when application_id % 101 = 100 then 999999999999 else scheme_id end as scheme_id, case when application_id % 107 = 106 then 1000000000000 + application_id else officer_id end as officer_id,
 case when application_id % 131 = 130 then null else apply_date end as apply_date, case when application_id % 113 = 112 then 'LOST' else status end as status, approval_date, priority_score, rejection_reason, remarks from {application}
""",
    "disbursement_dirty": """
select disbursement_id, case when application_id % 83 = 82 then application_id + 1000000000000 when application_id % 109 = 108 then application_id - 1 else application_id end as application_id,
 cast(case when application_id % 79 = 78 then 0 when application_id % 103 = 102 then null else amount end as decimal(12,2)) as amount, disbursement_date, case when application_id % 73 = 72 then 'CASH' else payment_mode end as payment_mode,
 case when application_id % 89 = 88 then 'LOST' else status end as status, case when application_id % 61 = 60 then 'TXN0' else transaction_ref end as transaction_ref from {disbursement}
""",
}

_PLACEHOLDER = re.compile(r"\{([a-z_0-9]+)\}")


def dependencies(name: str) -> list[str]:
    if name == "application":
        return ["application_base", "citizen", "scheme", "rules"]
    return sorted(set(_PLACEHOLDER.findall(TEMPLATES[name])))


# Derivation order (each table only reads earlier ones or driver tables).
ORDER = ["department", "scheme", "rules", "officer", "citizen", "application0", "application_base",
         "benefit", "application", "disbursement", "pool", "citizen_document", "status_event",
         "application_request", "decision_request", "citizen_dirty", "scheme_dirty", "rules_dirty", "pool_dirty",
         "officer_dirty", "citizen_document_dirty", "application_dirty", "disbursement_dirty"]
