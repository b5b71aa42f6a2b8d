"""Explicit schemas of every input and table; nothing is inferred."""

from __future__ import annotations

POSTING = (
    "id string, title string, description string, created string, "
    "company struct<display_name:string>, category struct<label:string>, "
    "salary_min double, salary_max double, redirect_url string, "
    "contract_type string, contract_time string, "
    "location struct<area:array<string>>"
)
PAGE = f"results array<struct<{POSTING.replace(' string', ':string').replace(' double', ':double').replace(' struct', ':struct')}>>"

STAGING_JOBS = (
    "job_id string, title string, description string, salary_min double, salary_max double, "
    "created bigint, redirected_url string, ingest_data string, ingest_ts bigint, "
    "company_name string, category_label string, city string, state string"
)
STAGING_JOBSTATS = "job_id string, contract_type string, contract_time string, posting_week string"
STAGING_COMPANIES = "company_name string"
STAGING_CATEGORIES = "category_label string"
STAGING_LOCATIONS = "city string, state string, country string"

COMPANIES = "company_name string, company_id string"
CATEGORIES = "category_label string, category_id string"
LOCATIONS = "city string, state string, country string, location_id string"
JOBS = (
    "job_id string, title string, description string, salary_min double, salary_max double, "
    "created timestamp, redirected_url string, ingest_data string, ingest_ts timestamp, "
    "company_id string, category_id string, location_id string, "
    "company_name string, category_label string, city string, state string"
)
JOBSTATS = STAGING_JOBSTATS

JOB_SKILLS = "source_job_id string, skill_name string, extraction_date string, model_version string"
SKILLS = (
    "skill_id string, skill_name string, skill_type string, category string, subcategory string, "
    "description string, tags string, is_soft_skill boolean, info_url string, ingest_ts timestamp"
)
JOB_SKILLS_BRIDGE = "job_id string, skill_id string"
DICTIONARY = "phrase string, label string"

RAW_PETITIONS = (
    "fiscal_year int, employer_petitioner_name string, industry_naics_code string, "
    "petitioner_city string, petitioner_state string, petitioner_zip_code double, "
    "new_employment_approval int, new_employment_denial int, "
    "new_concurrent_approval int, new_concurrent_denial int, "
    "change_of_employer_approval int, change_of_employer_denial int, "
    "continuation_approval int, continuation_denial int, "
    "change_with_same_employer_approval int, change_with_same_employer_denial int, "
    "amended_approval int, amended_denial int"
)
PETITIONS = (
    "fiscal_year int, employer_name string, naics_code string, city string, state string, "
    "zip_code string, total_initial_approvals int, total_initial_denials int, "
    "total_continuing_approvals int, total_continuing_denials int"
)
SPONSORSHIP_STATUS = (
    "employer_name string, ever_sponsored_h1b boolean, last_updated_fiscal_year int"
)
NAME_MAPPING = "company_name string, employer_name string"
SPONSOR_COMPANIES = (
    "company_id string, company_name string, h1b_official_name string, "
    "is_sponsor boolean, last_updated_fiscal_year int"
)

JOB_ENRICHMENT = (
    "job_id string, extracted_skills array<string>, years_experience_min int, "
    "years_experience_max int, education_level string, benefits array<string>, "
    "tech_stack array<string>, processed_at string"
)
JOB_EMBEDDINGS = (
    "job_id string, embedding_vector array<double>, model_name string, created_at string"
)
JOB_CLUSTERS = "job_id string, cluster_id int, model_version string, processed_at timestamp"
CLUSTER_REGISTRY = (
    "cluster_id int, cluster_name string, top_terms string, job_count bigint, "
    "avg_salary_min double, avg_salary_max double, model_version string, updated_at string"
)

COMPANY_PRESENCE = "company_id string, location_id string"
PART_COUNTS = "category_label string, company_id string, jobs bigint"
CATEGORY_OVERLAP = (
    "category_label string, top_companies array<struct<company_name: string, count: bigint>>, total_jobs bigint"
)
