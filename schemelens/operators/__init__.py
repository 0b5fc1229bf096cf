"""Batch jobs: data quality, cohorts, payments, intake, decisions, allocation, triggers."""
