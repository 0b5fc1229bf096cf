"""schemelens: benefit-scheme analytics expressed as Spark DataFrame / SQL jobs.

Layout
------
sources/    table schemas, fixture derivation from the driver parquet, catalog
functions/  Oracle-compatible scalar semantics and the eligibility / benefit /
            priority rules as Catalyst column expressions
plans/      the three views and the reporting queries
operators/  data-quality jobs, cohorts, payment run, batch intake / decisions,
            budget allocation and the batch form of the change-driven jobs
streaming/  Structured Streaming forms of the change-driven jobs
"""

from schemelens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
