"""Validation, enrichment and reporting pipelines for layered product tables on Spark."""
