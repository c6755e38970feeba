"""End-to-end jobs: factors, daily values, evaluation, correlation, lifecycle, ingest."""
