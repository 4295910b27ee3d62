"""Composed jobs: monthly ingest with consolidation and dimension refresh,
and the dashboard's tables."""
