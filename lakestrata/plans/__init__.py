"""End-to-end jobs: lake layout, ingestion + sync log, gold build, views, checks."""
