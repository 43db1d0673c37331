"""Incremental refresh of stored tables, run as idempotent batch jobs."""
