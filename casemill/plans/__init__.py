"""Composed jobs (intake, update, backfill) and the query catalogue."""
