"""Flows (whole-table ingestion), control state and the query catalogue."""
