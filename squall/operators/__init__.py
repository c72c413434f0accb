"""Relational operators: ingest, upsert, weather join, gaps, quality, run log, export."""
