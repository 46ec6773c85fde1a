"""File-arrival ingestion."""
