"""Operators, each a function from DataFrame to DataFrame: parsing, scoring, enrichment,
serving, ingest and the skew-safe joins they share."""
