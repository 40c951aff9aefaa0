"""Scans: CSV feeds, JSON payloads, JDBC tables, image catalogs."""
