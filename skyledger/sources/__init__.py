"""Readers: row ids, tables, files of payloads, CSV and JDBC."""
