"""Readers: raw test tables, derived bronze fixtures, lake layers, JDBC sources."""
