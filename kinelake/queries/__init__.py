"""Registered queries by family; each module has QUERIES and ORACLES."""
