"""Trusted star schemas from messy business tables, as Spark DataFrame plans."""
