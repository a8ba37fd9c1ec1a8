"""Column -> Column helpers; no Python UDFs."""
