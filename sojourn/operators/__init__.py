"""Generic DataFrame operators; column names are parameters."""
