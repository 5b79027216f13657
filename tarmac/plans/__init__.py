"""The reports: compositions of operators that a user calls."""
