"""Column -> Column text functions and the few Arrow-backed UDFs."""
