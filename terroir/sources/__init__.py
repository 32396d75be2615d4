"""Readers (S01-S09) and the binding of the driver's test tables."""
