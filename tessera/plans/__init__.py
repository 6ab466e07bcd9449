"""Wiring of the operator library onto the driver's parquet tables."""
