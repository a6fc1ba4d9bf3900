"""Inputs and outputs: the star-schema testbed, CSV/Parquet scans and sinks,
catalog DDL."""
