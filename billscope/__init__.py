"""Billing analytics on Spark: average bills, incremental loads, spending segments and reports."""
