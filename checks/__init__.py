"""Inputs, queries and reference SQL for the driver contract."""
