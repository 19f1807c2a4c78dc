"""Warehouse operators over DataFrames."""
