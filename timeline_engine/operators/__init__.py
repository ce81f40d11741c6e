"""Temporal operators over DataFrames."""
