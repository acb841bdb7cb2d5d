"""Charging analytics on Spark: sessions and stations in, reports out, all as DataFrames."""
