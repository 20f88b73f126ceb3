"""Raster, catalogue and evaluation analytics as Spark DataFrames."""
