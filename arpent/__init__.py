"""Arpent: raster, vector and table analytics as functions from DataFrames to DataFrames."""
