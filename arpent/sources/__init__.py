"""Readers and writers of tables, rasters and vector layers."""
