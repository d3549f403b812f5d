"""Gridded time-series fields as Spark DataFrames.

A field is a DataFrame with one row per grid point: coordinate columns (``time``,
``lev_idx``, ``lat``, ``lon`` or a ``dst_id`` cell id) and one value column per variable.
Every operator takes DataFrames and returns a lazy DataFrame.
"""
