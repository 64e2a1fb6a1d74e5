"""Table operators: each takes DataFrames and optional key columns and returns a DataFrame.

With ``keys=()`` a table describes one site; with e.g. ``keys=("site_id",)`` the same
plan runs for many sites at once, partitioned by them.
"""
