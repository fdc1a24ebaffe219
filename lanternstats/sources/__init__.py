"""Readers: directory trees, snapshots, logs and tables to DataFrames."""
