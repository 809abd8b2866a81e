"""Lakehouse pipeline toolkit: plain functions from DataFrames to DataFrames."""

from tidelake.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
