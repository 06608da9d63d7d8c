"""Relational and time-series operators (DataFrame -> DataFrame)."""
