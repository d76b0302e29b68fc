"""Operators over DataFrames: series windows, lookups, calendar series, policy, KPIs, profile and checks."""
