"""Operators on market tables: functions from DataFrame to DataFrame."""
