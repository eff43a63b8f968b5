"""Operators: functions from DataFrame to DataFrame. Nothing is collected here."""
