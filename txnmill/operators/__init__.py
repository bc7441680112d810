"""Operators: functions from DataFrame to DataFrame, without actions."""
