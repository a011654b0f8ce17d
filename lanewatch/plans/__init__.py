"""Whole plans: from decoded input to finished tables, messages and features."""
