"""Forecast models and their tuning."""
