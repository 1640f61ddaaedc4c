"""Kalends: event listings on Spark."""
