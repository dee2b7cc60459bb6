"""Sunfleet: device telemetry analytics and failure prediction on Spark DataFrames."""
