"""Parking-sensor analytics as Spark DataFrame operators."""
