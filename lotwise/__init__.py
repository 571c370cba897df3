"""Parking-occupancy analytics and forecasting as Spark DataFrame transformations."""
