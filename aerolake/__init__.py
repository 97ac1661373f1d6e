"""Spark-native landing, flattening and upkeep of air-quality and weather data."""
