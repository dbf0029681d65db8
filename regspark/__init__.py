"""Spark-native operators for public registries and open data tables."""
