"""Spark-native analytics over multi-turn tool-calling conversation data."""
