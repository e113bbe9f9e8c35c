"""Spark-native feature preparation and campaign-response scoring."""
