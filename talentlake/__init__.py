"""Spark-native player-value lake: land feeds, link them by name, score and publish."""
