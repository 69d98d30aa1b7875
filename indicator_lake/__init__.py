"""Spark-native indicator lakehouse: snapshots, cleaning, targets, ranking, events and checks."""
