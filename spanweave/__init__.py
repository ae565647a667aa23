"""Spark-native building, cleaning, scoring and auditing of labelled text."""
