"""Spark-native story cleaning, slicing and text-corpus operators."""
