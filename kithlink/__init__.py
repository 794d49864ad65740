"""Batch entity resolution as Spark DataFrame plans."""
