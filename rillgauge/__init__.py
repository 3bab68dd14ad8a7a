"""Discharge-monitoring analytics expressed as Spark DataFrame plans."""
