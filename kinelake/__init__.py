"""Robot-data quality and analytics as Spark DataFrame operators."""
