"""Trip analytics on Spark: generic DataFrame operators and one medallion pipeline."""
