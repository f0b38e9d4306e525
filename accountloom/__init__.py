"""Daily customer-data pipeline on Spark: land, clean, store, model, report."""
