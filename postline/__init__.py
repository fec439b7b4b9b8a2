"""Timeline collection, cleaning and loading as Spark DataFrame operators."""
