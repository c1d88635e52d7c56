"""Card-payment and fraud analytics as Spark DataFrame jobs."""
