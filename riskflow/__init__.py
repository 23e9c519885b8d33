"""Card-transaction risk pipeline on Spark: bronze, silver and gold layers, batch and streaming."""
