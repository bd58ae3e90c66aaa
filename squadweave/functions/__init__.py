"""Column functions, all native Spark expressions but for the similarity scorer."""
