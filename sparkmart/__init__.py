"""Sales warehouse and job-offer lake as native Spark DataFrame plans."""
