"""Marketing spend and revenue analytics as Spark DataFrame and Spark ML jobs."""
